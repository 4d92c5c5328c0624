"""DuckDB SQL for the queries of this package that SQL can express."""

import re
from pathlib import Path

from parcelstats.llm import licenses
from parcelstats.llm.licenses import (
    DENIES, ENDINGS, HEADERS, LEADER, NAMED, SPEAKS, TAG, TEMPLATES, WHOLE, WRAPPED,
)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _rows(templates, first: int = 0) -> str:
    return ", ".join(f"({k}, {_quoted(name)}, {_quoted(text)})" for k, (name, text) in enumerate(templates, first))


def _text_rows() -> str:
    texts = sorted((Path(licenses.__file__).parent / "license_texts").glob("*.txt"))
    return ", ".join(f"({_quoted(p.stem)}, {_quoted(p.read_text(encoding='utf-8'))})" for p in texts)


OP8 = r"""
WITH sized AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighted AS (
  SELECT source, source_size,
         ((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::DOUBLE AS weight
  FROM totals
), leveled AS (
  SELECT *, source_size * 3.0::DOUBLE / weight AS lim,
         (sum(source_size) OVER ()
          - 3.0::DOUBLE * coalesce(sum(source_size) OVER (ORDER BY source_size * 3.0::DOUBLE / weight, source IS NULL, source
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY source_size * 3.0::DOUBLE / weight, source IS NULL, source
              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted
), goals AS (
  SELECT source, source_size,
         least(source_size * 3.0::DOUBLE,
               (SELECT max(level) FROM leveled WHERE level <= lim) * weight) AS target
  FROM leveled
), placed AS (
  SELECT s.doc_id, s.size, g.source_size, g.target,
         row_number() OVER (PARTITION BY s.source ORDER BY
           length(s.size::VARCHAR) * 100 + substr(s.size::VARCHAR, 1, 2)::INT,
           coalesce(md5(s.doc_id::VARCHAR), 'g')) AS place,
         CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS expected,
         ('0x' || substr(md5('mix/' || coalesce(s.source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS start
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
       (size * (floor(place * expected + start) - floor((place - 1) * expected + start)))::BIGINT AS taken
FROM placed
"""

OP7 = r"""
WITH templates(template, license, sentence) AS (VALUES TEMPLATE_ROWS),
headers(template, license, sentence) AS (VALUES HEADER_ROWS),
tt AS (
  SELECT template, license, term, count(*) AS tf FROM (
    SELECT template, license, unnest(regexp_extract_all(lower(sentence), '[a-z]+|[0-9]+(?:\.[0-9]+)*')) AS term
    FROM (SELECT * FROM templates UNION ALL SELECT * FROM headers)) GROUP BY ALL
), n AS (
  SELECT count(*)::DOUBLE AS n FROM templates
), idf AS (
  SELECT term, ln((1.0 + (SELECT n FROM n)) / (1.0 + count(*))) + 1.0 AS idf
  FROM tt WHERE template IN (SELECT template FROM templates) GROUP BY term
), tv AS (
  SELECT template, license, term, tf * coalesce(idf, ln(1.0 + (SELECT n FROM n)) + 1.0) AS w FROM tt LEFT JOIN idf USING (term)
), tl AS (
  SELECT template, sqrt(sum(w * w)) AS len FROM tv GROUP BY template
), files AS (
  SELECT doc_id, text, concat_ws('/', CASE WHEN doc_id % 97 = 0 THEN source WHEN doc_id % 11 = 0 THEN concat_ws('/', source, lang)
    ELSE concat_ws('/', source, lang, (doc_id // 100)::VARCHAR) END, doc_id::VARCHAR) AS path FROM documents
), placed AS MATERIALIZED (
  SELECT *, CASE WHEN contains(path, '/') THEN regexp_replace(path, '/[^/]*$', '') END AS dir FROM files
), speaking AS MATERIALIZED (
  SELECT *, [regexp_replace(s, 'LEADER', '', 'g') for s in string_split(text, chr(10))] AS bare FROM placed
  WHERE regexp_matches(text, 'SPEAKS') OR regexp_matches(text, 'WHOLE')
), marked AS (
  SELECT doc_id, bare, unnest([i for i in range(1, len(bare) + 1) if regexp_matches(bare[i], 'SPEAKS|permission is hereby granted')]) AS i
  FROM speaking
), joined AS (
  SELECT doc_id, array_to_string(bare[k : k + n - 1], ' ') AS part
  FROM (SELECT doc_id, bare, unnest(range(greatest(i - WRAPPED + 1, 1), i + 1)) AS k FROM marked) CROSS JOIN range(2, WRAPPED + 1) AS r(n)
  UNION ALL
  SELECT doc_id, replace(part, chr(10), ' ') FROM (
    SELECT doc_id, unnest(regexp_split_to_array(array_to_string(bare, chr(10)), '\n[ \t]*\n')) AS part FROM speaking)
), parts AS (
  SELECT doc_id, part, 'SPEAKS' AS speaks FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS part FROM speaking)
  UNION ALL SELECT doc_id, part, 'SPEAKS|permission is hereby granted' FROM joined
), ended AS (
  SELECT doc_id, speaks, unnest(string_split(regexp_replace(part, '([.!?])[ \t\r\x0b\f]+', '\1
', 'g'), chr(10))) AS sentence FROM parts
), sentences AS MATERIALIZED (
  SELECT row_number() OVER () AS place, doc_id, sentence FROM (
    SELECT DISTINCT doc_id, sentence FROM ended
    WHERE regexp_matches(sentence, speaks) AND NOT regexp_matches(sentence, 'DENIES'))
), terms AS (
  SELECT doc_id, place, term, count(*) AS tf FROM (
    SELECT doc_id, place, unnest(regexp_extract_all(lower(sentence), '[a-z]+|[0-9]+(?:\.[0-9]+)*')) AS term
    FROM sentences) GROUP BY ALL
), weighted AS (
  SELECT doc_id, place, term, tf * coalesce(idf, ln(1.0 + (SELECT n FROM n)) + 1.0) AS w FROM terms LEFT JOIN idf USING (term)
), lengths AS (
  SELECT doc_id, place, sqrt(sum(w * w)) AS len FROM weighted GROUP BY ALL
), dots AS (
  SELECT x.doc_id, x.place, v.template, v.license, sum(x.w * v.w / l.len) AS dot
  FROM weighted x JOIN tv v USING (term) JOIN tl l USING (template) GROUP BY ALL
), cosines AS (
  SELECT doc_id, license, round(dot / len, 6) AS cosine FROM dots JOIN lengths USING (doc_id, place)
), noticed AS (
  SELECT doc_id, license, cosine FROM cosines WHERE cosine >= 0.6
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY cosine DESC, license) = 1
), texts(whole, body) AS (VALUES TEXT_ROWS),
known AS (
  SELECT whole, term, count(*) AS tf FROM (
    SELECT whole, unnest(regexp_extract_all(lower(body), '[a-z]+|[0-9]+(?:\.[0-9]+)*')) AS term FROM texts) GROUP BY ALL
), rarity AS (
  SELECT term, ln((1.0 + (SELECT count(*) FROM texts)) / (1.0 + count(*))) + 1.0 AS idf FROM known GROUP BY term
), units AS (
  SELECT whole, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY whole)) AS unit FROM known JOIN rarity USING (term)
), bodies AS (
  SELECT doc_id, term, count(*) AS tf FROM (
    SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+|[0-9]+(?:\.[0-9]+)*')) AS term
    FROM speaking WHERE regexp_matches(text, 'WHOLE')) GROUP BY ALL
), heavy AS (
  SELECT doc_id, term, tf * coalesce(idf, ln(1.0 + (SELECT count(*) FROM texts)) + 1.0) AS w FROM bodies LEFT JOIN rarity USING (term)
), likeness AS (
  SELECT doc_id, whole, round(dot / len, 6) AS cosine
  FROM (SELECT doc_id, whole, sum(w * unit) AS dot FROM heavy JOIN units USING (term) GROUP BY ALL)
  JOIN (SELECT doc_id, sqrt(sum(w * w)) AS len FROM heavy GROUP BY ALL) USING (doc_id)
), wholes AS (
  SELECT doc_id, whole, cosine FROM likeness WHERE cosine >= 0.85
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY cosine DESC, whole) = 1
), tags AS (
  SELECT doc_id, regexp_replace(regexp_extract(text, 'TAG', 1), 'ENDINGS', '') AS tag FROM speaking
), own AS (
  SELECT doc_id, coalesce(nullif(tag, ''), whole, noticed.license) AS license, whole IS NOT NULL AS is_whole,
    CASE WHEN tag <> '' THEN 1.0 ELSE coalesce(wholes.cosine, noticed.cosine) END::DOUBLE AS cosine
  FROM tags LEFT JOIN wholes USING (doc_id) LEFT JOIN noticed USING (doc_id)
  WHERE coalesce(nullif(tag, ''), whole, noticed.license) IS NOT NULL
), declared AS (
  SELECT dir, license, cosine FROM placed JOIN own USING (doc_id) WHERE dir IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY
    regexp_matches(path, 'NAMED') OR is_whole DESC, cosine DESC, path, license) = 1
), inherited AS (
  SELECT f.dir, d.license, d.cosine FROM (SELECT DISTINCT dir FROM placed) f
  JOIN declared d ON f.dir = d.dir OR starts_with(f.dir, d.dir || '/')
  QUALIFY row_number() OVER (PARTITION BY f.dir ORDER BY length(d.dir) DESC) = 1
)
SELECT f.doc_id,
       coalesce(o.license, d.license) AS license,
       coalesce(o.cosine, d.cosine) AS license_cosine,
       CASE WHEN o.license IS NOT NULL THEN 'notice' WHEN d.license IS NOT NULL THEN 'directory' END AS license_from
FROM placed f LEFT JOIN own o USING (doc_id) LEFT JOIN inherited d ON d.dir = f.dir
"""
for _name, _value in {
    "TEMPLATE_ROWS": _rows(TEMPLATES), "HEADER_ROWS": _rows(HEADERS, len(TEMPLATES)), "TEXT_ROWS": _text_rows(),
    "LEADER": LEADER, "SPEAKS": SPEAKS, "WHOLE": WHOLE, "WRAPPED": str(WRAPPED), "DENIES": DENIES, "TAG": TAG,
    "ENDINGS": ENDINGS, "NAMED": NAMED,
}.items():
    OP7 = re.sub(rf"\b{_name}\b", lambda _: _value, OP7)  # noqa: B023


def _assigned(centroids: str) -> str:
    """Nearest centroid of every kept vector, the smaller number among equally near ones."""
    distance = "list_sum([(q[i] - c[i]) * (q[i] - c[i]) for i in range(1, 65)])::BIGINT"
    return (
        f"SELECT vec_id, q, arg_min(number, (distance, number)) AS cluster, min(distance) AS distance"
        f" FROM (SELECT row_id, vec_id, q, number, {distance} AS distance FROM kept, {centroids})"
        f" GROUP BY row_id, vec_id, q"
    )


def _moved(centroids: str, assigned: str) -> str:
    floor = "((s - ((s % n) + n) % n) // n)::BIGINT"
    return (
        f"SELECT number, coalesce(m.c, {centroids}.c) AS c FROM {centroids} LEFT JOIN ("
        f" SELECT cluster, list({floor} ORDER BY place) AS c FROM ("
        f" SELECT cluster, place, sum(x) AS s, count(*) AS n FROM ("
        f" SELECT cluster, unnest(range(64)) AS place, unnest(q) AS x FROM {assigned})"
        f" GROUP BY cluster, place) GROUP BY cluster) m ON m.cluster = number"
    )


OP11 = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row_id, vec_id, [floor(64 * x::DOUBLE)::BIGINT for x in embedding] AS q
  FROM embeddings
  WHERE len(embedding) = 64 AND len([1 for x in embedding if x IS NOT NULL AND isfinite(x)]) = 64
),
c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY h, q) - 1)::INTEGER AS number, q AS c
  FROM (SELECT sha256('1:' || vec_id::VARCHAR) AS h, q FROM kept ORDER BY h, q LIMIT 16)
),
a0 AS MATERIALIZED ({_assigned("c0")}), c1 AS MATERIALIZED ({_moved("c0", "a0")}),
a1 AS MATERIALIZED ({_assigned("c1")}), c2 AS MATERIALIZED ({_moved("c1", "a1")}),
a2 AS MATERIALIZED ({_assigned("c2")}), c3 AS MATERIALIZED ({_moved("c2", "a2")}),
a3 AS MATERIALIZED ({_assigned("c3")})
SELECT vec_id, cluster, distance,
  sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
  sum(distance) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a3 JOIN c3 ON cluster = number
"""

OP12 = """
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h
  FROM pages
),
first AS (SELECT h, min(page_id) AS first_id FROM payloads GROUP BY h)
SELECT page_id, payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(p.h, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INTEGER, 1)
    for i in range(32)], '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM payloads p JOIN first f ON p.h = f.h
"""

OP13 = """
WITH taking AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([1 for x in embedding if x IS NOT NULL AND isfinite(x)]) = len(embedding)
),
scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
    list_sum([a.q[i] * r.q[i] for i in range(1, len(a.q) + 1)])::BIGINT AS score
  FROM taking a JOIN taking r ON a.vec_id <> r.vec_id AND len(a.q) = len(r.q)
  WHERE a.vec_id % 50 = 0
),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
),
negatives AS (
  SELECT anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank
  FROM positives JOIN scored USING (anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
)
SELECT * FROM negatives WHERE rank <= 3
"""
