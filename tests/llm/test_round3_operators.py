"""Centroid clustering, web archives and hard negatives against brute force and on odd tables."""

import base64
import gzip
import hashlib
import math
import random

import numpy as np
import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from parcelstats.llm import centroids, hard_negatives, queries, warc
from tests.compare import differences, duckdb_on

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_centroid_clusters", "op12_warc_round_trip", "op13_hard_negatives"])
def test_queries_equal_their_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SMALL), duckdb_on(SMALL), queries.ORACLE_SQL[name]) == []


# -- centroid clustering ---------------------------------------------------------------------


def clustered(rows, k, rounds, size, scale):
    kept = [
        (i, [math.floor(scale * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)
    ]
    named = sorted((i is None, hashlib.sha256(f"1:{i}".encode()).hexdigest(), q) for i, q in kept)
    now = [list(q) for _, _, q in named[:k]]

    def near(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c)), n) for n, c in enumerate(now))

    for _ in range(rounds):
        members = {}
        for _, q in kept:
            members.setdefault(near(q)[1], []).append(q)
        for n, own in members.items():
            now[n] = [sum(xs) // len(own) for xs in zip(*own)]
    out = [(i, near(q)[1], near(q)[0]) for i, q in kept]
    total = {}
    for _, n, d in out:
        total[n] = total.get(n, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now]
    return sorted(
        ((i, n, d, total[n], sum(total.values()), sha[n]) for i, n, d in out), key=lambda r: (r[0] is None, r)
    )


@pytest.mark.parametrize("spread", [0.0, 0.3, 3.0])
def test_clusters_match_brute_force(spark, spread):
    rng = random.Random(7)
    centres = [[rng.uniform(-4, 4) for _ in range(6)] for _ in range(5)]
    rows = [(i, [c + rng.gauss(0, spread) for c in rng.choice(centres)]) for i in range(300)]
    rows += rows[:3] + [(None, rows[5][1]), (400, None), (401, []), (402, [1.0] * 5), (403, [1.0] * 5 + [None])]
    rows += [(404, [1.0] * 5 + [math.nan]), (405, [math.inf] * 6), (406, [0.0] * 6), (407, [-0.0] * 6)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster int, id string")
    found = centroids.cluster_vectors(df, k=7, rounds=3, size=6, scale=16)
    got = sorted(map(tuple, found.collect()), key=lambda r: (r[0] is None, r))
    assert got == clustered(rows, 7, 3, 6, 16)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_few_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None)]
    found = centroids.cluster_vectors(spark.createDataFrame(rows, schema), size=2)
    assert sorted(r[:3] for r in found.collect()) == [(1, 0, 0), (2, 0, 0)]
    empty = centroids.cluster_vectors(spark.createDataFrame([(3, None)], schema), size=2)
    assert empty.collect() == [] and empty.columns == found.columns


def test_a_component_beyond_64_bits_is_an_error(spark):
    rows = [(1, [1e300, 2.0]), (2, [1.0, 2.0])]
    with pytest.raises(Exception, match="too large"):
        centroids.cluster_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), size=2).count()


def test_bounds_enclose_the_distances_and_leave_few():
    rng = np.random.default_rng(5)
    middle = rng.integers(-60, 60, (16, 64))
    vectors = middle[rng.integers(0, 16, 4000)] + rng.integers(-8, 9, (4000, 64))
    simplex = centroids.choose_simplex(middle)
    apexes, own = simplex.apexes(vectors), simplex.apexes(middle)
    exact = ((vectors[:, None] - middle) ** 2).sum(axis=2)
    low = ((apexes[:, None] - own) ** 2).sum(axis=2)
    high = low + 4 * apexes[:, -1:] * own[:, -1]
    assert len(simplex.pivots) == centroids.PIVOTS
    assert (low <= exact + 1e-3).all() and (high >= exact - 1e-3).all()
    best, distance, measured = centroids.nearest_centroid(vectors, apexes, middle, simplex)
    assert (best == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    assert measured < 0.35 * exact.size


# -- web archives ----------------------------------------------------------------------------


def expected_records(rows, least=0):
    first = {}
    for i, u, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or "")):
        first.setdefault((html or "").encode(), (i, u))
    out, done = [], set()
    for i, u, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or "")):
        body = (html or "").encode()
        code = base64.b32encode(hashlib.sha1(body).digest()).decode()
        if len(body) < least or body not in done:
            out.append((i, len(body), code, "response", None))
        else:
            out.append((i, len(body), code, "revisit", first[body][0]))
        done.add(body)
    return sorted(out, key=str)


ODD_PAGES = [
    (5, "http://Example.com/a?x=1#top", "<p>é</p>"),
    (3, "https://www.example.com/a?x=1", "<p>é</p>"),
    (3, "https://www.example.com/a?x=1", "<p>é</p>"),
    (None, "http://example.com/b", "<p>é</p>"),
    (7, None, None),
    (8, "", ""),
    (9, "not an address\r\nX: y", "a\r\n\r\nb\r\n\r\n"),
    (-4, "http://user@10.0.0.1:8080", "WARC/1.1\r\n"),
    (11, "http://example.com/b", "long " * 400_000),
    (11, "http://example.com/c", "long " * 400_000),
    (None, None, None),
]


def read_back(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, sha string, slice int")
    archives = warc.write_archives(df, **options)
    found = warc.fetch(archives, warc.look_up(archives, df))
    return archives, sorted(
        map(tuple, found.select("page", "payload_bytes", "payload_digest", "kind", "refers_to").collect()), key=str
    )


@pytest.mark.parametrize("least", [0, 5])
def test_archives_on_odd_pages(spark, least):
    _, got = read_back(spark, ODD_PAGES, least_bytes=least)
    assert got == expected_records(ODD_PAGES, least)


def test_no_pages(spark):
    assert read_back(spark, [])[1] == []


@pytest.mark.parametrize("ids", [range(0, 4000), [None] * 1500])
def test_a_payload_with_many_captures(spark, ids):
    rows = [(i, f"http://h{n % 7}.example.com/{n}", "same") for n, i in enumerate(ids)] + [(-1, "http://a/", "other")]
    archives, got = read_back(spark, rows)
    assert got == expected_records(rows)
    # What is only revisited leaves its payload behind.
    assert archives.captures.filter("kind = 'response'").count() == 2


def test_many_blocks_and_captures_of_one_url(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 10)
    rows = [(i, f"http://x.example.org/{i % 37}", f"page {i}") for i in range(2000)]
    archives, got = read_back(spark, rows)
    assert got == expected_records(rows)
    wanted = spark.createDataFrame([("https://X.example.org/5#a",), ("http://x.example.org/none",)], "url string")
    found = warc.look_up(archives, wanted, id=None)
    assert sorted(r.id for r in found.collect()) == [i for i in range(2000) if i % 37 == 5]
    payloads = {r.page: bytes(r.payload) for r in warc.fetch(archives, found, with_payload=True).collect()}
    assert payloads == {i: f"page {i}".encode() for i in range(2000) if i % 37 == 5}


def test_archives_are_gzip_members_of_warc_records(spark):
    archives, _ = read_back(spark, ODD_PAGES)
    files, path = warc.storage(archives.folder)
    text = b""
    for info in files.get_file_info(pafs.FileSelector(path)):
        if info.path.endswith(".warc.gz"):
            text += gzip.decompress(files.open_input_file(info.path).read())
    assert text.count(b"WARC-Type: response\r\n") + text.count(b"WARC-Type: revisit\r\n") == len(ODD_PAGES)
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
    ids = [line for line in text.split(b"\r\n") if line.startswith(b"WARC-Record-ID")]
    assert len(ids) == len(set(ids))


def test_capture_keys(spark):
    urls = {
        "http://www.Example.com:80/A/b?q=1#x": "com,example)/a/b?q=1",
        "//user@news.example.co.uk": "uk,co,example,news)/",
        "https://example.com?x": "com,example)/?x",
        "http://10.0.0.1:8080/": "10.0.0.1)/",
        "mailto:a@b.c": "mailto:a@b.c",
        None: "",
    }
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r[0] for r in df.select(warc.capture_key(F.col("url"))).collect()] == list(urls.values())


def test_a_damaged_record_is_an_error():
    raw = warc.record("response", "urn:capture:1:x", "http://a/", warc.digest(b"abc"), 3, b"abc", "2000-01-01T00:00:00Z")
    assert warc.parsed(raw).payload == b"abc"
    with pytest.raises(ValueError, match="damaged"):
        warc.parsed(raw.replace(b"abc\r\n\r\n", b"abd\r\n\r\n"))


# -- hard negatives --------------------------------------------------------------------------


def mined(rows, anchor, n_positives=5, n_negatives=3, low=50, high=95, scale=256):
    taking = [
        (i, label, [math.floor(scale * x) for x in v])
        for i, label, v in rows
        if None not in (i, label, v) and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, label, q in taking:
        if not anchor(i):
            continue
        scores = sorted(
            (-sum(a * b for a, b in zip(q, r)), other, own) for other, own, r in taking if other != i and len(r) == len(q)
        )
        for p, positive, _ in [s for s in scores if s[2] == label][:n_positives]:
            inside = [(s, n) for s, n, own in scores if own != label and low * -p <= 100 * -s <= high * -p]
            out += [(i, positive, k + 1, n, -p, -s) for k, (s, n) in enumerate(inside[:n_negatives])]
    return sorted(out)


@pytest.mark.parametrize("width", [1, 2, 8])
@pytest.mark.parametrize("at_once", [3, 256])
def test_negatives_match_brute_force(spark, monkeypatch, width, at_once):
    monkeypatch.setattr(hard_negatives, "AT_ONCE", at_once)
    rng = random.Random(width)
    # Whole steps, so that scores tie often, zero and negative ones included.
    rows = [(i, rng.choice([0, 1, 2, None]), [rng.randint(-2, 2) / 4 for _ in range(width)]) for i in range(-50, 350)]
    rows += [(1000 + i, i % 3, [0.25] * width) for i in range(150)]
    rows += [(None, 1, [1.0] * width), (2000, 1, None), (2050, 1, [math.nan] * width), (2100, 2, [])]
    rows += [(2150, 1, [None] * width), (2200, 1, []), (2201, 2, []), (2250, 0, [1.0] * (width + 1)), (2202, 1, [])]
    df = spark.createDataFrame(
        [(*r, "x") for r in rows], "vec_id long, label int, embedding array<double>, anchor string"
    ).repartition(7)
    found = hard_negatives.mine_hard_negatives(df)
    assert sorted(map(tuple, found.collect())) == mined(rows, lambda i: i % 50 == 0)


def test_repeated_rows_and_empty_tables(spark):
    rows = [(0, 1, [1.0, 0.0]), (0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 2, [0.75, 0.0])]
    schema = "vec_id long, label int, embedding array<double>"
    found = hard_negatives.mine_hard_negatives(spark.createDataFrame(rows, schema))
    # The anchor counts once, its copy is no positive; the copies of row 1 are two positives.
    assert sorted(map(tuple, found.collect())) == [(0, 1, 1, 2, 65536, 49152)] * 2
    assert hard_negatives.mine_hard_negatives(spark.createDataFrame([], schema)).collect() == []
    with pytest.raises(ValueError):
        hard_negatives.mine_hard_negatives(spark.createDataFrame([], schema), high=120)


def test_scores_beyond_double_precision_stay_exact():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-(2**29), 2**29, (3, 5)), rng.integers(-(2**29), 2**29, (4, 5))
    assert hard_negatives.inner(a, b).tolist() == [
        [sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a
    ]
    with pytest.raises(ValueError):
        hard_negatives.inner(a << 20, b << 20)
