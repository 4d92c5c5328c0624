"""Learned operators against plain Python on small tables: vectors, lexicon, curve, posteriors."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parcelstats.llm import quality, rules, toxicity
from parcelstats.llm.words import blocks

SMALL = "/root/testdata/sf0.001"
WHITE = re.compile(r"[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").repartition(5, "doc_id")


# -- quality ---------------------------------------------------------------------------------


def plain_tokens(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    kind = lambda c: 0 if c in " \t\n\x0b\x0c\r" else 1 if ord(c) >= 128 or c.isalnum() else 2
    out, now = [], 0
    for c in text:
        if kind(c) and kind(c) == now:
            out[-1] += c
        elif kind(c):
            out.append(c)
        now = kind(c)
    return out


def hash_of(token):
    (block,) = blocks(pa.array([token]))
    data = block.lowered()
    return int(block.spans(data, quality.KINDS[data]).hash[0])


def test_word_vectors_and_scores(spark, docs, monkeypatch):
    monkeypatch.setattr(quality, "OWN_ROWS", 50)
    texts = [r.text for r in docs.collect()]
    counts = Counter(t for text in texts for t in plain_tokens(text) if t[0].isalnum() or ord(t[0]) >= 128)
    hashes = {t: hash_of(t) for t in {t for text in texts for t in plain_tokens(text)}}
    signed = lambda h: h - (1 << 64) if h >= 1 << 63 else h
    ranked = sorted(counts, key=lambda t: (-counts[t], signed(hashes[t])))[:50]
    own = quality.frequent_words(docs, most=50)
    assert own.tolist() == sorted(hashes[t] for t in ranked)

    def row_of(token):
        if hashes[token] in set(own.tolist()) and token in counts:
            return quality.SHARED_ROWS + own.tolist().index(hashes[token])
        if token in counts:
            return hashes[token] % quality.WORD_ROWS
        return quality.WORD_ROWS + hashes[token] % quality.MARK_ROWS

    index = quality.index_vectors(quality.SHARED_ROWS + 50)
    assert (np.abs(index).sum(axis=1) == quality.NONZERO).all()
    rows = {t: row_of(t) for t in hashes}
    context = np.zeros(index.shape)
    for text in texts:
        found = [rows[t] for t in plain_tokens(text)]
        for a, b in zip(found, found[1:]):
            context[a] += index[b]
            context[b] += index[a]
    length = np.maximum(np.sqrt((context**2).sum(axis=1, keepdims=True)), 1)
    expected = index + np.round(context / length, 6) * math.sqrt(quality.NONZERO)
    vectors = quality.word_vectors(docs, own)
    assert np.allclose(vectors, expected, atol=1e-5)

    model = quality.fit_quality(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    scores = {r.text: r.quality for r in model.score(docs).collect()}
    own = model.own.tolist()
    for text in texts[:25]:
        found = [
            quality.SHARED_ROWS + own.index(hashes[t]) if t in counts and hashes[t] in own
            else hashes[t] % quality.WORD_ROWS if t in counts else quality.WORD_ROWS + hashes[t] % quality.MARK_ROWS
            for t in plain_tokens(text)
        ]
        v = model.vectors[found].astype(float)
        parts = [v[i : i + quality.STRETCH] for i in range(0, len(v), quality.STRETCH)]
        means = np.stack([p.sum(axis=0) / max(len(p), quality.STRETCH // 2) for p in parts])
        norms = np.sqrt((means**2).sum(axis=1))
        n_marks = sum(quality.WORD_ROWS <= r < quality.SHARED_ROWS for r in found)
        x = [*v.mean(axis=0), *means.max(axis=0), *means.min(axis=0), norms.mean(), norms.max(),
             math.log1p(len(found)) / 5, n_marks / len(found)]
        net = model.network
        x = [max(-8.0, min(8.0, (a - m) / s)) for a, m, s in zip(x, net.middle, net.spread)]
        hidden = [math.tanh(sum(a * w for a, w in zip(x, column)) + c) for column, c in zip(net.w[0].T, net.w[1])]
        z = (sum(h * w for h, w in zip(hidden, net.w[2])) + net.w[3][0]) / net.temperature
        assert abs(scores[text] - 1 / (1 + math.exp(-z))) < 1e-4


def test_quality_of_a_very_long_text(spark, docs):
    model = quality.fit_quality(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    long = "a few words that go on and on. " * 100_000
    found = model.score(spark.createDataFrame([(1, long), (2, long)], "doc_id long, text string")).collect()
    assert 0 <= found[0].quality <= 1 and found[0].quality == found[1].quality


# -- toxicity --------------------------------------------------------------------------------


def test_lexicon_curve_and_scores(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").repartition(5, "doc_id")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.fit_toxicity(docs, labels)
    part = labels.filter(toxicity.training_part(F.col("doc_id"))).filter("toxic is not null")
    rows = docs.join(part, "doc_id").select("text", "toxic").collect()
    n = Counter(r.toxic for r in rows)
    seen = {0: Counter(), 1: Counter()}
    for r in rows:
        words = set(toxicity.fold(r.text).split())
        found = {f" {w} " for w in words} | {f" {w[:k]}" for w in words for k in (4, 5, 6, 7) if len(w) >= k}
        seen[r.toxic].update(found)
    weights = {}
    for term, times in seen[1].items():
        ratio = (times + 0.5) / (n[1] + 1) / ((seen[0][term] + 0.5) / (n[0] + 1))
        if times >= max(3, toxicity.LEAST_SHARE * n[1]) and ratio >= toxicity.LEAST_RATIO:
            weights[term] = math.log(ratio)
    kept = {}
    for term in sorted(weights, key=lambda t: (len(t), t)):
        shorter = [kept[s] for s in kept if term.startswith(s) and len(s) >= 2 and s != term]
        if not shorter or weights[term] > max(shorter) + 0.7:
            kept[term] = weights[term]
    assert model.lexicon == pytest.approx(kept) and len(kept) > 5

    def weight(text):
        folded = toxicity.fold(text)
        best = {}
        for term, w in kept.items():
            for m in re.finditer(f"(?={re.escape(term)})", folded):
                best[m.start()] = max(w, best.get(m.start(), 0))
        for phrase in map(toxicity.fold, toxicity.EXCEPTIONS):
            for m in re.finditer(f"(?={re.escape(phrase)})", folded):
                best = {p: w for p, w in best.items() if not m.start() <= p < m.start() + len(phrase) - 1 + 1}
        return sum(best.values()), folded.count(" ") - 1

    def inputs(text):
        total, words = weight(text)
        return math.log1p(total), math.log1p(100 * total / max(words, 1)), 1.0

    # The curve is where the penalised likelihood does not rise any more.
    slope = [-0.01 * c for c in model.curve]
    for r in rows:
        x = inputs(r.text)
        p = 1 / (1 + math.exp(-max(-30, min(30, sum(a * c for a, c in zip(x, model.curve))))))
        slope = [s + a * (r.toxic - p) for s, a in zip(slope, x)]
    assert max(map(abs, slope)) < 1e-4
    for r in model.score(docs).limit(200).collect():
        z = sum(a * c for a, c in zip(inputs(r.text or ""), model.curve))
        assert abs(r.toxicity - 1 / (1 + math.exp(-max(-30, min(30, z))))) < 1e-6


def test_folding_goes_on_until_nothing_changes():
    assert toxicity.fold("5tup1d") == " stupid " and toxicity.fold("a0000000b") == " aooooooob "
    assert toxicity.fold("ѕtυріd ѕłøw đɨɍŧ") == " stupid slow dirt "
    assert toxicity.fold("in 2024 at 10:30") == " in at "


# -- rules -----------------------------------------------------------------------------------


def plain_votes(text):
    words = WHITE.findall(text or "")
    n, chars = len(words), sum(map(len, words))
    lines = [x for x in (text or "").split("\n") if WHITE.search(x)]
    five = [tuple(words[i : i + 5]) for i in range(n - 4)]
    times = Counter(five)
    repeated = {i + k for i, w in enumerate(five) if times[w] > 1 for k in range(5)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    letters = sum(c.isalpha() if ord(c) < 128 else True for w in words for c in w)
    capitals, small = (sum(a <= c <= z for c in text or "") for a, z in ("AZ", "az"))
    distinct = len(set(words))
    some = n >= 10
    against = [
        n < 10, chars < 2 * n or chars > 14 * n, 10 * symbols > n,
        10 * (len(lines) - len(set(lines))) > 3 * len(lines), 5 * len(repeated) > n,
        some and 100 * letters < 75 * chars, some and distinct < min(0.2 * n, 3 * math.sqrt(n)),
        some and 2 * capitals > capitals + small,
    ]
    prose = some and 50 * symbols <= n and distinct >= min(0.35 * n, 8 * math.sqrt(n)) and 100 * letters >= 85 * chars
    failed = n < 10 or 100 * len(repeated) > 20 * n
    return "".join("-" if x else "0" for x in against) + ("+" if prose else "0"), failed


def plain_posteriors(patterns):
    """Expectation-maximisation, pattern by pattern and rule by rule."""
    total = sum(patterns.values())
    good = {p: 0.1 if "-" in p else 0.95 for p in patterns}
    share = min(0.95, max(0.5, sum(c for p, c in patterns.items() if "-" not in p) / total))
    for _ in range(200):
        new = {}
        for p in patterns:
            odds = math.log(share / (1 - share))
            for k, vote in enumerate(p):
                if vote == "0":
                    continue
                rate = []
                for side in (good, {q: 1 - g for q, g in good.items()}):
                    mass = sum(c * side[q] for q, c in patterns.items())
                    votes = sum(c * side[q] for q, c in patterns.items() if q[k] == vote)
                    rate.append((votes + 0.5) / (mass + 1.5))
                evidence = math.log(rate[0] / rate[1])
                odds += max(evidence, 0) if vote == "+" else min(evidence, 0)
            new[p] = 1 / (1 + math.exp(-max(-50, min(50, odds))))
        change = max(abs(new[p] - good[p]) for p in good)
        good = new if change >= 1e-9 else good
        if change < 1e-9:
            break
    return good


@pytest.mark.parametrize("bad", [0, 3000])
def test_posteriors_and_verdicts(spark, bad):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    rows += [(10**6 + k, f"$$ ## {k % 5} " * 12) for k in range(bad)]
    told = {i: plain_votes(text) for i, text in rows}
    quality_of = plain_posteriors(Counter(v for v, _ in told.values()))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = rules.judge(df).collect()
    assert len(found) == len(rows)
    for r in found:
        votes, failed = told[r.doc_id]
        assert r.votes == votes and r.base_failed == failed
        assert abs(r.quality - quality_of[votes]) < 1e-6
        assert r.kept == (not failed and quality_of[votes] >= 0.5)
