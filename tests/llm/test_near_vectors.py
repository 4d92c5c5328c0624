"""Recall of the pivot-permutation index near its threshold, and odd tables."""

import numpy as np
import pytest

from parcelstats.llm import near_vectors as nv


def pairs(rng, n, size, low, high):
    """Rows 2k and 2k + 1 have a cosine between ``low`` and ``high``."""
    a = rng.normal(size=(n, size))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    r = rng.normal(size=(n, size))
    r -= (r * a).sum(axis=1, keepdims=True) * a
    r /= np.linalg.norm(r, axis=1, keepdims=True)
    cosine = rng.uniform(low, high, (n, 1))
    out = np.empty((2 * n, size))
    out[::2], out[1::2] = a, cosine * a + np.sqrt(1 - cosine**2) * r
    return out.astype(np.float32)


@pytest.mark.parametrize("size", [64, 128, 384, 768])
def test_no_pair_near_the_threshold_is_lost_by_the_index(size):
    rng = np.random.default_rng(size)
    tables = [nv.choose_pivots(nv.unit(rng.normal(size=(nv.SAMPLE, size)))) for _ in range(nv.TABLES)]
    vectors = nv.unit(pairs(rng, 3000, size, 0.93, 0.932).astype(float))
    sets = np.stack([nv.bits(nv.nearest(vectors, t, nv.NEAREST)) for t in tables], axis=1)
    shared = np.bitwise_count(sets[::2] & sets[1::2]).sum(axis=2)
    assert (shared.max(axis=1) >= nv.SHARED).all()
    strangers = np.bitwise_count(sets[:-2:2] & sets[2::2]).sum(axis=2).max(axis=1) >= nv.SHARED
    assert strangers.mean() < 0.01


def test_each_candidate_counts_in_one_list():
    rng = np.random.default_rng(2)
    near = [np.sort(rng.permuted(np.tile(np.arange(14), (400, 1)), axis=1)[:, : nv.NEAREST], axis=1) for _ in range(2)]
    sets = np.stack([nv.bits(x) for x in near], axis=1)
    for i in range(0, 400, 2):
        lists = []
        for t in range(2):
            both = sorted(set(near[t][i]) & set(near[t][i + 1]))
            lists += [(t * 256 + p) * 256 + q for p in both for q in both if p < q and (q - p) % 2 == 0]
        own = [
            nv.own_list(sets[i : i + 1], sets[i + 1 : i + 2], np.array([number]))[0] for number in lists
        ]
        enough = any(len(set(near[t][i]) & set(near[t][i + 1])) >= nv.SHARED for t in range(2))
        assert sum(own) == enough


@pytest.mark.parametrize("size", [24, 64])
def test_links_equal_brute_force_near_the_threshold(spark, size):
    rng = np.random.default_rng(size)
    vectors = np.vstack([pairs(rng, 700, size, 0.925, 0.94), pairs(rng, 100, size, 0.9299999, 0.9300001)])
    label = np.arange(len(vectors)) // 2 % 3
    rows = [(i, v.tolist(), int(c), 1, "x") for i, (v, c) in enumerate(zip(vectors, label))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, node int, cell string").repartition(5)
    v = nv.unit(vectors.astype(np.float64))
    cosine = np.einsum("ij,kj->ik", v, v)
    linked = (cosine >= 0.93) & (label[:, None] == label)
    np.fill_diagonal(linked, False)
    # Which side of the threshold is rounding's choice where the last digits decide.
    clear = np.abs(np.einsum("ij,ij->i", v[::2], v[1::2]) - 0.93).repeat(2) > 1e-14
    found = {r.vec_id: r.n_links for r in nv.link_near_vectors(df).collect()}
    assert all(found[i] == linked[i].sum() for i in np.flatnonzero(clear))
    assert linked.sum() > 700


def test_rows_without_ids_and_equal_vectors(spark):
    rows = [(None, [1.0, 2.0, 3.0], 1), (4, [1.0, 2.0, 3.0], 1), (4, [1.0, 2.0, 3.0], 1), (5, [1.0, 2.0, 3.0], 2),
            (6, [None, 2.0], 1), (7, [3.0, -1.0, 0.0], 1)]
    found = nv.link_near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [(None, 2, 4, False), (4, 2, 4, True), (4, 2, 4, True), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True)], key=str
    )
