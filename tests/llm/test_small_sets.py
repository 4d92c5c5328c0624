"""Texts of few words at exactly the threshold: no link may be lost."""

import numpy as np
import pytest

from parcelstats.llm import near_texts as nt


def sketches(sets):
    count = np.array([len(s) for s in sets])
    text = np.repeat(np.arange(len(sets)), count)
    hashed = np.concatenate([np.sort(s) for s in sets])
    first = nt._first_shingles(text, hashed, count, 75)
    return nt.registers(text, hashed, len(sets)), count, [set(np.frombuffer(f or b"", np.uint64)) for f in first]


@pytest.mark.parametrize("shared, union", [(3, 4), (6, 8), (9, 12), (15, 20), (30, 40), (75, 100), (150, 200)])
def test_pairs_at_the_threshold_meet_and_are_not_sorted_out(shared, union):
    rng = np.random.default_rng(union)
    for _ in range(4):
        one, other = [], []
        for _ in range(5000):
            u = rng.integers(0, 2**64, union, dtype=np.uint64)
            k = shared + int(rng.integers(0, union - shared + 1))
            one.append(u[:k])
            other.append(np.concatenate([u[:shared], u[k:]]))
        (a, n_a, f_a), (b, n_b, f_b) = sketches(one), sketches(other)
        bands = lambda s: np.ascontiguousarray(s[:, : nt.REGISTERS]).view(np.uint64)
        meet = (bands(a) == bands(b)).any(axis=1) | [bool(x & y) for x, y in zip(f_a, f_b)]
        assert meet.all() and nt.may_link(a, b, n_a, n_b, 75).all()


def test_the_bound_sorts_out_unlike_sets():
    rng = np.random.default_rng(3)
    one = [rng.integers(0, 2**64, 60, dtype=np.uint64) for _ in range(500)]
    other = [np.concatenate([s[:30], rng.integers(0, 2**64, 30, dtype=np.uint64)]) for s in one]
    (a, n_a, _), (b, n_b, _) = sketches(one), sketches(other)
    assert nt.may_link(a, b, n_a, n_b, 75).mean() < 0.02


def test_short_texts_are_linked(spark):
    rows = []
    for kind, (n, more) in enumerate([(7, 1), (10, 2), (13, 3), (19, 5), (34, 10)]):
        for k in range(400):
            words = [f"w{kind}x{k}x{i}" for i in range(n + more)]
            rows += [(len(rows), " ".join(words[:n])), (len(rows) + 1, " ".join(words))]
            # One word less in common, and no link.
            rows.append((len(rows), " ".join(words[: n - 1] + [f"z{kind}x{k}x{i}" for i in range(more + 2)])))
    found = nt.link_near_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    component = {r.doc_id: r.component_id for r in found.collect()}
    for first in range(0, len(rows), 3):
        assert component[first] == component[first + 1] == first
        assert component[first + 2] == first + 2
