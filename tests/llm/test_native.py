"""Operators that stay on DataFrame functions, their helpers' names, and mixing against water filling."""

import math
from random import Random

import pytest
from pyspark.sql import functions as F

from parcelstats.llm import mixing, queries
from tests.helpers import plan

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op7_license_scan", "op8_mix_sources", "op9_secret_scan"])
def test_plans_have_no_python_and_no_cross_join(spark, name):
    text = plan(queries.QUERIES[name](spark, SMALL))
    for unwanted in ("Python", "Pandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in text


def test_mixing_keeps_columns_named_like_its_helpers(spark):
    taken = [*mixing.HELPERS, "_copy_0", "_mix_aside_1"]
    rows = [(k, "a few words " * (k % 5), f"s{k % 3}", *range(len(taken))) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{c} int" for c in taken))
    mixed = mixing.mix_sources(df)
    assert set(mixed.columns) == {*df.columns, "mix_size", "mix_source_size", "mix_target", "mix_copies"}
    plain = {r.doc_id: r.mix_copies for r in mixing.mix_sources(df.select("doc_id", "text", "source")).collect()}
    for r in mixing.repeat_copies(mixed).collect():
        assert [r[c] for c in taken] == list(range(len(taken))) and plain[r.doc_id] > 0
    renamed = mixing.mix_sources(df.select("doc_id", "text", F.col("source").alias("_s")), source="_s")
    assert {r.doc_id: r.mix_copies for r in renamed.collect()} == plain


@pytest.mark.parametrize("seed", range(4))
def test_targets_are_those_of_water_filling(spark, seed):
    random = Random(seed)
    sizes = {f"s{k:02d}": random.choice([1, 10, 100, 10_000]) * random.randint(1, 9) for k in range(random.randint(1, 9))}
    rows = [(name, 1, size) for name, size in sizes.items()]
    found = mixing.targets(spark.createDataFrame(rows, "source string, n long, source_size long"))
    weights = {name: float(1 + k % 3) for k, name in enumerate(sorted(sizes))}
    # Pour what is left over the sources that are not full, by weight, until none runs over.
    goal, left, open_ = {}, float(sum(sizes.values())), set(sizes)
    while open_:
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not full:
            goal |= share
            break
        goal |= {s: 3.0 * sizes[s] for s in full}
        left -= sum(3.0 * sizes[s] for s in full)
        open_ -= full
    for r in found.collect():
        assert math.isclose(r.target, goal[r.source], rel_tol=1e-9)
