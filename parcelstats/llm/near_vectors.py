"""Near-duplicate embeddings by a pivot-permutation index.

Every vector is described by its nearest reference points (pivots) in each of two tables of
them. Vectors of which one table finds enough shared pivots are candidates. Lists are kept per
pair of pivots that a vector has among its nearest; since pivots fall into two classes and
any three of them have two of one class, lists of pairs within a class are enough for vectors
that share three. The shared pivots are counted from bit sets that travel with the vectors.
These travel in 16 bits a component with the length of what rounding has cut off, which
decides nearly all candidates; the others are verified by their cosine in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelstats.llm.components import components
from parcelstats.llm.runs import pairs_of_runs, whole_groups
from parcelstats.llm.tables import settle

#: Vectors that pivots are chosen from, and the most pivots (their numbers fit 4 words of bits).
SAMPLE = 2048
MAX_PIVOTS = 256
#: Pivots closer to each other than this cosine say too little about a vector.
SPREAD = 0.7
#: Tables of pivots, nearest pivots of each that are kept for a vector, and how many of one table
#: two vectors must share.
TABLES = 2
NEAREST = 8
SHARED = 3
#: Members of a list compared in one go; longer lists are cut into blocks, all pairs of
#: which are compared, each in a group of its own.
BLOCK = 2048
WORDS = MAX_PIVOTS // 64
#: Pivots with an even number make one class, the others the other.
EVEN = np.uint64(0x5555555555555555)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; scaled by the largest component first, so nothing overflows."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(False).astype(np.float64).reshape(len(column), -1)


def choose_pivots(sample: np.ndarray) -> np.ndarray:
    """Pivots in the order of the sample, leaving out those near an earlier one."""
    chosen: list[np.ndarray] = []
    for vector in sample:
        if not chosen or np.max(np.stack(chosen) @ vector) < SPREAD:
            chosen.append(vector)
        if len(chosen) == MAX_PIVOTS:
            break
    return np.stack(chosen)


def nearest(vectors: np.ndarray, pivots: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the ``n`` nearest pivots of each vector, nearest first, ties by number."""
    return np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :n]


def bits(numbers: np.ndarray) -> np.ndarray:
    """Sets of pivot numbers as rows of 64-bit words."""
    out = np.zeros((len(numbers), WORDS), np.uint64)
    for k in range(numbers.shape[1]):
        out[np.arange(len(numbers)), numbers[:, k] // 64] |= np.uint64(1) << (
            numbers[:, k] % 64
        ).astype(np.uint64)
    return out


def rounded(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors as (16-bit components, scale, length of the difference)."""
    scale = np.abs(vectors).max(axis=1) / 32767
    whole = np.rint(vectors / scale[:, None]).astype(np.int16)
    rest = vectors - whole * scale[:, None]
    # The difference is told a little longer than it is, for the rounding of sums and products.
    return whole, scale, np.sqrt((rest * rest).sum(axis=1)) + 1e-12


def _packed(sets: np.ndarray, vectors: np.ndarray) -> pa.Array:
    """Bit sets, scale, error and components of each vector as bytes."""
    whole, scale, error = rounded(vectors)
    head = np.hstack([sets.view(np.float64), scale[:, None], error[:, None]])
    return pa.array([h.tobytes() + w.tobytes() for h, w in zip(head, whole)], pa.binary())


HEAD = 8 * (TABLES * WORDS + 2)


def _unpacked(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bit sets per table, vectors, errors)."""
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
    head = np.ascontiguousarray(raw[:, :HEAD]).view(np.float64)
    sets = np.ascontiguousarray(head[:, :-2]).view(np.uint64).reshape(-1, TABLES, WORDS)
    vectors = np.ascontiguousarray(raw[:, HEAD:]).view(np.int16) * head[:, -2:-1]
    return sets, vectors, head[:, -1]


def _postings(tables: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            vectors = unit(matrix(batch.column(3)))
            sets, rows, lists = [], [], []
            for t, pivots in enumerate(tables):
                n = min(NEAREST, len(pivots))
                near = np.sort(nearest(vectors, pivots, n), axis=1)
                sets.append(bits(near))
                one, two = np.triu_indices(n, 1)
                alike = (near[:, one] - near[:, two]) % 2 == 0
                row, k = np.nonzero(alike)
                rows.append(row)
                lists.append((t * MAX_PIVOTS + near[row, one[k]]) * MAX_PIVOTS + near[row, two[k]])
            row = pa.array(np.concatenate(rows))
            packed = _packed(np.hstack(sets), vectors)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(row),
                    pa.array(np.concatenate(lists).astype(np.int32)),
                    batch.column(1).take(row),
                    batch.column(2).take(row),
                    packed.take(row),
                ],
                names=["cell", "list", "node", "copies", "packed"],
            )

    return run


def own_list(sets_a: np.ndarray, sets_b: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Whether the list with the given number is the one in which each pair of bit sets counts.

    That is in the first table in which enough pivots are shared, and there the two smallest
    shared pivots of the even class, or of the odd one where fewer than two are even.
    """
    table, first, second = number // MAX_PIVOTS**2, number // MAX_PIVOTS % MAX_PIVOTS, number % MAX_PIVOTS
    both = sets_a & sets_b
    enough = np.bitwise_count(both).sum(axis=2) >= SHARED
    own = enough.any(axis=1) & (enough.argmax(axis=1) == table)
    both = both[np.arange(len(both)), table]
    even = first % 2 == 0
    kind = both & np.where(even, EVEN, ~EVEN)[:, None]
    below = np.zeros_like(both)
    for w in range(WORDS):
        place = np.clip(second - 64 * w, 0, 64)
        below[:, w] = np.where(
            place == 64,
            np.uint64(2**64 - 1),
            (np.uint64(1) << np.minimum(place, 63).astype(np.uint64)) - np.uint64(1),
        )
    own &= ((kind & below) == bits(first[:, None])).all(axis=1)
    return own & (even | (np.bitwise_count(both & EVEN).sum(axis=1) < 2))


PARTIAL = "node long, linked long, root long, other long"


def _linked(threshold: float):
    """Within each group: (node, copies linked to it, a smaller node it hangs together with), and
    pairs (node, other) that rounding leaves undecided."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, edges in whole_groups(batches, ["cell", "list", "low", "high"]):
            node = table.column("node").to_numpy()
            copies = table.column("copies").to_numpy()
            block = table.column("block").to_numpy()
            one_block = table.column("low").to_numpy() == table.column("high").to_numpy()
            number = table.column("list").to_numpy().astype(np.int64)
            sets, vectors, error = _unpacked(table.column("packed"))
            sizes = np.diff(edges)
            least = threshold - 3 * error.max(initial=0)
            found = [
                _small(edges, sizes <= 32),
                *(_large(vectors, edges[k], edges[k + 1], least) for k in np.flatnonzero(sizes > 32)),
            ]
            i, j = (np.concatenate(x) for x in zip(*found, strict=True))
            own = one_block[i] | (block[i] != block[j])
            i, j = i[own], j[own]
            own = own_list(sets[i], sets[j], number[i]) if len(i) else own
            i, j = i[own], j[own]
            cosine = np.einsum("ij,ij->i", vectors[i], vectors[j])
            slack = error[i] + error[j] + error[i] * error[j]
            unsure = (cosine + slack >= threshold) & (cosine - slack < threshold)
            other = pa.record_batch(
                [pa.array(node[i[unsure]]), pa.nulls(int(unsure.sum()), pa.int64()),
                 pa.nulls(int(unsure.sum()), pa.int64()), pa.array(node[j[unsure]])],
                names=["node", "linked", "root", "other"],
            )
            yield other
            i, j = i[cosine - slack >= threshold], j[cosine - slack >= threshold]
            links = np.bincount(i, copies[j], len(node)) + np.bincount(j, copies[i], len(node))
            root = _roots(node, i, j)
            out = np.flatnonzero(links > 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[out]), pa.array(links[out].astype(np.int64)), pa.array(root[out]),
                 pa.nulls(len(out), pa.int64())],
                names=["node", "linked", "root", "other"],
            )

    return run


def _exact(threshold: float):
    """Undecided pairs by their cosine in double precision: both ends' links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            a, b, n_a, n_b = (batch.column(k).to_numpy(False) for k in range(4))
            cosine = np.einsum("ij,ij->i", unit(matrix(batch.column(4))), unit(matrix(batch.column(5))))
            keep = cosine >= threshold
            a, b, n_a, n_b = a[keep], b[keep], n_a[keep], n_b[keep]
            root = np.minimum(a, b)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x)) for x in ((a, b), (n_b, n_a), (root, root))],
                names=["node", "linked", "root"],
            )

    return run


def _small(edges: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, sizes = edges[:-1][chosen], np.diff(edges)[chosen]
    begins = np.concatenate([[0], np.cumsum(sizes)])
    rows = np.repeat(starts - begins[:-1], sizes) + np.arange(begins[-1])
    i, j = pairs_of_runs(begins)
    return rows[i], rows[j]


def _large(vectors, start, end, least) -> tuple[np.ndarray, np.ndarray]:
    left, right = [], []
    for a in range(start, end, 512):
        part = vectors[a : min(a + 512, end)] @ vectors[a:end].T
        i, j = np.nonzero(np.triu(part, 1) >= least)
        left.append(i + a)
        right.append(j + a)
    return np.concatenate(left), np.concatenate(right)


def _roots(node: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest node of each row's part of the graph, as far as these pairs show it."""
    root = node.copy()
    while len(i):
        low = np.minimum(root[i], root[j])
        moved = (root[i] != low) | (root[j] != low)
        if not moved.any():
            break
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
    return root


def usable(column: str):
    """Whether a vector has components, all of them finite, and is not zero."""
    size = F.size(column)
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((size > 0) & finite & F.exists(column, lambda x: x != 0), F.lit(False))


def link_near_vectors(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    within: str = "label",
    threshold: float = 0.93,
) -> DataFrame:
    """One row per vector: (id, n_links, component_id, kept).

    Only vectors with the same value of ``within`` (not null) and the same number of
    components are compared. ``n_links`` counts the other rows with a cosine of at least
    ``threshold``, ``component_id`` is the smallest id reachable by links, ``kept`` marks
    the row with that id. Null, zero and non-finite vectors and rows with a null
    ``within`` have no links. Equal vectors are compared once and counted as often as they
    occur. A null id never names a component while there is another one. An empty table gives
    an empty result; other columns are ignored.

    Pivots come from a sample of at most ``SAMPLE`` distinct vectors, the two tables from its two
    ends; every vector is indexed. A list of any length is compared whole, in blocks of
    ``BLOCK``. Links of vectors that share fewer than ``SHARED`` of their ``NEAREST`` pivots in both
    tables are lost; of 20,000 random pairs at a cosine of 0.931 none were, at 64 and at 768
    components with 256 pivots.
    """
    rows = vectors.select(
        F.col(id).alias("id"), F.col(within).alias("cell"), F.col(vector).alias("v"),
    ).withColumn("usable", usable("v") & F.col("cell").isNotNull())
    rows = rows.withColumn("v", F.when(F.col("usable"), F.col("v").cast("array<double>")))
    rows = rows.withColumn("node", F.when(F.col("usable"), F.xxhash64("cell", "v"))).withColumn(
        "cell", F.xxhash64("cell", F.size("v"))
    )
    classes = settle(
        rows.filter("usable").groupBy("cell", "node", "v").agg(F.count("*").alias("copies"), F.min("id").alias("smallest"))
    )
    parts = []
    for (size,) in classes.select(F.size("v")).distinct().collect():
        own = classes.filter(F.size("v") == size)
        sample = own.orderBy("node").limit(SAMPLE).select("v").toPandas()["v"]
        known = unit(np.stack(sample.to_numpy()))
        tables = [choose_pivots(known), choose_pivots(known[::-1])]
        few = min(map(len, tables)) < SHARED
        parts.append(_all_links(own, threshold) if few else _partial_links(own, tables, threshold))
    if not parts:
        return rows.select(
            F.col("id").alias(id), F.lit(0).cast("long").alias("n_links"),
            F.col("id").alias("component_id"), F.lit(True).alias("kept"),
        )
    linked = parts[0]
    for part in parts[1:]:
        linked = linked.union(part)
    linked = settle(linked)
    counts = linked.groupBy("node").agg(F.sum("linked").alias("linked"))
    reach = components(linked, "node", "root")
    named = settle(
        classes.select("node", "copies", "smallest")
        .join(counts, "node", "left")
        .join(reach, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    least = named.groupBy("component").agg(F.min("smallest").alias("component_id"))
    named = named.join(least, "component").select(
        "node", "component_id", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")
    )
    out = rows.select("id", "node").join(named, "node", "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


POSTING = "cell long, list int, node long, copies long, packed binary"


def _partial_links(classes: DataFrame, tables: list[np.ndarray], threshold: float) -> DataFrame:
    postings = classes.select("cell", "node", "copies", "v").mapInArrow(_postings(tables), POSTING)
    return _decided(_compare(postings, threshold), classes, threshold)


def _decided(found: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """The links found, and those of the undecided pairs that hold in double precision."""
    found = settle(found)
    ends = [
        classes.select(F.col("node").alias(end), F.col("copies").alias(f"n_{end}"), F.col("v").alias(f"v_{end}"))
        for end in ("a", "b")
    ]
    pairs = found.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))
    pairs = pairs.join(ends[0], "a").join(ends[1], "b").select("a", "b", "n_a", "n_b", "v_a", "v_b")
    exact = pairs.mapInArrow(_exact(threshold), "node long, linked long, root long")
    return found.filter("other is null").select("node", "linked", "root").union(exact)


def _all_links(classes: DataFrame, threshold: float) -> DataFrame:
    """For vectors that one pivot describes alike: one list, compared whole, by blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = unit(matrix(batch.column(3))) if batch.num_rows else np.zeros((0, 1))
            if batch.num_rows == 0:
                continue
            # As if all had the same three pivots.
            shared = bits(np.tile([0, 2, 4], (batch.num_rows, 1)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.full(batch.num_rows, 2, np.int32)),
                    batch.column(1),
                    batch.column(2),
                    _packed(np.hstack([shared] * TABLES), vectors),
                ],
                names=["cell", "list", "node", "copies", "packed"],
            )

    postings = classes.select("cell", "node", "copies", "v").mapInArrow(run, POSTING)
    return _decided(_compare(postings, threshold), classes, threshold)


def _compare(postings: DataFrame, threshold: float) -> DataFrame:
    long = (
        postings.groupBy("cell", "list").count().filter(F.col("count") > BLOCK)
        .select("cell", "list", F.ceil(F.col("count") / BLOCK).cast("int").alias("n_blocks"))
    )
    blocks = F.coalesce("n_blocks", F.lit(1))
    placed = postings.join(long, ["cell", "list"], "left").withColumn(
        "block", F.pmod("node", blocks).cast("int")
    )
    spread = placed.select(
        "cell", "list", "node", "copies", "packed", "block",
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"),
    ).select(
        "cell", "list", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "node", "copies", "packed", "block",
    )
    keys = ["cell", "list", "low", "high"]
    return spread.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_linked(threshold), PARTIAL)
