"""Near-duplicate texts by HyperMinHash.

A text is its set of word shingles. A sketch has one 16-bit register per bucket of the hash
space: the number of leading zeros of the smallest hash in the bucket and its next bits.
Buckets without a shingle take the register of another bucket, in an order of their own, so
that short texts get full sketches as well. Bands of registers put similar sketches into common lists, a
Jaccard estimate that allows for registers equal by chance sorts out the rest, and what
remains is verified on the full shingle sets.
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
from parcelstats.llm.words import BASE, blocks, mix, shingle_sets

BUCKET_BITS = 7
REGISTERS = 1 << BUCKET_BITS
MANTISSA_BITS = 10
#: Registers per band: texts that share three quarters of their shingles miss all 32 bands
#: with a probability of (1 - 0.75**4)**32, about 5 in a million.
BAND = 4
BANDS = REGISTERS // BAND
#: Sets of at most this many shingles are not judged by an estimate but by a bound: each bucket
#: that differs holds a shingle that only one of the sets has.
SMALL = 200
#: Pairs of larger sets with an estimate this far below the threshold are dropped; over five
#: standard errors.
MARGIN = 0.2
#: Sets of at most this many shingles, and those large enough to be linked with one, meet in
#: lists of their smallest shingles too: sets that share enough share one of these.
SHORT = 32
#: Members of a list compared in one go when a list holds texts of several components.
BLOCK = 1024
#: Shingles in a block of members that come with their sets (8 bytes each).
BLOCK_SHINGLES = 1 << 22
#: A part of a list: its band's key and the two blocks that it compares.
LIST = ["band", "low", "high"]
SEED = 7


def registers(text: np.ndarray, hashed: np.ndarray, n_texts: int) -> np.ndarray:
    """Sketches of texts given as (text, hash) in order; rows without a shingle are zero."""
    bucket = (hashed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    least = np.full((n_texts, REGISTERS), np.uint64(2**64 - 1))
    np.minimum.at(least.reshape(-1), text * REGISTERS + bucket, hashed << np.uint64(BUCKET_BITS))
    filled = np.zeros((n_texts, REGISTERS), dtype=bool)
    filled.reshape(-1)[text * REGISTERS + bucket] = True
    out = _register(least)
    out[~filled] = 0
    order = _orders()
    row, column = np.nonzero(~filled & filled.any(axis=1, keepdims=True))
    for step in range(1, REGISTERS):
        if not len(row):
            break
        source = order[column, step]
        ready = filled[row, source]
        out[row[ready], column[ready]] = out[row[ready], source[ready]]
        row, column = row[~ready], column[~ready]
    # The buckets that have a shingle of their own, as bits behind the registers.
    return np.hstack([out, np.packbits(filled, axis=1).view(np.uint16)])


def _register(least: np.ndarray) -> np.ndarray:
    """Leading zeros in the upper bits, the bits after the leading one in the lower."""
    room = (1 << (16 - MANTISSA_BITS)) - 1
    zeros = np.zeros(least.shape, np.uint64)
    value = least.copy()
    for shift in (32, 16, 8, 4, 2, 1):
        small = value < (np.uint64(1) << np.uint64(64 - shift))
        zeros += np.where(small, np.uint64(shift), np.uint64(0))
        value = np.where(small, value << np.uint64(shift), value)
    mantissa = (value << np.uint64(1)) >> np.uint64(64 - MANTISSA_BITS)
    zeros = np.minimum(zeros, np.uint64(room))
    return ((zeros << np.uint64(MANTISSA_BITS)) | mantissa).astype(np.uint16)


_order: list[np.ndarray] = []


def _orders() -> np.ndarray:
    """For each bucket, all buckets in the order in which it looks for a register."""
    if not _order:
        key = mix(np.arange(REGISTERS * REGISTERS, dtype=np.uint64) + np.uint64(SEED))
        key = key.reshape(REGISTERS, REGISTERS)
        np.fill_diagonal(key, 0)
        _order.append(np.argsort(key, axis=1))
    return _order[0]


def chance(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Probability that registers of unrelated sets of these sizes are equal.

    The smallest of m hashes lies in the octave of z leading zeros with probability
    (1 - 2**-(z+1))**m - (1 - 2**-z)**m; within it the mantissa is taken as even.
    """
    out = np.zeros(len(n_a))
    m_a, m_b = np.maximum(n_a / REGISTERS, 1), np.maximum(n_b / REGISTERS, 1)
    for z in range(1 << (16 - MANTISSA_BITS)):
        low, high = 1 - 2.0 ** -(z + 1), 1 - 2.0**-z
        out += (low**m_a - high**m_a) * (low**m_b - high**m_b)
    return out / (1 << MANTISSA_BITS)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity of pairs of sketches, corrected for registers equal by chance."""
    equal = (a[:, :REGISTERS] == b[:, :REGISTERS]).mean(axis=1)
    c = chance(n_a, n_b)
    return (equal - c) / (1 - c)


def may_link(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """Whether pairs of sketches can belong to linked sets: small ones by a bound that holds for
    certain, larger ones by their estimate."""
    fits = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
    small = fits & (np.minimum(n_a, n_b) <= SMALL)
    out = fits & ~small
    out[out] = estimate(a[out], b[out], n_a[out], n_b[out]) >= percent / 100 - MARGIN
    filled_a, filled_b = (np.ascontiguousarray(x[small, REGISTERS:]).view(np.uint8) for x in (a, b))
    both = np.unpackbits(filled_a & filled_b, axis=1).astype(bool)
    unlike = (a[small, :REGISTERS] != b[small, :REGISTERS]) & both
    apart = unlike.sum(axis=1) + np.bitwise_count(filled_a ^ filled_b).sum(axis=1)
    total = n_a[small] + n_b[small]
    out[small] = 100 * (total - apart) >= percent * (total + apart)
    return out


def _first_shingles(text: np.ndarray, hashed: np.ndarray, count: np.ndarray, percent: int) -> list[bytes | None]:
    """Smallest shingles of each short set, of which linked sets have one in common."""
    needed = -(-percent * count // 100)
    used = np.where(count <= SHORT * 100 // percent, count - needed + 1, 0) * (count > 0)
    begin = np.cumsum(count) - count
    return [
        hashed[b : b + n].tobytes() if n else None for b, n in zip(begin.tolist(), used.tolist(), strict=True)
    ]


def _sketch(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                n = block.n_texts
                text, hashed = shingle_sets(block.words(lower=True), n, size)
                count = np.bincount(text, minlength=n)
                sketch = registers(text, hashed, n)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(block.first, n),
                        pa.array(count.astype(np.int64)),
                        pa.array(_set_hash(text, hashed, count), mask=count == 0),
                        pa.array([r.tobytes() if c else None for r, c in zip(sketch, count)], pa.binary()),
                        pa.array(_first_shingles(text, hashed, count, percent), pa.binary()),
                    ],
                    names=["id", "n_shingles", "node", "sketch", "first"],
                )

    return run


def _set_hash(text: np.ndarray, hashed: np.ndarray, count: np.ndarray) -> np.ndarray:
    """64-bit hash of each set: equal sets, and in practice only those, are equal."""
    total = np.zeros((2, len(hashed) + 1), np.uint64)
    np.cumsum(mix(hashed ^ np.uint64(BASE)), out=total[0, 1:])
    np.cumsum(mix(hashed + np.uint64(SEED)), out=total[1, 1:])
    end = np.cumsum(count)
    own = total[:, end] - total[:, end - count]
    return mix(own[0] ^ mix(own[1] + count.astype(np.uint64))).view(np.int64)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sketch = np.ascontiguousarray(_sketches(batch.column(1))[:, :REGISTERS]).view(np.uint64)
        number = np.arange(BANDS, dtype=np.uint64)
        keys = mix(mix(sketch) + number).reshape(-1)
        first = batch.column(3)
        n_first = np.array([len(x) // 8 for x in first.fill_null(b"").to_pylist()])
        shingles = np.frombuffer(b"".join(x for x in first.to_pylist() if x), np.uint64)
        row = np.concatenate([np.repeat(np.arange(batch.num_rows), BANDS), np.repeat(np.arange(batch.num_rows), n_first)])
        keys = np.concatenate([keys, mix(shingles ^ np.uint64(BASE))])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys.view(np.int64)),
                batch.column(0).take(pa.array(row)),
                batch.column(2).take(pa.array(row)),
            ],
            names=["band", "node", "n_shingles"],
        )


def _sketches(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS + REGISTERS // 16)


def _likely(percent: int):
    """Pairs whose sketches allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            a, b, n_a, n_b = (batch.column(k).to_numpy(False) for k in range(4))
            keep = may_link(_sketches(batch.column(4)), _sketches(batch.column(5)), n_a, n_b, percent)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])

    return run


def _own_pairs(band, component, whole, block, count, sketch, percent: int):
    """Pairs of different components within one list whose sketches allow a link.

    Yields positions (i, j), i < j, for some members i at a time. A pair belongs to the list
    of its first equal band, so that no pair turns up in two of them; without an equal band
    it belongs to each list of a shingle that brings it together.
    """
    n = len(component)
    bands = np.ascontiguousarray(sketch[:, :REGISTERS]).view(np.uint64)
    for at in range(0, n, 64):
        rows = np.arange(at, min(at + 64, n))
        i, j = (x.ravel() for x in np.meshgrid(rows, np.arange(n), indexing="ij"))
        use = (i < j) & (component[i] != component[j]) & (whole | (block[i] != block[j]))
        i, j = i[use], j[use]
        if not len(i):
            continue
        keep = may_link(sketch[i], sketch[j], count[i], count[j], percent)
        i, j = i[keep], j[keep]
        if not len(i):
            continue
        equal = bands[i] == bands[j]
        place = np.argmax(equal, axis=1)
        first = mix(mix(bands[i, place]) + place.astype(np.uint64)).view(np.int64)
        own = (first == band) | ~equal.any(axis=1)
        yield i[own], j[own]


def _members_across(percent: int):
    """Members of lists that have a pair to verify with another component of their list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, edges in whole_groups(batches, LIST):
            band, low, high, block, component, count = (
                table.column(c).to_numpy() for c in (*LIST, "block", "component", "n_shingles")
            )
            sketch = _sketches(table.column("sketch"))
            used = np.zeros(table.num_rows, dtype=bool)
            for start, end in zip(edges[:-1], edges[1:], strict=True):
                part = slice(start, end)
                whole = low[start] == high[start]
                for i, j in _own_pairs(
                    band[start], component[part], whole, block[part], count[part], sketch[part], percent
                ):
                    used[start + i] = True
                    used[start + j] = True
            yield from table.filter(pa.array(used)).to_batches()

    return run


def _links_across(percent: int):
    """Verified links between components of a list; as many as join what hangs together.

    The sets of the members come along, so that pairs never leave the task. A pair whose
    ends have been joined by links found before is not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, edges in whole_groups(batches, LIST):
            band, low, high, block, component, count, node = (
                table.column(c).to_numpy() for c in (*LIST, "block", "component", "n_shingles", "node")
            )
            sketch = _sketches(table.column("sketch"))
            links: list[tuple[int, int]] = []
            for start, end in zip(edges[:-1], edges[1:], strict=True):
                part = slice(start, end)
                sets = _Sets(table.column("shingles").slice(start, end - start))
                joined = component[part].copy()
                whole = low[start] == high[start]
                for i, j in _own_pairs(
                    band[start], component[part], whole, block[part], count[part], sketch[part], percent
                ):
                    begins = np.flatnonzero(np.r_[True, i[1:] != i[:-1]]) if len(i) else []
                    for one, others in zip(i[begins], np.split(j, begins[1:])):
                        others = others[joined[others] != joined[one]]
                        for other in others[sets.similar(one, others, percent)]:
                            if joined[other] != joined[one]:
                                joined[joined == joined[other]] = joined[one]
                                links.append((node[start + one], node[start + other]))
            a, b = np.array(links, np.int64).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"]
            )

    return run


class _Sets:
    """Sorted shingle hashes of the members of a list, one after another."""

    def __init__(self, column):
        packed = column.combine_chunks().cast(pa.large_binary())
        places, content = packed.buffers()[1:]
        edge = np.frombuffer(places, np.int64)[packed.offset : packed.offset + len(packed) + 1]
        self.values = np.frombuffer(content, np.uint8)[edge[0] : edge[-1]].view(np.uint64)
        self.edge = (edge - edge[0]) // 8

    def similar(self, one: int, others: np.ndarray, percent: int) -> np.ndarray:
        """Which of the others share so many hundredths of their union with one."""
        own = self.values[self.edge[one] : self.edge[one + 1]]
        size = self.edge[others + 1] - self.edge[others]
        found = np.zeros(len(others), dtype=bool)
        fit = np.flatnonzero(100 * np.minimum(size, len(own)) >= percent * np.maximum(size, len(own)))
        for at in range(0, len(fit), 256):
            some = fit[at : at + 256]
            begin = np.cumsum(size[some]) - size[some]
            place = np.repeat(self.edge[others[some]] - begin, size[some])
            values = self.values[place + np.arange(len(place))]
            near = np.minimum(np.searchsorted(own, values), len(own) - 1)
            shared = np.add.reduceat((own[near] == values).astype(np.int64), begin)
            found[some] = 100 * shared >= percent * (size[some] + len(own) - shared)
        return found


def _likely_stars(percent: int):
    """Within each list the member nearest to all, with the others that come near it.

    Copies of one text are mostly nearer to it than to each other. The text agrees most with
    the commonest register of every place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, edges in whole_groups(batches, LIST):
            node, component, count = (
                table.column(c).to_numpy() for c in ("node", "component", "n_shingles")
            )
            sketch = _sketches(table.column("sketch"))
            for start, end in zip(edges[:-1], edges[1:], strict=True):
                registers_ = sketch[start:end, :REGISTERS]
                own = np.sort(registers_, axis=0)
                new = np.ones(own.shape, dtype=bool)
                new[1:] = own[1:] != own[:-1]
                first = np.where(new, np.arange(len(own))[:, None], 0)
                length = np.arange(len(own))[:, None] - np.maximum.accumulate(first, axis=0)
                common = own[np.argmax(length, axis=0), np.arange(REGISTERS)]
                centre = start + int(np.argmax((registers_ == common).sum(axis=1)))
                j = np.arange(start, end)
                j = j[component[j] != component[centre]]
                i = np.full(len(j), centre)
                keep = may_link(sketch[i], sketch[j], count[i], count[j], percent)
                i, j = i[keep], j[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(node[i], node[j])), pa.array(np.maximum(node[i], node[j]))],
                    names=["a", "b"],
                )

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(0)):
                n = block.n_texts
                text, hashed = shingle_sets(block.words(lower=True), n, size)
                count = np.bincount(text, minlength=n)
                edge = np.concatenate([[0], np.cumsum(count)])
                raw = hashed.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(_set_hash(text, hashed, count)),
                        pa.array([raw[8 * a : 8 * b] for a, b in zip(edge[:-1], edge[1:])], pa.binary()),
                    ],
                    names=["node", "shingles"],
                )

    return run


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            for k in range(batch.num_rows):
                a, b = (np.frombuffer(batch.column(c)[k].as_buffer(), np.uint64) for c in (2, 3))
                if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
                    continue
                both = np.sort(np.concatenate([a, b]))
                shared = int((both[1:] == both[:-1]).sum())
                keep[k] = 100 * shared >= percent * (len(a) + len(b) - shared)
            chosen = pa.array(keep)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(chosen), batch.column(1).filter(chosen)], names=["a", "b"]
            )

    return run


def link_near_texts(
    docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 75
) -> DataFrame:
    """One row per document: (id, n_shingles, component_id, kept).

    Documents whose sets of ``size``-word shingles have at least ``percent`` hundredths of
    their union in common are linked; ``component_id`` is the smallest id reachable by links,
    ``kept`` marks the row with it. Null, empty and wordless texts have no shingles and no
    links. A row without an id cannot be named: it keeps a null component and is kept.
    Repeated rows are copies of each other; those with the smallest id are all kept. An
    empty table gives an empty result; other columns are ignored.

    Equal sets are found by a 64-bit hash and come down to one member first. A list of
    sketches is not expanded into pairs: each member is compared with the smallest of its
    list, and only lists that still hold several components afterwards are compared member
    by member, across components, in blocks. There the full sets come into the task, and
    what leaves it is the links that join components, not the pairs.
    """
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    sketches = settle(
        rows.mapInArrow(
            _sketch(size, percent),
            f"id {rows.schema['id'].dataType.simpleString()}, n_shingles long, node long, sketch binary, first binary",
        )
    )
    named = sketches.filter("id is not null and node is not null")
    classes = named.groupBy("node").agg(F.min("id").alias("smallest"), F.count("*").alias("members"))
    # The sketch of a class is that of its smallest member, looked up by id.
    owner = (
        named.select("id", "node", "n_shingles", "sketch", "first")
        .join(classes, "node")
        .filter("id = smallest")
        .dropDuplicates(["node"])
    )
    one = settle(owner.select("node", "smallest", "members", "n_shingles", "sketch", "first"))
    banded = one.select("node", "sketch", "n_shingles", "first").mapInArrow(
        _bands, "band long, node long, n_shingles long"
    )
    pivots = (
        banded.groupBy("band")
        .agg(F.min("node").alias("pivot"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("band", "pivot")
    )
    lists = settle(banded.join(pivots, "band"))
    short = one.select("node", "n_shingles", "sketch")
    starred = lists.filter("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    likely = settle(
        _with_both(starred.distinct(), short, "n_shingles", "sketch").mapInArrow(
            _likely(percent), "a long, b long"
        )
    )
    links = _verify(likely, rows, one, size, percent)
    # Lists that hold several components are compared again: first with the member in their
    # middle, then, where components are left, member by member across components.
    reach = settle(components(links))
    more = settle(
        _mixed_lists(lists, reach, short)
        .mapInArrow(_likely_stars(percent), "a long, b long")
        .distinct()
        .join(likely, ["a", "b"], "left_anti")
    )
    links = settle(links.union(_verify(more, rows, one, size, percent)))
    reach = settle(components(links))
    mixed = _mixed_lists(lists, reach, short)
    members = settle(mixed.mapInArrow(_members_across(percent), mixed.schema))
    sets = _shingles(members.select("node").distinct(), rows, one, size)
    across = (
        members.join(sets, "node")
        .repartition(*LIST)
        .sortWithinPartitions(*LIST)
        .mapInArrow(_links_across(percent), "a long, b long")
    )
    links = settle(links.union(across))
    reach = components(links)
    named_classes = one.select("node", "smallest", "members").join(reach, "node", "left")
    named_classes = settle(
        named_classes.filter("component is not null or members > 1").withColumn(
            "component", F.coalesce("component", "node")
        )
    )
    least = named_classes.groupBy("component").agg(F.min("smallest").alias("component_id"))
    found = named_classes.join(least, "component").select("node", "component_id")
    component = F.coalesce("component_id", "id")
    return (
        sketches.select("id", "n_shingles", "node")
        .join(found, "node", "left")
        .withColumn("component_id", F.when(F.col("id").isNotNull(), component))
        .select(
            F.col("id").alias(id),
            "n_shingles",
            "component_id",
            F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
        )
    )


def _mixed_lists(lists: DataFrame, reach: DataFrame, short: DataFrame) -> DataFrame:
    """Members of lists with several components, by list and pair of its blocks, in order."""
    placed = lists.join(reach, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = (
        placed.groupBy("band")
        .agg(
            F.min("component").alias("first"), F.max("component").alias("last"),
            F.count("*").alias("n"), F.sum("n_shingles").alias("total"),
        )
        .filter("first <> last and n > 2")
        .select(
            "band",
            F.ceil(F.greatest(F.col("n") / BLOCK, F.col("total") / BLOCK_SHINGLES)).cast("int").alias("n_blocks"),
        )
    )
    return (
        placed.join(mixed, "band")
        .join(short.select("node", "sketch"), "node")
        .withColumn("block", F.pmod("node", "n_blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .select(*LIST, "block", "node", "component", "n_shingles", "sketch")
        .repartition(*LIST)
        .sortWithinPartitions(*LIST)
    )


def _with_both(pairs: DataFrame, values: DataFrame, *columns: str) -> DataFrame:
    """Pairs (a, b) with the named columns of both ends, those of a first."""
    left = values.select(F.col("node").alias("a"), *(F.col(c).alias(f"{c}_a") for c in columns))
    right = values.select(F.col("node").alias("b"), *(F.col(c).alias(f"{c}_b") for c in columns))
    both = [f"{c}_{end}" for c in columns for end in ("a", "b")]
    return pairs.join(left, "a").join(right, "b").select("a", "b", *both)


def _verify(pairs: DataFrame, rows: DataFrame, one: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of the pairs whose full sets are similar enough."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = _shingles(nodes, rows, one, size)
    return settle(
        _with_both(pairs, sets, "shingles").mapInArrow(_verified(percent), "a long, b long")
    )


def _shingles(nodes: DataFrame, rows: DataFrame, one: DataFrame, size: int) -> DataFrame:
    """Full sets of the nodes: (node, shingles), from the text of their smallest member."""
    ids = one.join(nodes, "node").select(F.col("smallest").alias("id"))
    texts = rows.join(ids.distinct(), "id", "left_semi").select("text")
    sets = texts.mapInArrow(_sets(size), "node long, shingles binary").join(nodes, "node", "left_semi")
    return settle(sets.dropDuplicates(["node"]))
