"""Hard negatives per anchor and positive, by a secondary sort of packed scores.

Anchors meet all rows block by block: rows and anchors are packed into binary blocks whose
scores are one matrix product. A block hands on only what can be among an anchor's answers:
its own first positives, and of each positive's window its own first negatives. These
scores are shuffled by anchor and sorted by (anchor, descending score, id); an iterator then
walks each anchor's scores once, opens a window at every positive and gives out negatives
as they pass, holding a few numbers per anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelstats.llm.near_vectors import matrix
from parcelstats.llm.tables import settle

#: Rows and anchors in a packed block, and anchors scored in one matrix product.
ROWS = 16384
ANCHORS = 16384
AT_ONCE = 256
#: Blocks of rows that share one copy of the anchors, and partitions for each copy.
BLOCKS_PER_COPY = 2
SPREAD = 4
NO_SCORE = np.iinfo(np.int64).min


def _finite(vector: str) -> Column:
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(usable, F.lit(False))


def whole(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of each component."""
    scaled = np.floor(scale * vectors)
    if scaled.size and np.abs(scaled).max() >= 2**53:
        raise ValueError("a component is too large for exact scores")
    return scaled.astype(np.int64)


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two whole-number matrices."""
    if a.shape[1] == 0:
        return np.zeros((len(a), len(b)), np.int64)
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if bound < 2**53:  # every partial sum is a whole number that doubles hold
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if bound >= 2**62:
        raise ValueError("scores do not fit into 64 bits")
    return a @ b.T


def first_per_row(scores: np.ndarray, chosen: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``n`` highest chosen scores of each row, earlier columns first among equals."""
    if scores.size == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    masked = np.where(chosen, scores, NO_SCORE)
    if masked.shape[1] > n:
        least = np.partition(masked, masked.shape[1] - n, axis=1)[:, -n]
        chosen = chosen & (masked >= least[:, None])
    row, column = np.nonzero(chosen)
    order = np.lexsort((column, -masked[row, column], row))
    row, column = row[order], column[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    return row[rank < n], column[rank < n]


def _packed(scale: int, size: int, n_extra: int):
    """Blocks of rows: number of components, ids, labels, vectors, and ``n_extra`` lists of numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for start in range(0, len(table), size):
                part = table.slice(start, size).sort_by("id")
                widths = part.column("v").combine_chunks().value_lengths().to_numpy(False)
                for width in np.unique(widths):
                    own = part.filter(pa.array(widths == width))
                    flat = own.column("v").combine_chunks().flatten().to_numpy(False).astype(np.float64)
                    vectors = whole(flat, scale)
                    if np.abs(vectors).max(initial=0) < 2**31:
                        vectors = vectors.astype(np.int32)
                    extra = [
                        matrix(own.column(f"extra{k}")).astype(np.int64).tobytes() for k in range(n_extra)
                    ]
                    packed = [
                        own.column("id").to_numpy().tobytes(),
                        own.column("label").to_numpy().astype(np.int64).tobytes(), vectors.tobytes(), *extra,
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([width], pa.int32()), pa.array([own.num_rows], pa.int64())]
                        + [pa.array([x], pa.binary()) for x in packed],
                        names=["width", "n", "ids", "labels", "vectors", *[f"extra{k}" for k in range(n_extra)]],
                    )

    return run


BLOCK = "width int, n long, ids binary, labels binary, vectors binary"


def _unpacked(batch: pa.RecordBatch, prefix: str, i: int):
    def numbers(name: str, kind=np.int64) -> np.ndarray:
        return np.frombuffer(batch.column(prefix + name)[i].as_py(), kind)

    n, width = batch.column(prefix + "n")[i].as_py(), batch.column("width")[i].as_py()
    raw = batch.column(prefix + "vectors")[i].as_py()
    kind = np.int64 if width and len(raw) == 8 * n * width else np.int32
    vectors = np.frombuffer(raw, kind).reshape(n, width)
    return numbers("ids"), numbers("labels"), vectors


def _chunks(batches: Iterator[pa.RecordBatch]):
    """Scores of a few anchors with a block of rows: (batch, i, first anchor, anchors, rows, scores)."""
    for batch in batches:
        for i in range(batch.num_rows):
            ids, labels, vectors = _unpacked(batch, "", i)
            anchors, own_labels, anchor_vectors = _unpacked(batch, "anchor_", i)
            for start in range(0, len(anchors), AT_ONCE):
                part = slice(start, start + AT_ONCE)
                scores = inner(anchor_vectors[part], vectors)
                same = own_labels[part, None] == labels
                other = anchors[part, None] != ids
                yield batch, i, part, (anchors[part], own_labels[part]), ids, scores, same, other


SCORED = "anchor long, mark long, score long, id long"


def _first_positives(n_positives: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, (anchors, marks), ids, scores, same, other in _chunks(batches):
            row, column = first_per_row(scores, same & other, n_positives)
            yield _record([anchors[row], marks[row], scores[row, column], ids[column]])

    return run


def _record(columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c.astype(np.int64)) for c in columns], names=["anchor", "mark", "score", "id"]
    )


def window(positive: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest score that lies within ``low`` and ``high`` per cent of the positive's."""
    return -((-low * positive) // 100), (high * positive) // 100


def _first_negatives(n_negatives: int, low: int, high: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, i, part, (anchors, marks), ids, scores, same, other in _chunks(batches):
            raw = np.frombuffer(batch.column("anchor_extra0")[i].as_py(), np.int64)
            positives = raw.reshape(batch.column("anchor_n")[i].as_py(), -1)[part]
            found = []
            for positive in positives.T:
                least, most = window(positive, low, high)
                within = (positive != NO_SCORE)[:, None] & (scores >= least[:, None]) & (scores <= most[:, None])
                row, column = first_per_row(scores, within & ~same & other, n_negatives)
                found.append(row * len(ids) + column)
            row, column = np.divmod(np.unique(np.concatenate(found)), max(1, len(ids)))
            yield _record([anchors[row], marks[row], scores[row, column], ids[column]])

    return run


class Walk:
    """One anchor's scores in descending order; gives out what each window takes."""

    def __init__(self, n_positives: int, n_negatives: int, low: int, high: int):
        self.n_positives, self.n_negatives, self.low, self.high = n_positives, n_negatives, low, high
        self.windows: list[list] = []
        self.equal: list[tuple[int, int]] = []

    def positive(self, id: int, score: int) -> Iterator[tuple]:
        if len(self.windows) < self.n_positives:
            least, most = -((-self.low * score) // 100), (self.high * score) // 100
            self.windows.append([id, score, least, most, 0])
            # A window that reaches up to its own positive's score takes negatives of
            # that score as well, also those that came before the positive by their id.
            for negative, its_score in self.equal:
                if its_score == score:
                    yield from self.into(self.windows[-1], negative, its_score)

    def negative(self, id: int, score: int) -> Iterator[tuple]:
        if self.equal and self.equal[-1][1] != score:
            self.equal.clear()
        if len(self.equal) < self.n_negatives:
            self.equal.append((id, score))
        for window in self.windows:
            yield from self.into(window, id, score)

    def into(self, window: list, id: int, score: int) -> Iterator[tuple]:
        positive, positive_score, least, most, taken = window
        if taken < self.n_negatives and least <= score <= most:
            window[4] += 1
            yield positive, taken + 1, id, positive_score, score


def _walk(n_positives: int, n_negatives: int, low: int, high: int):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, walk = None, None
        for batch in batches:
            out: list[tuple] = []
            for anchor, mark, score, id, same in zip(*(c.to_pylist() for c in batch.columns)):
                if (anchor, mark) != now:
                    now, walk = (anchor, mark), Walk(n_positives, n_negatives, low, high)
                taken = walk.positive(id, score) if same else walk.negative(id, score)
                out.extend((anchor, *t) for t in taken)
            columns = zip(*out) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], names=names
            )

    return run


def _highest(n_positives: int):
    """The first positives of each anchor out of sorted scores, padded to a fixed length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def done():
            pad = n_positives - len(held)
            return (
                *now,
                [s for s, _ in held] + [NO_SCORE] * pad,
                [i for _, i in held] + [0] * pad,
            )

        for batch in batches:
            out = []
            for anchor, mark, score, id in zip(*(c.to_pylist() for c in batch.columns)):
                if (anchor, mark) != now:
                    if now:
                        out.append(done())
                    now, held = (anchor, mark), []
                if len(held) < n_positives:
                    held.append((score, id))
            if out:
                yield _positives(out)
        if now:
            yield _positives([done()])

    return run


def _positives(rows: list[tuple]) -> pa.RecordBatch:
    long, longs = pa.int64(), pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), [long, long, longs, longs])],
        names=["anchor", "mark", "scores", "ids"],
    )


def _cells(blocks: DataFrame, anchors: DataFrame, copies: int) -> DataFrame:
    """Every block of rows beside every block of anchors of its number of components.

    An equi-join on that number and on one of ``copies`` copies of the anchors, so that each
    task has few blocks of rows. The number of partitions is stated: by their bytes, blocks look
    like little work, and would be put together in a task or two.
    """
    n_parts = SPREAD * copies
    renamed = anchors.select("width", *[F.col(c).alias(f"anchor_{c}") for c in anchors.columns if c != "width"])
    spread = renamed.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    number = F.pmod(F.xxhash64("ids"), F.lit(copies)).cast("int")
    keys = ["width", "copy"]
    placed = blocks.withColumn("copy", number).repartition(n_parts, *keys)
    return placed.join(spread.repartition(n_parts, *keys), keys).drop("copy")


def _sorted(scores: DataFrame) -> DataFrame:
    """All scores of an anchor in one task, in the order (anchor, descending score, id)."""
    return scores.repartition("anchor", "mark").sortWithinPartitions(
        "anchor", "mark", F.col("score").desc(), "id"
    )


def mine_hard_negatives(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: Column | str = "label",
    anchor: Column | str | None = None,
    n_positives: int = 5,
    n_negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Scores are inner products of floor(scale * x). An anchor's positives are its first
    ``n_positives`` rows of the same label by descending score, then id. Of each positive, the
    first ``n_negatives`` rows of other labels with a score of ``low`` to ``high`` per cent of
    the positive's are given, ranked from 1 (``high`` is 100 at most). Labels are whole numbers.
    ``anchor`` says which rows are anchors (by default
    those whose id is divisible by 50); all rows are compared with them.

    Rows without an id, label or vector, or with a null or non-finite component take no part,
    and rows are compared only with rows of as many components. Rows that carry the anchor's
    id are not its positives or negatives. Repeated rows count as often as they occur, as
    anchors once; an id with two labels or vectors is an anchor once for each of its labels, and
    the scores of its vectors come together. An empty table gives an empty result. Other columns
    are ignored. Scores beyond 64 bits are an error.
    """
    if not low <= high <= 100:
        raise ValueError("windows must lie at or below their positive's score")
    label = F.col(label) if isinstance(label, str) else label
    if anchor is None:
        anchor = F.col(id) % 50 == 0
    anchor = F.col(anchor) if isinstance(anchor, str) else anchor
    rows = vectors.select(
        F.col(id).cast("long").alias("id"),
        label.cast("long").alias("label"),
        F.col(vector).cast("array<double>").alias("v"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    ).filter(F.col("id").isNotNull() & F.col("label").isNotNull() & _finite("v"))
    blocks = settle(rows.select("id", "label", "v").mapInArrow(_packed(scale, ROWS, 0), BLOCK))
    anchors = settle(rows.filter("anchor").select("id", "label", "v").distinct())
    copies = -(-blocks.count() // BLOCKS_PER_COPY) or 1

    own = anchors.mapInArrow(_packed(scale, ANCHORS, 0), BLOCK)
    positives = _cells(blocks, own, copies).mapInArrow(_first_positives(n_positives), SCORED)
    positives = settle(
        _sorted(positives).mapInArrow(
            _highest(n_positives), "anchor long, mark long, scores array<long>, ids array<long>"
        )
    )
    seeking = anchors.join(
        positives.select(F.col("anchor").alias("id"), F.col("mark").alias("label"), F.col("scores").alias("extra0")),
        ["id", "label"],
    )
    seeking = seeking.mapInArrow(_packed(scale, ANCHORS, 1), f"{BLOCK}, extra0 binary")
    negatives = _cells(blocks, seeking, copies).mapInArrow(_first_negatives(n_negatives, low, high), SCORED)
    opening = positives.select("anchor", "mark", F.explode(F.arrays_zip("scores", "ids")).alias("p")).select(
        "anchor", "mark", F.col("p.scores").alias("score"), F.col("p.ids").alias("id"), F.lit(True).alias("same")
    )
    scores = negatives.withColumn("same", F.lit(False)).unionByName(opening.filter(F.col("score") != NO_SCORE))
    # (anchor, descending score, id): a positive opens its window before anything below it.
    return _sorted(scores).mapInArrow(
        _walk(n_positives, n_negatives, low, high),
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long",
    )
