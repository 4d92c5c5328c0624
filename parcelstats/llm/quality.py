"""Quality scores from random-indexing word vectors and a two-layer network.

The most frequent words of all documents have a row each, rarer words and runs of marks share
a fixed number of rows; every row has a random index vector. The word vector of a row is the
sum of the index vectors around its tokens over all documents, scaled, plus its own. A document's vectors are pooled over its tokens and over stretches of
them; a network with one hidden layer reads the pools, and a temperature fitted on documents
that it was not trained on makes its outputs probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelstats.llm.tables import settle
from parcelstats.llm.words import WHITE, Block, Spans, blocks, mix

#: Rows of words of their own, rows that rarer words share, rows of runs of marks, and components
#: of a vector: a model of bounded size.
OWN_ROWS = 1 << 15
WORD_ROWS = 1 << 13
MARK_ROWS = 1 << 10
SHARED_ROWS = WORD_ROWS + MARK_ROWS
#: A word with a row of its own is at least one in so many tokens.
RARE = 1_000_000
SIZE = 24
NONZERO = 6
#: Tokens of a stretch.
STRETCH = 32
HIDDEN = 24
#: Labelled documents that the network is fitted on at most.
MAX_FIT = 20_000
SEED = 3
# Kinds of bytes: white space, words (ASCII letters and digits, anything beyond ASCII), marks.
KINDS = np.array([0 if WHITE[b] else 1 if b >= 128 or chr(b).isalnum() else 2 for b in range(256)], np.uint8)


def index_vectors(n_rows: int) -> np.ndarray:
    """A sparse vector of +1 and -1 for each row."""
    random = np.random.default_rng(SEED)
    places = random.random((n_rows, SIZE)).argsort(axis=1)[:, :NONZERO]
    out = np.zeros((n_rows, SIZE), np.float32)
    np.put_along_axis(out, places, random.choice(np.float32([-1, 1]), (n_rows, NONZERO)), axis=1)
    return out


def tokens(block: Block, own: np.ndarray) -> tuple[Spans, np.ndarray]:
    """Runs of letters and runs of marks, and the row of each.

    Marks and rare words have the first rows, by their hash; the words whose hashes ``own`` holds
    in order follow.
    """
    data = block.lowered()
    spans = block.spans(data, KINDS[data])
    marks = KINDS[data[spans.start]] == 2
    hashed = spans.hash
    row = (hashed % np.uint64(WORD_ROWS)).astype(np.int64)
    row = np.where(marks, WORD_ROWS + (hashed % np.uint64(MARK_ROWS)).astype(np.int64), row)
    if len(own):
        place = np.minimum(np.searchsorted(own, hashed), len(own) - 1)
        row = np.where(~marks & (own[place] == hashed), SHARED_ROWS + place, row)
    return spans, row


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, times) of the words of the task, counted before they leave it."""
    words, times = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for batch in batches:
        for block in blocks(batch.column(0)):
            data = block.lowered()
            spans = block.spans(data, KINDS[data])
            hashed = spans.hash[KINDS[data[spans.start]] != 2]
            fresh, n = np.unique(hashed, return_counts=True)
            words, back = np.unique(np.concatenate([words, fresh]), return_inverse=True)
            times = np.bincount(back, np.concatenate([times, n]), len(words)).astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(times)], names=["hash", "times"])


def frequent_words(docs: DataFrame, text: str = "text", most: int = OWN_ROWS) -> np.ndarray:
    """Hashes of the ``most`` most frequent words that are not rare, in order.

    Words are counted over all documents. A frequent word is one in ``RARE`` tokens or more, so
    what is ranked is bounded as well.
    """
    counts = settle(
        docs.select(F.col(text).alias("text"))
        .mapInArrow(_word_counts, "hash long, times long")
        .groupBy("hash").agg(F.sum("times").alias("times"))
    )
    total = counts.agg(F.sum("times")).first()[0] or 0
    top = counts.filter(F.col("times") * RARE >= total).orderBy(F.desc("times"), "hash").limit(most)
    return np.sort(top.select("hash").toPandas()["hash"].to_numpy(np.int64).view(np.uint64))


def _contexts(own: np.ndarray):
    """Sums of the index vectors beside each row's tokens, over all batches of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_rows = SHARED_ROWS + len(own)
        index = np.ascontiguousarray(index_vectors(n_rows).T)
        total = np.zeros((SIZE, n_rows))
        times = np.zeros(n_rows)
        for batch in batches:
            for block in blocks(batch.column(0)):
                spans, row = tokens(block, own)
                same = np.flatnonzero(spans.text[1:] == spans.text[:-1])
                left, right = row[same], row[same + 1]
                times += np.bincount(row, minlength=n_rows)
                for k in range(SIZE):
                    total[k] += np.bincount(left, index[k, right], n_rows) + np.bincount(right, index[k, left], n_rows)
        used = np.flatnonzero(times)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(times[used]), *(pa.array(total[k, used]) for k in range(SIZE))],
            names=["row", "times", *(f"v{k}" for k in range(SIZE))],
        )

    return run


def word_vectors(docs: DataFrame, own: np.ndarray, text: str = "text") -> np.ndarray:
    """Random-indexing vectors of all rows, from all documents.

    A task sends at most one line per row, so that the exchange does not depend on the length
    of the texts; the result is bounded in size.
    """
    columns = ["times", *(f"v{k}" for k in range(SIZE))]
    schema = "row long, " + ", ".join(f"{c} double" for c in columns)
    sums = (
        docs.select(F.col(text).alias("text"))
        .mapInArrow(_contexts(own), schema)
        .groupBy("row")
        .agg(*(F.sum(c).alias(c) for c in columns))
        .toPandas()
        .sort_values("row")
    )
    out = index_vectors(SHARED_ROWS + len(own))
    context = sums[columns[1:]].to_numpy()
    # Rounded, so that the order in which tasks are added up does not show.
    length = np.maximum(np.sqrt((context**2).sum(axis=1, keepdims=True)), 1)
    out[sums["row"].to_numpy()] += (np.round(context / length, 6) * np.sqrt(NONZERO)).astype(np.float32)
    return out


def pool(block: Block, vectors: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Mean vector of each text, the largest and smallest component of its stretches, and
    the mean and largest length of their vectors: words that repeat add up, others cancel."""
    n = block.n_texts
    spans, row = tokens(block, own)
    out = np.zeros((n, 3 * SIZE + 4), np.float32)
    if not len(row):
        return out
    counts = spans.per_text(n)
    begins = np.cumsum(counts) - counts
    place = np.arange(len(row)) - begins[spans.text]
    cuts = np.flatnonzero(place % STRETCH == 0)
    stretch = np.add.reduceat(vectors[row], cuts, axis=0)
    size = np.diff(np.append(cuts, len(row)))
    owner = spans.text[cuts]
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    used = owner[first]
    out[used, :SIZE] = np.add.reduceat(stretch, first, axis=0) / counts[used, None]
    # The rest of a text in a short last stretch says less: it is scaled as if it were long.
    mean = stretch / np.maximum(size, STRETCH // 2)[:, None]
    out[used, SIZE : 2 * SIZE] = np.maximum.reduceat(mean, first, axis=0)
    out[used, 2 * SIZE : 3 * SIZE] = np.minimum.reduceat(mean, first, axis=0)
    length = np.sqrt((mean**2).sum(axis=1))
    out[used, -4] = np.add.reduceat(length, first) / np.diff(np.append(first, len(cuts)))
    out[used, -3] = np.maximum.reduceat(length, first)
    out[:, -2] = np.log1p(counts) / 5
    out[used, -1] = np.bincount(spans.text, (row >= WORD_ROWS) & (row < SHARED_ROWS), n)[used] / counts[used]
    return out


class Network:
    """Standardised inputs, one hidden layer, one output, a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.01):
        random = np.random.default_rng(SEED)
        self.middle, self.spread = x.mean(axis=0), x.std(axis=0) + 1e-6
        x = self._scaled(x)
        apart = np.arange(len(x)) % 5 == 4
        train_x, train_y = x[~apart], y[~apart]
        self.w = [
            random.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
            random.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.full(1, np.log((y.mean() + 0.01) / (1.01 - y.mean()))),
        ]
        step = [(np.zeros_like(w), np.zeros_like(w)) for w in self.w]
        t = 0
        for _ in range(rounds):
            order = random.permutation(len(train_x))
            for at in range(0, len(order), 256):
                rows = order[at : at + 256]
                t += 1
                for k, slope in enumerate(self._slopes(train_x[rows], train_y[rows])):
                    slope = slope + 1e-3 * self.w[k]
                    m, v = step[k]
                    m += 0.1 * (slope - m)
                    v += 0.001 * (slope**2 - v)
                    self.w[k] -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        self.temperature = 1.0
        if apart.any():
            z, held = self._output(x[apart]), y[apart]
            tried = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
            loss = [np.mean(np.logaddexp(0, z / t) - held * z / t) for t in tried]
            self.temperature = float(tried[int(np.argmin(loss))])

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.middle) / self.spread, -8, 8)

    def _slopes(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        hidden = np.tanh(x @ self.w[0] + self.w[1])
        error = (1 / (1 + np.exp(-np.clip(hidden @ self.w[2] + self.w[3], -30, 30))) - y) / len(x)
        back = error[:, None] * self.w[2] * (1 - hidden**2)
        return [x.T @ back, back.sum(axis=0), hidden.T @ error, error.sum(keepdims=True)]

    def _output(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.w[0] + self.w[1]) @ self.w[2] + self.w[3]

    def predict(self, x: np.ndarray) -> np.ndarray:
        z = self._output(self._scaled(x)) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def training_part(id: Column) -> Column:
    """Whether a row's label may be learned from: crc32 of the id as text, modulo 5, is not 0."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 5 != 0, F.lit(True))


class QualityModel:
    """Words with a row of their own, word vectors and network; bounded, so that it can travel."""

    def __init__(self, own: np.ndarray, vectors: np.ndarray, network: Network | None, constant: float = 0.5):
        self.own, self.vectors, self.network, self.constant = own, vectors, network, constant

    def score(self, docs: DataFrame, text: str = "text", to: str = "quality") -> DataFrame:
        """``docs`` with the probability ``to`` (0 to 1) of a good document.

        Whole texts are scored. Null and empty texts score like a text of no tokens. Repeated rows
        score alike, all columns but one named ``to`` are kept, an empty table stays empty.
        """
        model = docs.sparkSession.sparkContext.broadcast((self.own, self.vectors, self.network, self.constant))

        @F.pandas_udf("double")
        def scored(texts: pd.Series) -> pd.Series:
            own, vectors, network, constant = model.value
            out = np.full(len(texts), constant)
            for block in blocks(pa.array(texts, pa.string(), from_pandas=True)):
                if network is not None:
                    out[block.first : block.last] = network.predict(pool(block, vectors, own))
            return pd.Series(out)

        return docs.withColumn(to, scored(F.col(text)))


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    training: Column | None = None,
    max_fit: int = MAX_FIT,
) -> QualityModel:
    """Word vectors from all documents, network from labelled ones that ``training`` admits.

    The network is fitted on at most about ``max_fit`` labelled documents, chosen by a hash of
    the id. Null labels and ids are left out; of contradicting labels for an id the
    larger counts. With labels of one kind only, that kind is everyone's score (0.5
    without any).
    """
    admitted = training_part(F.col("id")) if training is None else training
    own = (
        labels.select(F.col(id).alias("id"), F.col(label).cast("int").alias("y"))
        .filter(F.col("id").isNotNull() & F.col("y").isNotNull())
        .groupBy("id").agg(F.max("y").alias("y"))
        .filter(admitted)
    )
    share = min(1.0, max_fit / max(own.count(), 1))
    sample = own.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int((1 << 20) * share))
    words = frequent_words(docs, text)
    vectors = word_vectors(docs, words, text)
    # The sample is bounded by ``max_fit`` rows of two numbers.
    chosen = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).join(F.broadcast(sample), "id")
    sent = docs.sparkSession.sparkContext.broadcast((vectors, words))

    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(2)):
                x = pool(block, *sent.value)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(block.first, block.n_texts).cast(pa.string()),
                        batch.column(1).slice(block.first, block.n_texts),
                        pa.array([r.tobytes() for r in x], pa.binary()),
                    ],
                    names=["id", "y", "x"],
                )

    rows = chosen.select("id", "y", "text").mapInArrow(pooled, "id string, y int, x binary").toPandas()
    rows = rows.sort_values(["id", "y"])
    if rows["y"].nunique() < 2:
        return QualityModel(words, vectors, None, float(rows["y"].iloc[0]) if len(rows) else 0.5)
    x = np.frombuffer(b"".join(rows["x"]), np.float32).reshape(len(rows), -1).astype(np.float64)
    return QualityModel(words, vectors, Network(x, rows["y"].to_numpy().astype(float)))
