"""A bigram language model in Elias-Fano tries, one trie per shard of the vocabulary.

P(w | h) = (c(h, w) + MU * P(w)) / (c(h) + MU) with P(w) = (c(w) + 0.1) / (N + 0.1 * (V + 1)).
The logarithm splits into a part that depends on w and the pair, and a part that depends on h
alone; both are known where all occurrences of a word meet. So every pair of a unit of
documents travels once, with its count, to the shard of its word, and its code comes back to
the unit, where the documents' tokens are added up. Words that make up a large share of all
tokens are spread over the shards by their contexts.

A trie has two levels: words, and behind monotone pointers the contexts in front of each word.
Sorted keys and pointers are Elias-Fano coded, probabilities are 16-bit codes, and all lie in
one memory-mapped buffer. A pair is looked up by successor search among its word's contexts.
"""

from __future__ import annotations

import mmap
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelstats.llm.tables import settle
from parcelstats.llm.words import Block, blocks

#: Weight of the unigram probability in the bigram one, in tokens.
MU = 200.0
#: Added to every count of the unigram model.
ADDED = 0.1
#: Words with this share of all tokens, or with more tokens than a shard, are spread over the
#: shards; there are at most 1 / HOT_SHARE of them, or one for each shard.
HOT_SHARE = 0.001
TOKENS_PER_SHARD = 1_000_000
#: Tokens that travel together; a unit holds whole documents.
TOKENS_PER_UNIT = 1_500_000
DOCS_PER_UNIT = 1 << 15
CONTEXT_BITS = 40
END = np.uint64(0x2545F4914F6CDD1D)
BEGIN = np.uint64(0x9E6C63D0876A9A47)
# Codes of probabilities: logarithms to the base 10 from LOWEST on, in steps of STEP.
LOWEST, STEP = -14.0, 28.0 / 65535


class EliasFano:
    """A rising sequence of 64-bit numbers: low bits packed, high bits in unary."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        top = int(values[-1]) if n else 0
        # A low part must fit a read of eight bytes that starts at any bit of a byte.
        room = max((max(top, 1) // max(n, 1)).bit_length() - 1, 0)
        self.n, self.low_bits = n, min(room, 56)
        shift = np.uint64(self.low_bits)
        high = (values >> shift).astype(np.int64)
        unary = np.zeros(n + (top >> self.low_bits) + 2, dtype=bool)
        unary[high + np.arange(n)] = True
        planes = np.arange(self.low_bits, dtype=np.uint64)
        low = ((values[:, None] >> planes) & np.uint64(1)).astype(bool)
        packed = np.packbits(unary), np.packbits(low.reshape(-1), bitorder="little")
        buffer = mmap.mmap(-1, len(packed[0]) + len(packed[1]) + 8)
        buffer.write(packed[0].tobytes() + packed[1].tobytes() + bytes(8))
        self.unary = np.frombuffer(buffer, np.uint8, len(packed[0]))
        #: Eight bytes from every byte of the low bits on.
        self.low = np.ndarray(len(packed[1]) + 1, np.uint64, buffer, len(packed[0]), (1,))
        zeros = np.flatnonzero(~np.unpackbits(self.unary, count=len(unary)).astype(bool))
        #: Where the numbers with each high part begin.
        self.begins = np.concatenate([[0], zeros - np.arange(len(zeros))])

    def lows(self, at: np.ndarray) -> np.ndarray:
        first = at * self.low_bits
        read = self.low[first >> 3] >> (first & 7).astype(np.uint64)
        return read & np.uint64((1 << self.low_bits) - 1)

    def find(self, keys: np.ndarray, start: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """Place of each key, -1 where it is missing, by the first number that is not less.

        ``start`` and ``end`` confine the search to a stretch of the sequence.
        """
        out = np.full(len(keys), -1, np.int64)
        if not self.n:
            return out
        shift = np.uint64(self.low_bits)
        high = np.minimum((keys >> shift), np.uint64(len(self.begins) - 2)).astype(np.int64)
        low = keys & ((np.uint64(1) << shift) - np.uint64(1))
        at, stop = self.begins[high], self.begins[high + 1]
        if start is not None:
            at, stop = np.maximum(at, start), np.minimum(stop, end)
        rows = np.flatnonzero((at < stop) & ((keys >> shift).astype(np.int64) == high))
        at, stop, low = at[rows], stop[rows], low[rows]
        last = stop.copy()
        while True:  # halve what is left of each stretch until its first number not below is found
            go = np.flatnonzero(at < stop)
            if not len(go):
                break
            middle = (at[go] + stop[go]) >> 1
            below = self.lows(middle) < low[go]
            at[go] = np.where(below, middle + 1, at[go])
            stop[go] = np.where(below, stop[go], middle)
        inside = np.flatnonzero(at < last)
        hit = inside[self.lows(at[inside]) == low[inside]]
        out[rows[hit]] = at[hit]
        return out

    def get(self, at: np.ndarray) -> np.ndarray:
        """The numbers at the given places."""
        high = np.searchsorted(self.begins, at, side="right") - 1
        return (high.astype(np.uint64) << np.uint64(self.low_bits)) | self.lows(at)


def coded(values: np.ndarray) -> np.ndarray:
    return np.clip(np.rint((values - LOWEST) / STEP), 0, 65535).astype(np.uint16)


def decoded(codes: np.ndarray) -> np.ndarray:
    return codes * STEP + LOWEST


class Trie:
    """Words of a shard with their contexts; built from counted training pairs (word, context)."""

    def __init__(
        self, words: np.ndarray, number: np.ndarray, contexts: np.ndarray,
        times: np.ndarray, totals: dict[int, int], n: int, v: int, mu: float,
    ):
        """``number`` gives the place of each pair's word among the distinct ``words``.

        A pair may be given more than once; its counts ``times`` (at least 1) are added up.
        """
        keys = (number.astype(np.uint64) << np.uint64(CONTEXT_BITS)) | contexts
        order = np.argsort(keys)
        keys = keys[order]
        pair = np.ones(len(keys), dtype=bool)
        pair[1:] = keys[1:] != keys[:-1]
        pairs = np.flatnonzero(pair)
        total = np.concatenate([[0], np.cumsum(times[order])])
        seen = np.diff(total[np.append(pairs, len(keys))])
        owner = (keys[pairs] >> np.uint64(CONTEXT_BITS)).astype(np.int64)
        counts = np.bincount(number, times, len(words)).astype(np.int64)
        used = np.flatnonzero(counts)
        place = np.cumsum(counts > 0) - 1
        owner = place[owner]
        self.words = EliasFano(words[used])
        self.counts = np.array(
            [totals.get(w, c) for w, c in zip(words[used].tolist(), counts[used].tolist(), strict=True)], np.int64
        )
        begins = np.searchsorted(owner, np.arange(len(used) + 1))
        self.pointers = EliasFano(begins.astype(np.uint64))
        own = keys[pairs] & np.uint64((1 << CONTEXT_BITS) - 1)
        self.contexts = EliasFano((owner.astype(np.uint64) << np.uint64(CONTEXT_BITS)) | own)
        unigram = np.log10((self.counts + ADDED) / (n + ADDED * (v + 1)))
        self.unseen = coded(unigram + np.log10(mu))
        self.seen = coded(np.log10(seen + mu * 10.0 ** unigram[owner]))
        self.unknown = coded(np.log10(mu * ADDED / (n + ADDED * (v + 1))))

    def look_up(
        self, words: np.ndarray, number: np.ndarray, contexts: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """(training count of each of ``words``, code of log10(c(h, w) + mu * P(w)) per pair).

        Pairs are given as the number of their word and their context.
        """
        at = self.words.find(words)
        known = at >= 0
        counts = np.zeros(len(words), np.int64)
        counts[known] = self.counts[at[known]]
        start, end = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        start[known] = self.pointers.get(at[known]).astype(np.int64)
        end[known] = self.pointers.get(at[known] + 1).astype(np.int64)
        unseen = np.full(len(words), self.unknown, np.uint16)
        unseen[known] = self.unseen[at[known]]
        keys = (np.maximum(at, 0).astype(np.uint64)[number] << np.uint64(CONTEXT_BITS)) | contexts
        place = self.contexts.find(keys, start[number], end[number])
        codes = unseen[number]
        found = place >= 0
        codes[found] = self.seen[place[found]]
        return counts, codes


def tokens(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, word in front, text) of every token of a block, ends included."""
    n = block.n_texts
    words = block.words(lower=True)
    first = np.ones(len(words.hash), dtype=bool)
    first[1:] = words.text[1:] != words.text[:-1]
    before = np.concatenate([[BEGIN], words.hash[:-1]])[: len(words.hash)]
    before = np.where(first, BEGIN, before)
    counts = words.per_text(n)
    ends = np.cumsum(counts) - 1
    last = np.where(counts > 0, words.hash[np.maximum(ends, 0)] if len(words.hash) else BEGIN, BEGIN)
    return (
        np.concatenate([words.hash, np.full(n, END)]),
        np.concatenate([before, last]),
        np.concatenate([words.text, np.arange(n)]),
    )


def _planes(values: np.ndarray) -> bytes:
    """Bytes of numbers, all first bytes, then all second bytes, ...: they compress better."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _unplaned(raw: memoryview, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(dtype).reshape(-1)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch.column(0), 1 << 22):
            word, count = np.unique(tokens(block)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(word.view(np.int64)), pa.array(count)], names=["word", "n"]
            )


UNIT = (
    "shard long, unit long, runs binary, words binary, contexts binary, times binary, "
    "ids binary, texts binary, lengths binary"
)


def _requests(hot: np.ndarray, n_shards: int):
    """Distinct pairs of a unit of documents by shard, sorted by word; and a row that stays with the unit.

    ``times`` holds how often each pair occurs in training texts. The unit's own row has the
    ids, each token's document in the order of the pairs, and the number of tokens per pair.
    """

    def emit(unit: int, parts: list[tuple], ids: list[pa.Array]) -> pa.RecordBatch:
        word, before, text = (np.concatenate(x) for x in zip(*parts, strict=True))
        spread = hot[np.minimum(np.searchsorted(hot, word), len(hot) - 1)] == word
        key = np.where(spread, word ^ (before * np.uint64(0xD6E8FEB86659FD93)), word)
        shard = (key % np.uint64(n_shards)).astype(np.int64)
        context = before & np.uint64((1 << CONTEXT_BITS) - 1)
        order = np.lexsort((context, word, shard))
        word, context, text, shard = word[order], context[order], text[order], shard[order]
        new = np.ones(len(word), dtype=bool)
        new[1:] = (word[1:] != word[:-1]) | (shard[1:] != shard[:-1])
        new_pair = new.copy()
        new_pair[1:] |= context[1:] != context[:-1]
        pair = np.flatnonzero(new_pair)
        length = np.diff(np.append(pair, len(word))).astype(np.uint32)
        trained = np.concatenate([[0], np.cumsum(text >> np.uint16(15), dtype=np.int64)])
        times = np.diff(trained[np.append(pair, len(word))]).astype(np.uint32)
        word, context, shard, run = word[pair], context[pair], shard[pair], np.flatnonzero(new[pair])
        pairs = np.diff(np.append(run, len(pair))).astype(np.uint32)
        low, high = context.astype(np.uint32), (context >> np.uint64(32)).astype(np.uint8)
        used, starts = np.unique(shard, return_index=True)
        stops = np.append(starts[1:], len(shard))
        run_at = np.searchsorted(run, np.append(starts, len(shard)))
        runs, words, contexts, counted = [], [], [], []
        for k in range(len(used)):
            a, b, c, d = starts[k], stops[k], run_at[k], run_at[k + 1]
            runs.append(_planes(pairs[c:d]))
            words.append(word[run[c:d]].tobytes())
            contexts.append(low[a:b].tobytes() + high[a:b].tobytes())
            counted.append(_planes(times[a:b]))
        sink = pa.BufferOutputStream()
        table = pa.table({"id": pa.chunked_array(ids)})
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        rows = [*used.tolist(), -1 - unit]
        own = sink.getvalue().to_pybytes(), _planes(text & np.uint16(0x7FFF)), _planes(length)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(rows, pa.int64()),
                pa.array([unit] * len(rows), pa.int64()),
                *(pa.array([*x, None], pa.binary()) for x in (runs, words, contexts, counted)),
                *(pa.array([*[None] * len(used), x], pa.binary()) for x in own),
            ],
            names=["shard", "unit", "runs", "words", "contexts", "times", "ids", "texts", "lengths"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = TaskContext.get().partitionId() << 32
        parts, ids, n_tokens, n_docs = [], [], 0, 0
        for whole in batches:
            for at in range(0, whole.num_rows, DOCS_PER_UNIT):
                batch = whole.slice(at, DOCS_PER_UNIT)
                train = batch.column(2).to_numpy(False)
                for block in blocks(batch.column(1)):
                    if n_docs + block.n_texts > DOCS_PER_UNIT or n_tokens > TOKENS_PER_UNIT:
                        yield emit(unit, parts, ids)
                        unit, parts, ids, n_tokens, n_docs = unit + 1, [], [], 0, 0
                    word, before, text = tokens(block)
                    marked = (text + n_docs).astype(np.uint16)
                    marked |= train[block.first : block.last][text].astype(np.uint16) << np.uint16(15)
                    parts.append((word, before, marked))
                    ids.append(batch.column(0).slice(block.first, block.n_texts))
                    n_tokens, n_docs = n_tokens + len(word), n_docs + block.n_texts
        if n_docs:
            yield emit(unit, parts, ids)

    return run


REPLY = (
    "shard long, unit long, codes binary, runs binary, counts binary, ids binary, texts binary, lengths binary"
)


def _replies(hot: dict[int, int], n: int, v: int, mu: float):
    """Builds the trie of a shard from its training pairs and looks all its pairs up."""

    def run(group: pa.Table) -> pa.Table:
        shard = group.column("shard").to_pylist()
        names = ["shard", "unit", "codes", "runs", "counts", "ids", "texts", "lengths"]
        if shard[0] < 0:  # what stays with a unit goes on as it is
            none = pa.nulls(len(shard), pa.binary())
            kept = (group.column(c) for c in ("ids", "texts", "lengths"))
            return pa.table([group.column("shard"), group.column("unit"), none, none, none, *kept], names=names)
        raw = {c: group.column(c).to_pylist() for c in ("runs", "words", "contexts", "times")}
        runs = [_unplaned(r, np.uint32).astype(np.int64) for r in raw["runs"]]
        words = [np.frombuffer(w, np.uint64) for w in raw["words"]]
        sizes = [len(t) // 4 for t in raw["times"]]
        contexts = []
        for packed, size in zip(raw["contexts"], sizes, strict=True):
            low = np.frombuffer(packed, np.uint32, size).astype(np.uint64)
            high = np.frombuffer(packed, np.uint8, size, 4 * size).astype(np.uint64)
            contexts.append(low | (high << np.uint64(32)))
        distinct, of_run = np.unique(np.concatenate(words), return_inverse=True)
        number = np.repeat(of_run, np.concatenate(runs))
        context = np.concatenate(contexts)
        times = np.concatenate([_unplaned(t, np.uint32) for t in raw["times"]]).astype(np.int64)
        train = times > 0
        trie = Trie(distinct, number[train], context[train], times[train], hot, n, v, mu)
        counts, codes = trie.look_up(distinct, number, context)
        counts = counts[of_run]
        n_runs = np.cumsum([0, *map(len, runs)])
        ends = np.cumsum(sizes)
        columns: list[list] = [[], [], []]
        for k, end in enumerate(ends):
            columns[0].append(_planes(codes[end - sizes[k] : end]))
            columns[1].append(raw["runs"][k])
            columns[2].append(_planes(counts[n_runs[k] : n_runs[k + 1]]))
        none = pa.nulls(len(shard), pa.binary())
        return pa.table(
            [group.column("shard"), group.column("unit"), *(pa.array(c, pa.binary()) for c in columns), none, none, none],
            names=names,
        )

    return run


def _summed(n: int, v: int, mu: float, begin: float, end_count: int):
    """Adds the parts of a unit's documents up."""

    def run(group: pa.Table) -> pa.Table:
        order = np.argsort(group.column("shard").to_numpy(), kind="stable")
        rows = {c: group.column(c).to_pylist() for c in ("codes", "runs", "counts", "ids", "texts", "lengths")}
        ids = pa.ipc.open_stream(rows["ids"][order[0]]).read_all().column("id")
        m = len(ids)
        base, score = np.zeros(m), np.full(m, begin)
        n_tokens, n_known = np.zeros(m, np.int64), np.zeros(m, np.int64)
        scale = n + ADDED * (v + 1)
        texts = _unplaned(rows["texts"][order[0]], np.uint16).astype(np.int64)
        lengths = _unplaned(rows["lengths"][order[0]], np.uint32).astype(np.int64)
        pair, token = 0, 0
        for k in order[1:]:  # the unit's tokens are in the order of the shards
            code = decoded(_unplaned(rows["codes"][k], np.uint16))
            length = lengths[pair : pair + len(code)]
            pair += len(code)
            text = texts[token : token + int(length.sum())]
            token += len(text)
            count = np.repeat(_unplaned(rows["counts"][k], np.int64), _unplaned(rows["runs"][k], np.uint32))
            n_tokens += np.bincount(text, minlength=m)
            n_known += np.bincount(text, np.repeat(count > 0, length), m).astype(np.int64)
            base += np.bincount(text, np.repeat(np.log10((count + ADDED) / scale), length), m)
            score += np.bincount(text, np.repeat(code - np.log10(count + mu), length), m)
        # The end of a text is a token but never a context.
        score += np.log10(end_count + mu)
        return pa.table(
            [ids, pa.array(n_tokens), pa.array(n_known), pa.array(base), pa.array(score)],
            names=["id", "n_tokens", "n_known", "base_score", "score"],
        )

    return run


def training_part(id: Column) -> Column:
    """Whether a text is learned from: crc32 of the id as text, modulo 10, is not 0."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 10 != 0, F.lit(True))


def score_texts(
    docs: DataFrame, id: str = "doc_id", text: str = "text", training: Column | None = None, mu: float = MU
) -> DataFrame:
    """One row per document: (id, n_tokens, n_known, train_tokens, base_score, score).

    Texts that ``training`` (a condition on the columns of ``docs``) admits are learned from, all
    are scored, whole. Tokens are words in lower case (A-Z) and one end per text; a null text is
    an empty one and has the end alone. ``base_score`` is the sum of the unigram log10
    probabilities, ``score`` that of the bigram ones, up to the rounding of a 16-bit code
    per token. Repeated rows and null ids are texts like any other; an empty table gives an empty result;
    other columns are ignored. Words are told apart by 64-bit hashes, contexts of a word by
    40 bits of theirs.
    """
    admitted = training_part(F.col(id)) if training is None else F.coalesce(training, F.lit(False))
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), admitted.alias("train"))
    words = settle(
        rows.filter("train").select("text").mapInArrow(_word_counts, "word long, n long")
        .groupBy("word").agg(F.sum("n").alias("n"))
    )
    n, v = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    frequent = words.filter(F.col("n") >= max(1.0, min(HOT_SHARE * n, TOKENS_PER_SHARD))).collect()
    hot = {r["word"] % (1 << 64): r["n"] for r in frequent}
    end_count = words.filter(F.col("word") == int(END.view(np.int64))).agg(F.sum("n")).first()[0] or 0
    hot.setdefault(int(END), end_count)
    n_shards = max(1, -(-n // TOKENS_PER_SHARD))
    asked = rows.mapInArrow(_requests(np.array(sorted(hot), np.uint64), n_shards), UNIT)
    told = asked.groupBy("shard").applyInArrow(_replies(hot, n, v, mu), REPLY)
    kind = rows.schema["id"].dataType.simpleString()
    begin = -float(np.log10(end_count + mu))
    summed = told.groupBy("unit").applyInArrow(
        _summed(n, v, mu, begin, end_count),
        f"id {kind}, n_tokens long, n_known long, base_score double, score double",
    )
    return summed.select(
        F.col("id").alias(id), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score"
    )
