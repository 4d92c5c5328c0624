"""BPE encoding by speculation: longest matches are proposed, pairs of them verified.

A longest match from left to right needs no merge ranks. It equals the result of merging
exactly if each token comes out of its own merges and no merge across any two neighbours
comes before the merges inside them; that is checked for all neighbours at once. Only words
that fail are merged step by step.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from parcelstats.llm.words import blocks, mix, powers

#: Pieces of text remembered by a worker; when there are more, it starts again.
REMEMBERED = 150_000
NEVER = np.int64(1) << 40
#: Single marks after a word; other mixtures of letters and marks go through the pattern.
STOPS = frozenset(".,;:!?")
#: Words of more bytes are merged one at a time.
LONG = 256
#: Control characters that str.split takes for white space and the vocabulary does not.
NOT_WHITE = regex.compile(r"[\x1c-\x1f]")
WHITE = regex.compile(r"\p{White_Space}+")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in vocabulary files.

    Printable Latin-1 bytes stand for themselves, the others follow from U+0100 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Table:
    """Numbers by 64-bit key: keys sorted by their hash, and where each prefix of it begins."""

    PREFIX_BITS = 18

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing: int):
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.uint64(0))
        self.values, self.missing = np.append(values[order], missing), missing
        prefix = np.arange((1 << self.PREFIX_BITS) + 1)
        self.begins = np.searchsorted(keys[order] >> np.uint64(64 - self.PREFIX_BITS), prefix)

    def find(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), self.missing, np.int64)
        prefix = (keys >> np.uint64(64 - self.PREFIX_BITS)).astype(np.int64)
        at, end = self.begins[prefix], self.begins[prefix + 1]
        rows = np.flatnonzero(at < end)
        at, end = at[rows], end[rows]
        while len(rows):
            hit = self.keys[at] == keys[rows]
            out[rows[hit]] = self.values[at[hit]]
            at = at + 1
            go = ~hit & (at < end)
            rows, at, end = rows[go], at[go], end[go]
        return out


class Store:
    """Token numbers of many strings in one array."""

    def __init__(self):
        self.known: dict[str, int] = {}
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.stored = np.zeros(0, np.uint32)

    def missing(self, keys: list[str]) -> list[str]:
        return [k for k in dict.fromkeys(keys) if k not in self.known]

    def add(self, keys: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        base = len(self.stored) + np.cumsum(lengths) - lengths
        self.known.update(zip(keys, range(len(self.known), len(self.known) + len(keys)), strict=True))
        self.start = np.concatenate([self.start, base])
        self.length = np.concatenate([self.length, lengths])
        self.stored = np.concatenate([self.stored, ids.astype(np.uint32)])

    def get(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(token numbers of all keys in a row, how many each has)."""
        number = np.fromiter(map(self.known.__getitem__, keys), np.int64, len(keys))
        length = self.length[number]
        at = np.repeat(self.start[number] - np.cumsum(length) + length, length) + np.arange(length.sum())
        return self.stored[at], length


class Vocabulary:
    """Tokens and ranked merges of a word-level BPE file of the tokenizers library."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        model = spec["model"]
        suffix = model["end_of_word_suffix"] or ""
        ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        every = {**ids, **self.special}
        self.strings = [""] * (max(every.values()) + 1)
        for token, number in every.items():
            self.strings[number] = token
        split = next(
            p["pattern"]["Regex"]
            for p in spec["pre_tokenizer"]["pretokenizers"]
            if p["type"] == "Split"
        )
        self.pieces = regex.compile(split.replace(r"\s", r"\p{White_Space}"))
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        letters = byte_letters()
        #: Token of each byte, and of each byte at the end of a word; -1 where there is none.
        self.unit = np.array([ids.get(c + end, -1) for end in ("", suffix) for c in letters], np.int64)
        self._merges(ids, model["merges"])
        self._proposals()
        self.forget()

    def _merges(self, ids: dict[str, int], merges: list) -> None:
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left = np.array([ids[a] for a, _ in pairs], np.int64)
        right = np.array([ids[b] for _, b in pairs], np.int64)
        made = np.array([ids[a + b] for a, b in pairs], np.int64)
        n = len(self.strings)
        rank = np.arange(len(pairs), dtype=np.int64)
        self.ranks = Table(mix((left * n + right).astype(np.uint64)), rank, NEVER)
        self.result = made
        self.left, self.right, self.made = (np.full(n, -1, np.int64) for _ in range(3))
        first = slice(None, None, -1)
        self.left[made[first]], self.right[made[first]] = left[first], right[first]
        self.made[made[first]] = rank[first]

    def _proposals(self) -> None:
        """Find the tokens that may be proposed and their hashes.

        A token is proposed only if merging its own characters gives it back: its parts are
        such tokens, were made before it, and nothing crosses between them earlier.
        """
        n = len(self.strings)
        whole = np.flatnonzero(self.made >= 0)
        whole = whole[np.argsort(self.made[whole])]
        a, b, own = self.left[whole], self.right[whole], self.made[whole]
        fine = (self.made[a] < own) & (self.made[b] < own) & ~self.crossed(a, b, own)
        sound = np.zeros(n, dtype=bool)
        units: list[list[int]] = [[] for _ in range(n)]
        for code, token in enumerate(self.unit.tolist()):
            if token >= 0:
                sound[token] = True
                units[token] = [code]
        for token, x, y, good in zip(whole.tolist(), a.tolist(), b.tolist(), fine.tolist(), strict=True):
            sound[token] = good and sound[x] and sound[y]
            units[token] = units[x] + units[y]
        tokens = np.flatnonzero(sound)
        self.longest = max(len(units[t]) for t in tokens)
        flat = np.array([u for t in tokens for u in units[t]], np.int64)
        ends = np.cumsum([len(units[t]) for t in tokens])
        starts = np.concatenate([[0], ends[:-1]])
        hashed = self._hash(self._prefix(flat), starts, ends)
        if len(np.unique(hashed)) < len(hashed):
            raise ValueError("two tokens of this vocabulary have the same hash")
        self.tokens = Table(hashed, tokens, -1)

    @staticmethod
    def _prefix(units: np.ndarray) -> np.ndarray:
        total = np.zeros(len(units) + 1, np.uint64)
        np.cumsum((units.astype(np.uint64) + np.uint64(1)) * powers(len(units) + 1)[0][: len(units)], out=total[1:])
        return total

    @staticmethod
    def _hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        down = powers(len(prefix))[1]
        return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, NEVER where there is none."""
        return self.ranks.find(mix((a * len(self.strings) + b).astype(np.uint64)))

    def crossed(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether a merge across each pair of neighbours a, b comes before their own.

        Goes back from the finished tokens to their characters, undoing the later of the two
        merges at the boundary, and looks at each step for a merge of the two tokens that
        stood side by side then. Equal ranks go from left to right. ``limit`` asks for
        merges of a lower rank only.
        """
        out = np.zeros(len(a), dtype=bool)
        end = np.full(len(a), NEVER) if limit is None else limit
        row, x, y = np.arange(len(a)), a, b
        used_x, used_y = end, end
        while len(row):
            rank = self.rank(x, y)
            hit = (rank < used_x) & (rank <= used_y) & (rank < end)
            out[row[hit]] = True
            go = ~hit & ((self.made[x] >= 0) | (self.made[y] >= 0))
            row, x, y, used_x, used_y, end = (v[go] for v in (row, x, y, used_x, used_y, end))
            undo_x = self.made[x] > self.made[y]
            used_x = np.where(undo_x, self.made[x], used_x)
            used_y = np.where(undo_x, used_y, self.made[y])
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
        return out

    def propose(self, units: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Longest matches from left to right for all words at once: (word, token).

        A word in which nothing fits at some place is given a token of -1 there.
        """
        prefix = self._prefix(units)
        word = np.flatnonzero(bounds[1:] > bounds[:-1])
        at, end = bounds[word], bounds[word + 1]
        words, tokens = [], []
        while len(word):
            width = np.minimum(end - at, self.longest)
            begins = np.cumsum(width) - width
            size = np.arange(width.sum()) - np.repeat(begins, width) + 1
            start = np.repeat(at, width)
            found = self.tokens.find(self._hash(prefix, start, start + size))
            best = np.maximum.reduceat(np.where(found >= 0, size, 0), begins)
            token = found[begins + np.maximum(best, 1) - 1]
            words.append(word)
            tokens.append(token)
            at = at + np.where(best > 0, best, end - at)
            go = at < end
            word, at, end = word[go], at[go], end[go]
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        word, token = np.concatenate(words), np.concatenate(tokens)
        order = np.argsort(word, kind="stable")
        return word[order], token[order]

    def merge(self, units: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of all words at once: (word, token).

        Every round makes the merge of lowest rank in each word, leftmost among equals. Units
        without a token are left out.
        """
        token = self.unit[units]
        word = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        word, token = word[token >= 0], token[token >= 0]
        done = []
        rank = self._pair_ranks(word, token)
        while len(word):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            sizes = np.diff(np.concatenate([first, [len(word)]]))
            lowest = np.minimum.reduceat(rank, first)
            go = np.repeat(lowest < NEVER, sizes)
            done.append((word[~go], token[~go]))
            low = np.repeat(lowest, sizes)[go]
            word, token, rank = word[go], token[go], rank[go]
            if not len(word):
                break
            hit = np.flatnonzero(rank == low)
            hit = hit[np.concatenate([[True], word[hit][1:] != word[hit][:-1]])]
            token[hit] = self.result[rank[hit]]
            keep = np.ones(len(word), dtype=bool)
            keep[hit + 1] = False
            word, token, rank = word[keep], token[keep], rank[keep]
            at = hit - np.arange(len(hit))
            for k in (at, at[at > 0] - 1):
                same = np.minimum(k + 1, len(word) - 1)
                near = (k + 1 < len(word)) & (word[k] == word[same])
                rank[k] = np.where(near, self.rank(token[k], token[same]), NEVER)
        word = np.concatenate([w for w, _ in done]) if done else word
        token = np.concatenate([t for _, t in done]) if done else token
        order = np.argsort(word, kind="stable")
        return word[order], token[order]

    def _pair_ranks(self, word: np.ndarray, token: np.ndarray) -> np.ndarray:
        rank = np.full(len(word), NEVER)
        if len(word) > 1:
            rank[:-1] = np.where(word[1:] == word[:-1], self.rank(token[:-1], token[1:]), NEVER)
        return rank

    def merge_long(self, units: np.ndarray) -> list[int]:
        """Exact merging of one word, with a heap of candidates and linked neighbours.

        Takes n log n steps, so that a text without white space does no harm.
        """
        token = [t for t in self.unit[units].tolist() if t >= 0]
        n = len(token)
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        ranks = self._pair_ranks(np.zeros(n, np.int64), np.array(token, np.int64)).tolist()
        heap = [(r, k, token[k], token[k + 1]) for k, r in enumerate(ranks) if r < NEVER]
        heapq.heapify(heap)
        known: dict[tuple[int, int], int] = {}
        while heap:
            r, k, a, b = heapq.heappop(heap)
            other = after[k]
            if token[k] != a or other < 0 or token[other] != b:
                continue
            token[k], token[other] = int(self.result[r]), -1
            after[k] = after[other]
            if after[k] >= 0:
                before[after[k]] = k
            for x, y in ((before[k], k), (k, after[k])):
                if x >= 0 and y >= 0:
                    pair = token[x], token[y]
                    if pair not in known:
                        known[pair] = int(self.rank(*(np.array([t]) for t in pair))[0])
                    if known[pair] < NEVER:
                        heapq.heappush(heap, (known[pair], x, *pair))
        return [t for t in token if t >= 0]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(token numbers of all words in a row, how many each has)."""
        data = np.frombuffer(("\n".join(words) + "\n").encode(), np.uint8)
        breaks = np.flatnonzero(data == 10)
        units = data.astype(np.int64)
        last = breaks - 1
        units[last[last >= 0]] += 256
        units = units[data != 10]
        bounds = np.concatenate([[0], breaks - np.arange(len(breaks))])
        sizes = np.diff(bounds)
        word, token = self.propose(units, bounds)
        failed = np.zeros(len(words), dtype=bool)
        failed[word[token < 0]] = True
        inside = np.flatnonzero((word[1:] == word[:-1]) & (token[1:] >= 0) & (token[:-1] >= 0))
        n = len(self.strings)
        keys, back = np.unique(token[inside] * n + token[inside + 1], return_inverse=True)
        failed[word[inside[self.crossed(keys // n, keys % n)[back]]]] = True
        fine = ~failed[word]
        parts = [(word[fine], token[fine])]
        some = np.flatnonzero(failed & (sizes <= LONG))
        chosen = np.repeat(failed & (sizes <= LONG), sizes)
        merged = self.merge(units[chosen], np.concatenate([[0], np.cumsum(sizes[some])]))
        parts.append((some[merged[0]], merged[1]))
        for k in np.flatnonzero(failed & (sizes > LONG)):
            ids = self.merge_long(units[bounds[k] : bounds[k + 1]])
            parts.append((np.full(len(ids), k), np.array(ids, np.int64)))
        word, token = (np.concatenate(x) for x in zip(*parts, strict=True))
        return token[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(words))

    def forget(self) -> None:
        self.words, self.chunks = Store(), Store()

    def _learn(self, chunks: list[str]) -> None:
        """Encode pieces without white space and remember them."""
        text = "\n".join(chunks)
        plain = chunks
        if self.special and self.specials.search(text):
            plain = [c for c in chunks if not self.specials.search(c)]
            text = "\n".join(plain)
        text = unicodedata.normalize("NFC", text)
        # Letter by letter where the lower case of a letter may depend on its neighbours.
        text = "".join(c.lower() for c in text) if "\u03a3" in text else text.lower()
        words: list[str] = []
        counts = []
        for chunk in text.split("\n") if plain else []:
            if chunk.isalpha():  # the pattern's runs of letters, found without it
                words.append(chunk)
                counts.append(1)
            elif chunk[-1:] in STOPS and chunk[:-1].isalpha():
                words += (chunk[:-1], chunk[-1])
                counts.append(2)
            else:
                found = self.pieces.findall(chunk)
                words += found
                counts.append(len(found))
        if new := self.words.missing(words):
            self.words.add(new, *self.encode_words(new))
        ids, length = self.words.get(words)
        owner = np.repeat(np.arange(len(plain)), counts)
        self.chunks.add(plain, ids, np.bincount(owner, length, len(plain)).astype(np.int64))
        if len(plain) < len(chunks):
            for chunk in set(chunks) - set(plain):
                parts = [p for p in self.specials.split(chunk) if p]
                inner = self.chunks.missing([p for p in parts if p not in self.special])
                if inner:
                    self._learn(inner)
                own = [
                    [self.special[p]] if p in self.special else self.chunks.get([p])[0].tolist()
                    for p in parts
                ]
                ids = np.array([t for o in own for t in o], np.uint32)
                self.chunks.add([chunk], ids, np.array([len(ids)], np.int64))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(token numbers of all texts in a row, where each text begins and the end)."""
        chunks: list[str] = []
        counts = []
        for text in texts:
            own = [p for p in WHITE.split(text) if p] if NOT_WHITE.search(text) else text.split()
            chunks.extend(own)
            counts.append(len(own))
        if len(self.chunks.known) > REMEMBERED:
            self.forget()
        if new := self.chunks.missing(chunks):
            self._learn(new)
        ids, length = self.chunks.get(chunks)
        places = np.concatenate([[0], np.cumsum(length)])
        return ids, places[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]

    def decode(self, ids: np.ndarray) -> str:
        """Tokens as the file writes them with a space between, as it names no decoder."""
        strings = self.strings
        return " ".join([strings[k] for k in ids.tolist()])


_loaded: dict[int, Vocabulary] = {}


def vocabulary(content: bytes) -> Vocabulary:
    """The vocabulary of a file's content; a worker keeps it for its next tasks."""
    key = hash(content)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Vocabulary(content)
    return _loaded[key]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _shipped(docs: DataFrame, path: str | None):
    with open(path or default_vocabulary(), "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encode(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    with_decoded: bool = False,
) -> DataFrame:
    """One row per document: (id, n_tokens, ids), and with ``with_decoded`` their text again.

    ``ids`` holds the token numbers of the whole text as little-endian unsigned 32-bit
    integers. White space separates words, text is brought to NFC and lower case, special
    tokens written out in a text become their numbers. A null or empty text has no tokens.
    Repeated rows and null ids are encoded like any other; other columns are ignored; an
    empty table gives an empty result. The vocabulary file (a few MB) is broadcast.
    """
    content = _shipped(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(content.value)
        for batch in batches:
            for block in blocks(batch.column(1)):
                cut = block.offsets.tolist()
                raw = block.data.tobytes()
                ids, bounds = own.encode([raw[a:b].decode() for a, b in zip(cut[:-1], cut[1:])])
                parts = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                columns = [
                    batch.column(0).slice(block.first, block.n_texts),
                    pa.array(np.diff(bounds)),
                    pa.array([p.astype("<u4").tobytes() for p in parts], pa.binary()),
                ]
                if with_decoded:
                    columns.append(pa.array([own.decode(p) for p in parts], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["id", "n_tokens", "ids", *(["decoded"] if with_decoded else [])]
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, n_tokens long, ids binary"
    out = rows.mapInArrow(run, schema + (", decoded string" if with_decoded else ""))
    return out.withColumnRenamed("id", id)


def decode(tokens: DataFrame, ids: str = "ids", to: str = "decoded", path: str | None = None) -> DataFrame:
    """Add the decoded text of a column of token numbers; null where they are null."""
    content = _shipped(tokens, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(content.value)
        for batch in batches:
            raw = batch.column(batch.schema.names.index(ids)).to_pylist()
            texts = [None if r is None else own.decode(np.frombuffer(r, "<u4")) for r in raw]
            arrays = [*batch.columns, pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, to])

    return tokens.mapInArrow(run, StructType([*tokens.schema.fields, StructField(to, StringType())]))
