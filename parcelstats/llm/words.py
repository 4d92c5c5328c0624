"""Words of UTF-8 texts as numpy arrays, for a block of whole texts at a time.

Texts arrive as Arrow columns. Boundaries and hashes come from whole-array operations on
their bytes, so that no Python code runs per text or per word. A word is a run of bytes
other than ASCII white space (0x20, 0x09-0x0D); UTF-8 never uses those inside a character.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once; a longer text makes a block of its own.
BLOCK_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
UPPER = np.arange(256, dtype=np.uint8)
UPPER[0x41:0x5B] += 32

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64 for i < n at least; kept for later blocks."""
    if len(_powers[0]) < n:
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            factors = np.full(max(n, BLOCK_BYTES + 1), base, np.uint64)
            factors[0] = 1
            _powers[k] = np.cumprod(factors, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Spans:
    """Runs of bytes: where they start and end, their text and their hash."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    hash: np.ndarray

    def per_text(self, n_texts: int) -> np.ndarray:
        return np.bincount(self.text, minlength=n_texts).astype(np.int64)


@dataclass
class Block:
    """Whole texts ``first`` to ``last`` of a column: their bytes, and where each begins."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n_texts(self) -> int:
        return self.last - self.first

    def lowered(self) -> np.ndarray:
        """The bytes with A-Z in lower case."""
        return UPPER[self.data]

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sum of a value per byte over each text."""
        total = np.zeros(len(values) + 1, np.int64)
        np.cumsum(values, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def spans(self, data: np.ndarray, kinds: np.ndarray) -> Spans:
        """Longest runs of bytes of one kind other than 0 within a text."""
        n = len(data)
        if n == 0:
            none = np.zeros(0, np.int64)
            return Spans(none, none, none, np.zeros(0, np.uint64))
        edge = np.ones(n + 1, dtype=bool)
        edge[1:n] = kinds[1:] != kinds[:-1]
        edge[self.offsets] = True
        cuts = np.flatnonzero(edge)
        start, end = cuts[:-1], cuts[1:]
        used = kinds[start] != 0
        start, end = start[used], end[used]
        up, down = powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
        hashed = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
        text = np.searchsorted(self.offsets, start, side="right") - 1
        return Spans(start, end, text, hashed)

    def words(self, lower: bool) -> Spans:
        data = self.lowered() if lower else self.data
        return self.spans(data, (~WHITE[data]).astype(np.uint8))


def blocks(texts: pa.Array, max_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a column of texts into blocks; nulls count as empty texts."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    if n == 0:
        return
    _, places, content = texts.buffers()
    offsets = np.frombuffer(places, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(content, np.uint8) if content is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + max_bytes, side="right")) - 1
        last = min(n, max(last, first + 1))
        own = offsets[first : last + 1]
        yield Block(first, last, data[own[0] : own[-1]], own - own[0])
        first = last


def windows(spans: Spans, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words within a text: (first word's index, hash)."""
    n = len(spans.hash) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = total * np.uint64(BASE) + spans.hash[k : n + k]
    first = np.flatnonzero(spans.text[:n] == spans.text[size - 1 :])
    return first, mix(total[first])


def shingle_sets(spans: Spans, n_texts: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word shingles of each text as (text, hash), in order.

    A text of fewer than ``size`` words has its whole sequence as its one shingle, a text
    without words has none.
    """
    first, hashed = windows(spans, size)
    texts = [spans.text[first]]
    hashes = [hashed]
    counts = spans.per_text(n_texts)
    begins = np.cumsum(counts) - counts
    for n in range(1, size):
        short = np.flatnonzero(counts == n)
        total = np.full(len(short), n, np.uint64)
        for k in range(n):
            total = total * np.uint64(BASE) + spans.hash[begins[short] + k]
        texts.append(short)
        hashes.append(mix(total))
    text, hashed = np.concatenate(texts), np.concatenate(hashes)
    order = np.lexsort((hashed, text))
    text, hashed = text[order], hashed[order]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (hashed[1:] != hashed[:-1])
    return text[new], hashed[new]
