"""Quality rules under weak supervision.

Rules on counts of a text vote for or against it or abstain. Expectation-maximisation
estimates from all documents how often each rule votes either way on good and on bad texts,
and the posterior probability of a good text replaces a filter that demands every rule.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelstats.llm.tables import settle
from parcelstats.llm.words import WHITE, Block, blocks, mix, windows

WINDOW = 5
SYMBOLS = np.zeros(256, dtype=np.int64)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = 1
#: Bytes that begin a character, letters (every character outside ASCII counts as one), capitals.
FIRST = np.array([(b & 0xC0) != 0x80 for b in range(256)], dtype=np.int64)
LETTERS = np.array([chr(b).isalpha() if b < 128 else b >= 0xC0 for b in range(256)], dtype=np.int64)
CAPITALS = np.array([65 <= b <= 90 for b in range(256)], dtype=np.int64)
SMALL = np.array([97 <= b <= 122 for b in range(256)], dtype=np.int64)

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_distinct_words", "n_letters", "n_capitals", "n_small",
)


def count(block: Block) -> dict[str, np.ndarray]:
    """Counts per text of a block; see ``measure``."""
    n, data = block.n_texts, block.data
    words = block.words(lower=False)
    n_words = words.per_text(n)
    inside = (~WHITE[data]).astype(np.int64)
    lines = block.spans(data, (data != 10).astype(np.uint8))
    with_word = np.concatenate([[0], np.cumsum(inside)])
    used = with_word[lines.end] > with_word[lines.start]
    n_lines, n_own_lines = _distinct(lines.text[used], lines.hash[used], n)
    first, hashed = windows(words, WINDOW)
    key = mix(hashed ^ mix(words.text[first].astype(np.uint64)))
    _, back, times = np.unique(key, return_inverse=True, return_counts=True)
    again = first[times[back] > 1]
    cover = np.zeros(len(words.hash) + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, np.minimum(again + WINDOW, len(words.hash)), -1)
    repeated = np.cumsum(cover)[:-1] > 0
    return {
        "n_words": n_words,
        "word_chars": block.sums(FIRST[data] * inside),
        "n_symbols": block.sums(SYMBOLS[data]),
        "n_dup_lines": n_lines - n_own_lines,
        "n_repeat_words": np.bincount(words.text, repeated, n).astype(np.int64),
        "n_lines": n_lines,
        "n_distinct_words": _distinct(words.text, words.hash, n)[1],
        "n_letters": block.sums(LETTERS[data] * inside),
        "n_capitals": block.sums(CAPITALS[data]),
        "n_small": block.sums(SMALL[data]),
    }


def _distinct(text: np.ndarray, hashed: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Members and distinct members of each text."""
    _, at = np.unique(mix(hashed ^ mix(text.astype(np.uint64))), return_index=True)
    return np.bincount(text, minlength=n), np.bincount(text[at], minlength=n)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch.column(1)):
            found = count(block)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(block.first, block.n_texts),
                    *(pa.array(found[c].astype(np.int64)) for c in COUNTS),
                ],
                names=["id", *COUNTS],
            )


def measure(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id and its counts over the whole text.

    n_words: runs other than 0x20, 0x09-0x0D; word_chars: characters in them; n_symbols:
    characters of ``#*$%&|<>``; n_lines: lines with a word; n_dup_lines: those equal to an
    earlier one; n_repeat_words: words in windows of five words that the text has twice or
    more; n_distinct_words; n_letters (in words; characters outside ASCII count), n_capitals
    and n_small (A-Z, a-z). Null and empty texts count 0 throughout.
    """
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, " + ", ".join(f"{c} long" for c in COUNTS)
    return rows.mapInArrow(_measured, schema).withColumnRenamed("id", id)


def _against(bad: Column) -> Column:
    return F.when(bad, "-").otherwise("0")


def votes() -> dict[str, Column]:
    """The rules: "+" for a good text, "-" for a bad one, "0" where a rule has nothing to say.

    Most know only what speaks against a text; ``prose`` is the one that speaks for it.
    """
    n = F.col("n_words")
    some = n >= 10
    chars, letters = F.col("word_chars"), F.col("n_letters")
    cased = F.col("n_capitals") + F.col("n_small")
    few_symbols = 50 * F.col("n_symbols") <= n
    varied = F.col("n_distinct_words") >= F.least(0.35 * n, 8 * F.sqrt(n))
    return {
        "length": _against(n < 10),
        "word_length": _against((chars < 2 * n) | (chars > 14 * n)),
        "symbols": _against(10 * F.col("n_symbols") > n),
        "lines": _against(10 * F.col("n_dup_lines") > 3 * F.col("n_lines")),
        "repeats": _against(5 * F.col("n_repeat_words") > n),
        "letters": _against((100 * letters < 75 * chars) & some),
        "variety": _against(some & (F.col("n_distinct_words") < F.least(0.2 * n, 3 * F.sqrt(n)))),
        "capitals": _against((2 * F.col("n_capitals") > cased) & some),
        "prose": F.when(some & few_symbols & varied & (100 * letters >= 85 * chars), "+").otherwise("0"),
    }


def estimate(patterns: list[str], counts: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Probability of a good text for each pattern of votes, by expectation-maximisation.

    A rule that votes does so at a rate of its own on good and on bad texts; its accuracy is how
    far these differ. An abstention says nothing. All start from the reading that a text with a
    vote against it is likely bad, and the share of texts without one stays the share of good
    texts: where most rules abstain, votes alone do not tell it. A vote against never raises the probability and a vote
    for never lowers it, whatever else the texts differ in.
    """
    if not patterns:
        return np.zeros(0)
    votes = np.array([["+-0".index(v) for v in p] for p in patterns])
    against = (votes == 1).any(axis=1)
    good = np.where(against, 0.1, 0.95)
    share = np.clip(counts[~against].sum() / counts.sum(), 0.5, 0.95)
    for _ in range(rounds):
        odds = np.full(len(patterns), np.log(share / (1 - share)))
        for k in range(votes.shape[1]):
            rate = []
            for weight in (counts * good, counts * (1 - good)):
                rate.append((np.bincount(votes[:, k], weight, 3) + 0.5) / (weight.sum() + 1.5))
            ratio = np.log(rate[0] / rate[1])
            odds += np.array([max(ratio[0], 0.0), min(ratio[1], 0.0), 0.0])[votes[:, k]]
        new = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        if np.abs(new - good).max() < 1e-9:
            break
        good = new
    return new


def judge(docs: DataFrame, id: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """``measure`` with base_failed, quality (posterior of a good text) and kept.

    ``base_failed``: fewer than 10 words, or more than a fifth of them repeated; such a text
    is not kept. Others are kept if their quality is ``least`` or more. Patterns of votes are
    counted over all documents; there are at most 3 to the number of rules, so that their
    table is small whatever the corpus. Repeated rows count as often as they occur; other columns
    are ignored; an empty table gives an empty result.
    """
    measured = settle(measure(docs, id, text))
    voted = measured.withColumn("votes", F.concat(*votes().values()))
    tally = sorted(tuple(r) for r in voted.groupBy("votes").count().collect())
    patterns = [p for p, _ in tally]
    quality = estimate(patterns, np.array([float(c) for _, c in tally]))
    known = docs.sparkSession.createDataFrame(
        list(zip(patterns, quality.tolist(), strict=True)), "votes string, quality double"
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (
        voted.join(F.broadcast(known), "votes")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))
    )
