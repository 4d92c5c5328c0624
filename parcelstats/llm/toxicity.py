"""Toxicity by a weighted lexicon, matched with Aho-Corasick automata on folded text.

Folding undoes disguises: look-alike letters of other alphabets, digits and signs in place of
letters, combining marks. The lexicon is learned from labelled documents: words and
beginnings of words that occur in toxic documents far more often than in others. A document's
score comes from the weight of its matches, in all and per word, by a logistic curve.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelstats.llm.tables import settle

# Letters of other alphabets, digits and signs that look like Latin letters.
# Latin letters with strokes, hooks and tails are found by their Unicode names instead.
LOOK_ALIKE = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p",
    "с": "c", "т": "t", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d",
    "ѵ": "v", "ԛ": "q", "ԝ": "w", "һ": "h", "ӏ": "l", "ү": "y", "ґ": "r", "ѡ": "w",
    "α": "a", "β": "b", "γ": "y", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v",
    "ο": "o", "ρ": "p", "σ": "o", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ϲ": "c",
    "ϳ": "j", "օ": "o", "ս": "u", "հ": "h", "ո": "n", "ց": "g", "զ": "q", "ք": "p",
    "ı": "i", "ȷ": "j", "ſ": "s", "ᴏ": "o", "ⅼ": "l", "ꞵ": "b",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
# Phrases in which a word of the lexicon means no harm, chosen by hand out of everyday English;
# callers bring their own list as a parameter.
EXCEPTIONS = (
    "trash can", "trash cans", "trash collection", "clown fish", "idiot proof",
    "stupid question", "sore loser", "not stupid", "not worthless",
)
# End of the fixed values.

#: A term must stand in this share of the toxic training documents at least, which bounds the
#: lexicon by the mean number of terms per document over this share, whatever the corpus.
LEAST_SHARE = 0.004
#: A term must be this many times as frequent in toxic documents.
LEAST_RATIO = 25.0
#: Letters of a beginning of a word; longer words are terms as a whole as well.
BEGINNINGS = (4, 5, 6, 7)
#: Labelled documents of each class that the lexicon and the curve are learned from at most.
MAX_PER_CLASS = 25_000
#: Texts that are Python strings at a time, and terms that a task counts before it sends them on.
TEXTS_AT_ONCE = 256
TERMS_HELD = 100_000
TOKEN = regex.compile(r"\p{L}+")
DISGUISED = regex.compile(r"(?<=\p{L})[013457@$8]|[013457@$8](?=\p{L})")
NAMED = regex.compile(r"LATIN (?:SMALL LETTER|LETTER SMALL CAPITAL) ([A-Z])(?: WITH .*)?")


def look_alikes() -> dict[str, str]:
    """All letters that fold to a Latin one: the fixed ones and those whose name says so."""
    out = dict(LOOK_ALIKE)
    for code in range(0x80, 0x2C80):
        named = NAMED.fullmatch(unicodedata.name(chr(code), ""))
        if named:
            out.setdefault(chr(code), named[1].lower())
    return out


FOLD = str.maketrans(look_alikes())


def fold(text: str) -> str:
    """Words of a text in lower case with disguises undone, one space around each."""
    text = text.lower()
    if not text.isascii():
        text = text.translate(FOLD)
        text = "".join(c for c in unicodedata.normalize("NFKC", text) if not unicodedata.combining(c))
    disguised = 1
    while disguised:  # a substitute beside another one becomes a letter's neighbour in turn
        text, disguised = DISGUISED.subn(lambda m: DIGITS[m[0]], text)
    return f" {' '.join(TOKEN.findall(text))} "


def terms(folded: str) -> set[str]:
    """Words, with a space on both sides, and beginnings of words, with one in front."""
    words = set(folded.split())
    return {f" {w} " for w in words} | {f" {w[:n]}" for w in words for n in BEGINNINGS if len(w) >= n}


def few_at_once(texts: pa.Array) -> Iterator[list[str | None]]:
    """The texts of a column, some at a time: a batch of long ones is not held twice."""
    for at in range(0, len(texts), TEXTS_AT_ONCE):
        yield texts.slice(at, TEXTS_AT_ONCE).to_pylist()


def _term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, toxic, documents) of the task's labelled documents, counted as far as memory is kept for it."""

    def rows(counts: dict[tuple[str, int], int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([t for t, _ in counts], pa.string()),
                pa.array([x for _, x in counts], pa.int32()),
                pa.array(list(counts.values()), pa.int64()),
            ],
            names=["term", "toxic", "documents"],
        )

    counts: dict[tuple[str, int], int] = {}
    for batch in batches:
        kinds = iter(batch.column(1).to_pylist())
        for texts in few_at_once(batch.column(0)):
            for text, toxic in zip(texts, kinds):
                for term in terms(fold(text or "")):
                    counts[term, toxic] = counts.get((term, toxic), 0) + 1
            if len(counts) >= TERMS_HELD:
                yield rows(counts)
                counts.clear()
    yield rows(counts)


def learn_lexicon(labelled: DataFrame) -> dict[str, float]:
    """Weight of each term, from rows (text, toxic): the logarithm of how many times as
    frequent it is in toxic documents. A beginning replaces the terms that it covers if it
    is about as telling as they are."""
    sums = labelled.select("toxic").groupBy("toxic").count().toPandas().set_index("toxic")["count"]
    n_toxic, n_clean = int(sums.get(1, 0)), int(sums.get(0, 0))
    if not n_toxic:
        return {}
    toxic, clean = F.col("toxic_documents"), F.col("clean_documents")
    ratio = (toxic + 0.5) / (n_toxic + 1) / ((clean + 0.5) / (n_clean + 1))
    found = (
        labelled.select("text", F.col("toxic").cast("int"))
        .mapInArrow(_term_rows, "term string, toxic int, documents long")
        .groupBy("term")
        .agg(
            F.sum(F.when(F.col("toxic") == 1, F.col("documents")).otherwise(0)).alias("toxic_documents"),
            F.sum(F.when(F.col("toxic") == 0, F.col("documents")).otherwise(0)).alias("clean_documents"),
        )
        .filter(toxic >= max(3.0, LEAST_SHARE * n_toxic))
        .filter(ratio >= LEAST_RATIO)
        .select("term", F.log(ratio).alias("weight"))
        .toPandas()
    )
    weights = dict(zip(found["term"], found["weight"], strict=True))
    kept: dict[str, float] = {}
    for term in sorted(weights, key=lambda t: (len(t), t)):
        covers = [kept[term[:n]] for n in range(2, len(term)) if term[:n] in kept]
        if not covers or weights[term] > max(covers) + 0.7:
            kept[term] = weights[term]
    return kept


def automaton(lexicon: dict[str, float], exceptions: Sequence[str]) -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for term, weight in lexicon.items():
        out.add_word(term, (len(term), weight))
    for phrase in exceptions:
        folded = fold(phrase)
        out.add_word(folded, (len(folded), None))
    out.make_automaton()
    return out


def matches(machine: ahocorasick.Automaton, folded: str) -> tuple[float, int]:
    """(weight of all matches, words). The heaviest term of a word counts, none inside an
    exception phrase."""
    n_words = folded.count(" ") - 1
    if not len(machine):
        return 0.0, n_words
    best: dict[int, float] = {}
    spared: list[tuple[int, int]] = []
    for end, (length, weight) in machine.iter(folded):
        start = end - length + 1
        if weight is None:
            spared.append((start, end))
        elif weight > best.get(start, 0.0):
            best[start] = weight
    for start, end in spared:
        for place in [p for p in best if start <= p < end]:
            del best[place]
    return sum(best.values()), n_words


def features(weight: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Weight in all and per word, both on a logarithmic scale."""
    return np.stack([np.log1p(weight), np.log1p(100 * weight / np.maximum(words, 1))], axis=1)


def fit_curve(x: np.ndarray, y: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Logistic regression with a constant, by Newton steps on a penalised likelihood.

    ``share`` weighs each row, so that classes learned from in part count as a whole.
    """
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (share * (y - p)) - 0.01 * w
        bend = (x * (share * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _measure(lexicon: dict[str, float], exceptions: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(lexicon, exceptions)
        for batch in batches:
            found = [matches(machine, fold(t or "")) for some in few_at_once(batch.column(1)) for t in some]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([f[0] for f in found], pa.float64()),
                    pa.array([f[1] for f in found], pa.int64()),
                ],
                names=["id", "weight", "words"],
            )

    return run


def training_part(id: Column) -> Column:
    """Whether a row's label may be learned from: crc32 of the id as text, modulo 4, is not 2."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 4 != 2, F.lit(True))


class ToxicityModel:
    """Lexicon and curve; small enough to travel with the tasks."""

    def __init__(self, lexicon: dict[str, float], curve: np.ndarray, exceptions: Sequence[str]):
        self.lexicon, self.curve, self.exceptions = lexicon, curve, tuple(exceptions)

    def score(self, docs: DataFrame, text: str = "text", to: str = "toxicity") -> DataFrame:
        """``docs`` with the probability ``to`` (0 to 1) that a document is toxic.

        Whole texts are scored; a null or empty text gets the score of no match. Repeated
        rows score alike, all columns are kept but one named ``to``, an empty table stays empty.
        """
        lexicon, curve, exceptions = self.lexicon, self.curve, self.exceptions

        @F.arrow_udf("double")
        def scored(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
            machine = automaton(lexicon, exceptions)
            for texts in columns:
                found = [matches(machine, fold(t) if t else "  ") for some in few_at_once(texts) for t in some]
                weight = np.array([f[0] for f in found], float)
                x = features(weight, np.array([f[1] for f in found], float))
                z = np.clip(x @ curve[:-1] + curve[-1], -30, 30)
                yield pa.array(1 / (1 + np.exp(-z)))

        return docs.withColumn(to, scored(F.col(text)))


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    training: Column | None = None,
    exceptions: Sequence[str] = EXCEPTIONS,
    max_per_class: int = MAX_PER_CLASS,
) -> ToxicityModel:
    """Learn from the labelled documents whose ids ``training`` admits.

    At most ``max_per_class`` toxic and as many other documents are learned from, those with
    the smallest hash of the id; the list of their ids is all that is sent to the tasks. Null
    labels and ids are left out; of contradicting labels for an id the larger counts. Without
    a toxic document nothing is ever toxic.
    """
    admitted = training_part(F.col("id")) if training is None else training
    own = (
        labels.select(F.col(id).alias("id"), F.col(label).cast("int").alias("toxic"))
        .filter(F.col("id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy("id").agg(F.max("toxic").alias("toxic"))
        .filter(admitted)
    )
    classes = [
        own.filter(F.col("toxic") == kind).orderBy(F.xxhash64("id"), "id").limit(max_per_class)
        for kind in (0, 1)
    ]
    chosen = settle(classes[0].union(classes[1]))
    totals = dict(own.groupBy("toxic").count().collect())
    # 2 * max_per_class rows at most.
    pairs = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")
    lexicon = learn_lexicon(pairs)
    rows = (
        pairs.select("toxic", "text")
        .mapInArrow(_measure(lexicon, exceptions), "id int, weight double, words long")
        .toPandas()
    )
    if rows["id"].nunique() < 2:
        return ToxicityModel(lexicon, np.array([1.0, 0.0, -4.0]), exceptions)
    rows = rows.sort_values(["id", "weight", "words"])  # sums in one order, however the rows came
    x, y = features(rows["weight"].to_numpy(), rows["words"].to_numpy()), rows["id"].to_numpy()
    share = np.array([totals[kind] / min(totals[kind], max_per_class) for kind in (0, 1)])[y]
    return ToxicityModel(lexicon, fit_curve(x, y.astype(float), share * len(y) / share.sum()), exceptions)
