"""Secret scans with a random forest that removes false positives.

Candidates are long runs of key-like characters with a digit or in capitals, and every value
that is assigned right after a word that announces it. A random forest on their
length, changes of character class, dictionary coverage, path and neighbouring words,
trained from labelled findings, tells secrets from addresses, numbers and names. Words have
weights learned from one part of the labelled findings, the forest is fitted on another, and a
third is held back to judge it by. Only DataFrame functions are used: texts are cut at their
candidates within the row, and the trees become one column expression, so that scanning
needs no exchange.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from math import log

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelstats.llm.tables import settle, unused_names

#: Characters before and after a candidate that neighbouring words are read from.
NEAR = 64
MARK = "[secret]"
MAX_FIT = 20_000
DICTIONARY = 300
#: Neighbouring words with a weight: those in most labelled findings, and in a few at least. The
#: weight of a word stands between plus and minus its largest.
NEIGHBOURS = 300
LARGEST = 3.0
LEAST_SEEN = 5
UNTOLD = -1.0
TREES = 20
DEPTH = 5
SEED = 11

# Words that announce a secret, and parts of paths that hold none.
ANNOUNCED = (
    r"(?i:pass(?:word|wd|phrase)?|pwd|secret(?!ar)|token|(?:api|access|private)[_ -]?key|auth(?!or(?!i[sz]))|credential)"
)
# What may follow such a word in its name: SECRET_KEY, tokenValue, credentials, Authorization.
SUFFIX = r"(?i:s|ori[sz]ation|entication|entials?)?(?:[A-Z0-9_.-][A-Za-z0-9_.-]{0,20})?"
SCHEME = r"(?i:bearer|basic|token)\s{1,4}"
HARMLESS_PATH = r"(?i)(test|example|sample|fixture|mock|docs?/)"
# Key formats that need no context: prefix and alphabet of well-known services.
FORMATS = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abp]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9]{20,})$"
# Assigned values that name or describe a secret but are none.
PLACEHOLDER = (
    r"^(?i:none|null|nil|true|false|undefined|str|string|int|integer|bool|boolean|bytes|x{3,}|\*{3,}|\.{3,})$"
    r"|^(\$\{?\w+|\$\(|\{\{|<\w|%\(?\w+[)%])|^[A-Za-z_][\w.]*(\(|\[[\"'\w])"
)
# End of the fixed values.

#: A name with an announcing word, up to the value assigned to it.
LED = ANNOUNCED + SUFFIX + r"[\"'`\\\]]{0,3}\s{0,4}(?::=|=>|==?|:)\s{0,4}"
#: The same as the end of the text before a value.
NAMED = LED + r"(?:\\?[\"'`])?(?:" + SCHEME + ")?$"
#: Quoted values go up to their quote; others to white space, less closing punctuation or a next parameter.
QUOTED = "".join(rf"(?<={LED}{q})(?:[^{q}\\\r\n]++|\\.)++(?={q})|" for q in ("\"", "'"))
BARE = (
    r"(?:[^\s\"'`&.,;:)\]}<\\]++|[.,;:)\]}\\]++(?=[^\s\"'`&.,;:)\]}<\\])|'(?=\w)|&(?!\w{1,30}=)|<(?![/A-Za-z]))++"
)
#: The first conditions are cheap and rule nearly every place out.
ASSIGNED = (
    rf"(?<=[=:>\s\"'`])(?<=[=:>]\s{{0,4}}\\?[\"'`]?(?:{SCHEME})?)(?![\s\"'`]|{SCHEME}|[\[{{(]+(?:[\s\"'`]|$))"
    rf"(?:{QUOTED}(?<={LED}(?:\\?[\"'`])?(?:{SCHEME})?){BARE})"
)
CANDIDATE = (
    rf"{ASSIGNED}|(?<![A-Za-z0-9_+/.@-])(?=[A-Za-z_+/.@-]*[0-9]|[A-Z]{{16}})"
    r"[A-Za-z0-9_+/.@-]{12,}={0,2}"
)

#: Columns of a finding, then those that the forest decides by.
FEATURES = (
    "length", "digits", "capitals", "marks", "changes", "variety", "covered", "hex", "one_case",
    "assigned", "quoted", "address", "harmless_path", "words_before", "last_word", "words_after",
)
#: Parts of the labelled findings, by a hash of the finding: for word weights, forest, judgement.
PARTS = 4
WORDS_PART, HELD_BACK = (0,), (3,)
WORD = "[a-z]+"


def candidates(text: Column, parts: Column) -> Column:
    """Array of (value, before, after) of a text, given the parts between its candidates.

    A candidate may stand in the name that a value is assigned to, so ``before`` goes on through
    the candidate in front.
    """
    found = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    near = lambda i: F.concat_ws(
        "", F.when(i > 0, F.concat(F.right(F.get(parts, i - 1), F.lit(NEAR)), F.right(F.get(found, i - 1), F.lit(NEAR)))), F.get(parts, i)
    )
    return F.transform(
        found,
        lambda value, i: F.struct(
            value.alias("value"),
            F.right(near(i), F.lit(NEAR)).alias("before"),
            F.left(F.get(parts, i + 1), F.lit(NEAR)).alias("after"),
        ),
    )


def _share(value: Column, pattern: str) -> Column:
    """Share of the characters that match."""
    return 1.0 - F.length(F.regexp_replace(value, pattern, "")) / F.length(value)


def _words(context: Column) -> Column:
    """Words of a context, also those within a name like apiKey or SECRET_KEY."""
    parted = F.regexp_replace(context, "(?<=[a-z])(?=[A-Z])", " ")
    return F.regexp_extract_all(F.lower(parted), F.lit(WORD), F.lit(0))


def _weight_of(words: Column, weights: dict[str, float]) -> Column:
    """Largest and smallest weight among words, added.

    Most places hold no secret, so words without any weight speak against one, a little.
    """
    if not weights:
        return F.lit(UNTOLD)
    known = F.create_map(*[F.lit(x) for pair in sorted(weights.items()) for x in pair])
    found = F.filter(F.transform(words, lambda w: F.try_element_at(known, w)), lambda w: w.isNotNull())
    both = F.greatest(F.array_max(found), F.lit(0.0)) + F.least(F.array_min(found), F.lit(0.0))
    return F.when(F.size(found) > 0, both).otherwise(F.lit(UNTOLD))


def word_weights(labelled: DataFrame, size: int = NEIGHBOURS) -> dict[str, float]:
    """How much more often a word stands beside secrets than beside other findings.

    From rows (before, after, label), each word once per finding: the logarithm of the ratio
    of its shares, between plus and minus ``LARGEST``, for the ``size`` most frequent words of ``LEAST_SEEN`` findings or more.
    """
    words = F.array_distinct(F.concat(_words(F.col("before")), _words(F.col("after"))))
    sums = dict(labelled.groupBy("label").count().collect())
    secret, other = sums.get(1, 0), sums.get(0, 0)
    rows = (
        labelled.select("label", F.explode(words).alias("word")).groupBy("word")
        .agg(F.sum(F.col("label").cast("long")).alias("secret"), F.count("*").alias("n"))
        .filter(F.col("n") >= LEAST_SEEN).orderBy(F.desc("n"), "word").limit(size).collect()
    )
    ratio = lambda r: ((r["secret"] + 0.5) / (secret + 1)) / ((r["n"] - r["secret"] + 0.5) / (other + 1))
    return {r["word"]: round(max(-LARGEST, min(LARGEST, log(ratio(r)))), 6) for r in rows}


def described(
    finding: Column, path: Column, dictionary: Sequence[str], weights: dict[str, float] | None = None
) -> Column:
    """A finding (value, before, after) with the numbers that the forest decides by."""
    value, before, after = (finding.getField(f) for f in ("value", "before", "after"))
    yes = lambda condition: F.when(condition, 1.0).otherwise(0.0)
    runs = F.regexp_replace(value, r"([a-z]+|[A-Z]+|[0-9]+|[^a-zA-Z0-9]+)", "x")
    variety = F.array_size(F.array_distinct(F.split(value, "")))
    covered = (
        _share(F.lower(value), "(" + "|".join(map(re.escape, dictionary)) + ")") if dictionary else F.lit(0.0)
    )
    numbers = {
        "length": F.length(value).cast("double"),
        "digits": _share(value, "[0-9]"),
        "capitals": _share(value, "[A-Z]"),
        "marks": _share(value, "[^a-zA-Z0-9]"),
        "changes": F.length(runs) / F.length(value),
        "variety": variety / F.length(value),
        "covered": covered,
        "hex": yes(value.rlike("^([0-9a-f]+|[0-9A-F]+)$")),
        "one_case": yes(value.rlike("^([0-9a-z]+|[0-9A-Z]+)$")),
        "assigned": yes(before.rlike(r"[=:]\s*[\"']?$")),
        "quoted": yes(before.rlike("[\"']$") & after.rlike("^[\"']")),
        "address": yes(value.rlike(r"@|^[0-9.]+$|\.(com|org|net|html?)")),
        "harmless_path": yes(F.coalesce(path, F.lit("")).rlike(HARMLESS_PATH)),
        "words_before": _weight_of(_words(before), weights or {}),
        "last_word": _weight_of(F.slice(_words(F.concat(F.lit("x "), before)), -1, 1), weights or {}),
        "words_after": _weight_of(_words(after), weights or {}),
    }
    return F.struct(
        value.alias("value"), before.alias("before"), after.alias("after"),
        *(numbers[f].cast("double").alias(f) for f in FEATURES),
    )


def weak_label(value: Column, before: Column) -> Column:
    """Label of a finding where nobody has looked at it, null where the rules cannot tell.

    1: a well-known format, or a value with letters and digits that is assigned right after a
    word that announces it. 0: a placeholder, or nothing announces it. Any other value with an
    announcing word near it has no label.
    """
    mixed = value.rlike(r"^(?=.*[A-Za-z])(?=.*[0-9])\S+$")
    return (
        F.when(value.rlike(FORMATS), 1)
        .when(before.rlike(NAMED), F.when(value.rlike(PLACEHOLDER), 0).when(mixed, 1))
        .when(~before.rlike(ANNOUNCED), 0)
    )


def learn_dictionary(findings: DataFrame, size: int = DICTIONARY) -> list[str]:
    """The most frequent words around the findings, longest first."""
    words = F.regexp_extract_all(F.lower(F.concat_ws(" ", "before", "after")), F.lit("(?<![a-z0-9])[a-z]{3,}(?![a-z0-9])"), F.lit(0))
    rows = (
        findings.select(F.explode(words).alias("word"))
        .groupBy("word").count().orderBy(F.desc("count"), "word").limit(size).collect()
    )
    return sorted((r["word"] for r in rows), key=lambda w: (-len(w), w))


def part_of(findings: DataFrame) -> Column:
    """Part of the labelled findings that a row (value, before, after) is in; alike ones share it."""
    return F.pmod(F.xxhash64(F.lit(SEED), "value", "before", "after"), F.lit(PARTS))


def fit_forest(
    findings: DataFrame, dictionary: Sequence[str], weights: dict[str, float] | None = None
) -> Callable[[Column], Column]:
    """Forest from rows (value, before, after, path, label), as a function from a described
    finding to the share of trees that call it a secret.

    The rows are bounded in number. They are put in one order in one partition, since the
    draws of the forest go by place, so the same rows give the same trees however they came.
    """
    finding = F.struct("value", "before", "after")
    rows = settle(
        findings.filter("label is not null")
        .select(described(finding, F.col("path"), dictionary, weights).alias("f"), F.col("label").cast("double").alias("label"))
        .select("f.*", "label")
        .repartition(1)
        .sortWithinPartitions("value", "before", "after", *FEATURES, "label")
    )
    kinds = [r["label"] for r in rows.select("label").distinct().collect()]
    if len(kinds) < 2:
        constant = float(kinds[0]) if kinds else 0.0
        return lambda finding: F.lit(constant)
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt", minInstancesPerNode=2
    ).fit(vectors.select("features", "label"))
    trees = [_parsed(tree.toDebugString) for tree in forest.trees]

    def score(finding: Column) -> Column:
        total = F.lit(0.0)
        for tree in trees:
            total = total + _tree_column(tree, finding)
        return total / float(len(trees))

    return score


def _parsed(description: str):
    """A tree from Spark's own description: (feature, threshold, below, above) or a class."""
    lines = [line.strip() for line in description.splitlines()[1:] if line.strip()]

    def node(at: int):
        if lines[at].startswith("Predict"):
            return float(lines[at].split(":")[1]), at + 1
        feature, threshold = re.match(r"If \(feature (\d+) <= (\S+)\)", lines[at]).groups()
        below, at = node(at + 1)
        above, at = node(at + 1)  # past the line with Else
        return (int(feature), float(threshold), below, above), at

    return node(0)[0]


def _tree_column(tree, finding: Column) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    feature, threshold, below, above = tree
    return F.when(
        finding.getField(FEATURES[feature]) <= threshold, _tree_column(below, finding)
    ).otherwise(_tree_column(above, finding))


def labelled_sample(found: DataFrame, max_fit: int = MAX_FIT) -> DataFrame:
    """About ``max_fit`` findings at most, chosen by a hash of their value, with weak labels."""
    n = found.count()
    share = int((1 << 20) * min(1.0, max_fit / max(n, 1)))
    return found.filter(F.pmod(F.xxhash64("value"), F.lit(1 << 20)) < share).withColumn(
        "label", weak_label(F.col("value"), F.col("before"))
    )


class SecretModel:
    """Dictionary, word weights and forest; as columns, so that nothing is sent to the tasks."""

    def __init__(self, findings: DataFrame, dictionary: Sequence[str]):
        """Learn from labelled findings (value, before, after, path, label), bounded in number."""
        labelled = findings.filter("label is not null").withColumn("part", part_of(findings))
        for_words = labelled.filter(F.col("part").isin(*WORDS_PART))
        self.dictionary = list(dictionary)
        self.weights = word_weights(for_words)
        rest = labelled.filter(~F.col("part").isin(*WORDS_PART, *HELD_BACK))
        # Where so few are labelled that this part has one kind only, all but the held-back ones.
        if rest.select("label").distinct().count() < 2:
            rest = labelled.filter(~F.col("part").isin(*HELD_BACK))
        if rest.select("label").distinct().count() < 2:
            rest = labelled
        self.forest = fit_forest(rest.drop("part"), self.dictionary, self.weights)

    def described(self, finding: Column, path: Column) -> Column:
        return described(finding, path, self.dictionary, self.weights)

    def judged(self, findings: DataFrame, threshold: float = 0.5) -> dict[str, int]:
        """How the labelled findings that were held back are told: counts of right and wrong."""
        held = findings.filter("label is not null").withColumn("part", part_of(findings)).filter(F.col("part").isin(*HELD_BACK))
        told = held.withColumn("f", self.described(F.struct("value", "before", "after"), F.col("path")))
        secret = self.forest(F.col("f")) >= threshold
        kinds = {"found": secret & (F.col("label") == 1), "false": secret & (F.col("label") == 0),
                 "missed": ~secret & (F.col("label") == 1), "left": ~secret & (F.col("label") == 0)}
        return told.agg(*[F.count_if(c).alias(n) for n, c in kinds.items()]).first().asDict()


def own_findings(docs: DataFrame, text: str = "text", path: str = "source") -> DataFrame:
    """All candidates of the texts: (path, value, before, after)."""
    parts = F.split(F.col(text), CANDIDATE, -1)
    cut = docs.select(F.col(path).cast("string").alias("path"), F.col(text).alias("text"), parts.alias("parts"))
    found = cut.select("path", candidates(F.col("text"), F.col("parts")).alias("found")).filter(F.size("found") > 0)
    return found.select("path", F.explode("found").alias("f")).select("path", "f.*")


def learn(docs: DataFrame, text: str = "text", path: str = "source", max_fit: int = MAX_FIT) -> tuple[SecretModel, DataFrame]:
    """Model and labelled findings of documents that nobody has looked at.

    The dictionary comes from the words around all candidates; ``weak_label`` labels a sample
    of at most about ``max_fit`` of them, which is what the word weights and the forest see.
    """
    found = settle(own_findings(docs, text, path))
    findings = settle(labelled_sample(found, max_fit))
    return SecretModel(findings, learn_dictionary(found)), findings


def scan_secrets(
    docs: DataFrame,
    text: str = "text",
    path: str = "source",
    findings: DataFrame | None = None,
    threshold: float = 0.5,
) -> DataFrame:
    """``docs`` with a column ``findings``: an array of (value, before, after, score, secret).

    ``findings`` are labelled findings to train from (value, before, after, path, label);
    without them a bounded sample of the documents' own is labelled by ``weak_label``.
    Without labels of both kinds the label there is (or 0) is everyone's score. A
    null text has a null array, a text without candidates an empty one. Repeated rows and null
    ids change nothing; an existing column ``findings`` is replaced, all others are kept.
    """
    rows = docs.drop("findings")
    where, parts, found, told = unused_names(rows.columns, 4, "_secret_scan")
    if findings is None:
        model, _ = learn(docs, text, path)
    else:
        findings = settle(findings)
        model = SecretModel(findings, learn_dictionary(findings))
    score = model.forest
    scanned = (
        rows.withColumns({where: F.col(path).cast("string"), parts: F.split(F.col(text), CANDIDATE, -1)})
        .withColumn(found, candidates(F.col(text), F.col(parts)))
        .withColumn(told, F.transform(found, lambda f: model.described(f, F.col(where))))
    )
    scored = F.transform(
        told,
        lambda f: F.struct(
            f.getField("value").alias("value"), f.getField("before").alias("before"),
            f.getField("after").alias("after"), score(f).alias("score"), (score(f) >= threshold).alias("secret"),
        ),
    )
    return scanned.withColumn("findings", scored).drop(where, parts, found, told)


def redacted(text: Column, findings: Column, mark: str = MARK) -> Column:
    """The text with every secret among its findings replaced; texts without one unchanged."""
    parts = F.split(text, CANDIDATE, -1)
    shown = F.transform(
        findings, lambda f: F.when(f.getField("secret"), F.lit(mark)).otherwise(f.getField("value"))
    )
    rebuilt = F.array_join(F.zip_with(parts, shown, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    return F.when(F.exists(findings, lambda f: f.getField("secret")), rebuilt).otherwise(text)
