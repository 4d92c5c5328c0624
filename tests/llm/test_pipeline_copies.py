"""The near-duplicate stage decides by row, not by id."""

import corpus_pipeline

TEXTS = {
    "a": "one two three four five six seven eight nine ten",
    "b": "an entirely different text that nobody else in here has",
    "c": "and a third one which is unlike the two that went before",
}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, place string, node long"


def left(spark, pairs):
    rows = [(i, TEXTS.get(t, t), "en", "s", 1, "x", 1) for i, t in pairs]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    names = {v: k for k, v in TEXTS.items()}
    kept = corpus_pipeline.keep_one_of_copies(spark, docs, "")
    assert kept.columns == list(corpus_pipeline.COLUMNS)
    return sorted(((r.doc_id, names.get(r.text, r.text)) for r in kept.collect()), key=str)


def test_an_id_with_two_texts_keeps_the_unique_one(spark):
    assert left(spark, [(1, "a"), (1, "a"), (2, "a"), (2, "b"), (3, "c")]) == [(1, "a"), (2, "b"), (3, "c")]


def test_rows_without_ids_or_words(spark):
    pairs = [(None, "a"), (None, "a"), (5, "a"), (None, "b"), (None, "b"), (6, None), (6, None), (7, ""), (8, " ")]
    assert left(spark, pairs) == sorted(
        [(5, "a"), (None, "b"), (6, None), (6, None), (7, ""), (8, " ")], key=str
    )


def test_an_empty_table(spark):
    assert left(spark, []) == []
