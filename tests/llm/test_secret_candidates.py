"""Labels and candidates of secret scans where the announcing word and the value are not side by side, or the value is short."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from parcelstats.llm import secrets

ANNOUNCED = (
    ('{"api_key": "', "zk3Jq8LmPw92xYt7"), ("SECRET_KEY=", "abcd1234efgh"), ("private_key = ", "k9abk9abk9ab3"),
    ("Authorization: Bearer ", "eyJhbGciOi.eyJzdWIi0.c2ln-9"), ("client_secret: '", "a1b2c3d4e5f6"),
)


def test_announced_values_are_no_negatives(spark):
    rows = [*((b, v, 1) for b, v in ANNOUNCED), ("token = \"", "qwErTyUiOpAsDfGh", None), ("the token is ", "abcdefgh12345", None),
            ("password=", "None", 0), ("call ", "0123456789012", 0), ("author: ", "person1234567", 0)]
    frame = spark.createDataFrame(rows, "before string, value string, label int")
    for r in frame.withColumn("found", secrets.weak_label(F.col("value"), F.col("before"))).collect():
        assert r["found"] == r["label"], r


SHORT = {
    "password=hunter2": "password=[secret]",
    "pwd: Tr0ub4dor&3, next": "pwd: [secret], next",
    'token = "qwErTyUiOpAsDfGh"': 'token = "[secret]"',
    "pass: p!a#s$s%9 end": "pass: [secret] end",
    "url?token=a1b2c3&user=bob": "url?token=[secret]&user=bob",
    '{"Authorization": "Bearer abc.12-3"}': '{"Authorization": "Bearer [secret]"}',
    'db_password: "it\\"s 9 lives"': 'db_password: "[secret]"',
    "API_KEY_12345678=zz9zz rest": None,
    '"auth": {"user": 1}': '"auth": {"user": 1}',
    "author: Smith9, secretary: Mary4": "author: Smith9, secretary: Mary4",
}


def test_short_values_and_any_alphabet_are_redacted(spark):
    texts = [*SHORT, *(f'key token = "{k * 7919:x}f00ba4{k:04d}c3"' for k in range(40)), *(f"write to person{k}.90@mail.example.com" for k in range(40))]
    docs = spark.createDataFrame([(k, t, "s") for k, t in enumerate(texts)], "doc_id long, text string, source string")
    scanned = secrets.scan_secrets(docs).withColumn("clean", secrets.redacted(F.col("text"), F.col("findings")))
    found = {r["text"]: r["clean"] for r in scanned.collect()}
    for text, clean in SHORT.items():
        assert "zz9zz" not in found[text] if clean is None else found[text] == clean
    assert all(found[t] == t for t in texts if t.startswith("write"))


@pytest.mark.parametrize("value", ["x" * 200_000, 'a"' * 3, "a.b" * 60_000])
def test_values_of_any_length_are_cut_whole(spark, value):
    docs = spark.createDataFrame([(f"password={value}",), (f"password='{value}'",)], "text string")
    parts = F.split("text", secrets.CANDIDATE, -1)
    rows = docs.select("text", secrets.candidates(F.col("text"), parts).alias("found"), parts.alias("parts")).collect()
    for r in rows:
        assert len(r["parts"]) == len(r["found"]) + 1 and len(r["found"]) > 0
    assert rows[1]["found"][0]["value"] == value


def labelled(spark):
    """Keys beside words that speak of keys; build numbers beside words that do not, one in eight mislabelled."""
    rows = []
    for k in range(400):
        code = f"{(k * 7919 + 13) % 99991:05d}"
        rows.append((f"k{code}Qz{code[::-1]}Xw{k % 7}", "the deploy credential is ", " for prod", "app", 1))
        # Looks like the others' values, but stands in a list of builds.
        rows.append((f"b{code}Qz{code[::-1]}Xw{k % 7}", "artifact build ", " was fetched", "app", 1 if k % 8 == 0 else 0))
        rows.append((f"release-2024{code}-notes", "password=", " see below", "docs/", 1 if k % 8 == 0 else 0))
    return spark.createDataFrame(rows, "value string, before string, after string, path string, label int")


def test_the_forest_judges_by_words_and_shape_where_labels_are_wrong(spark):
    findings = labelled(spark)
    model = secrets.SecretModel(findings, secrets.learn_dictionary(findings))
    assert model.weights["credential"] > 1 and model.weights["artifact"] < -1
    told = model.judged(findings)
    # Every mislabelled finding that was held back is told by its kind, not by its label.
    held = findings.withColumn("part", secrets.part_of(findings)).filter(F.col("part").isin(*secrets.HELD_BACK))
    keys = held.filter("before like '%credential%'").count()
    assert told["found"] == keys and told["false"] == 0
    assert told["missed"] == held.filter("label = 1").count() - keys > 0


def test_scores_do_not_depend_on_the_partitioning(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "source")
    scores = []
    for parts in (2, 13):
        scanned = secrets.scan_secrets(docs.repartition(parts, "text"))
        scores.append(sorted((r.doc_id, [(f.value, f.score, f.secret) for f in r.findings]) for r in scanned.collect() if r.findings))
    assert scores[0] == scores[1] and any(f[2] for _, fs in scores[0] for f in fs)


def test_columns_of_the_caller_stay(spark):
    taken = ["_path", "_parts", "_found", "_told", "_secret_scan_1", "value"]
    schema = "text string, source string, " + ", ".join(f"{c} int" for c in taken)
    found = secrets.scan_secrets(spark.createDataFrame([("password=hunter2", "s", *range(6)), (None, None, *range(6))], schema))
    assert found.columns == ["text", "source", *taken, "findings"]
    assert all([r[c] for c in taken] == list(range(6)) for r in found.collect())
