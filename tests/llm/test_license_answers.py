"""Tags, denials, long paragraphs, nesting and clashing names of the licence scan."""

import pytest

from parcelstats.llm import licenses, oracle
from parcelstats.llm.queries import op7_license_scan
from tests.compare import differences, duckdb_on

AGPL = """// This program is free software: you can redistribute it and/or modify
// it under the terms of the GNU Affero General Public License as published by
// the Free Software Foundation, either version 3 of the License, or
// (at your option) any later version.
"""
LONG = "/*\n" + "\n".join(
    f" * {w}" for w in "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.".split()
) + "\n */\nx"
ANSWERS = {
    "SPDX-License-Identifier: MIT": "MIT",
    "// SPDX-License-Identifier: (Apache-2.0 OR MIT)": "Apache-2.0",
    "# SPDX-License-Identifier: GPL-2.0-or-later\ncode": "GPL-2.0",
    "/* SPDX-License-Identifier: Zlib */": "Zlib",
    AGPL: "AGPL-3.0",
    LONG: "MPL-2.0",
    "This is not licensed under the MIT License.": None,
    "It is no longer licensed under the MIT License.": None,
    "You may not use this file except in compliance with the Apache License, Version 2.0.": "Apache-2.0",
    "A driving licence is needed to hire a car.": None,
    "a word\n" * 200 + "Licensed under the MIT License.": "MIT",
}


def test_answers(spark):
    rows = [(f"d{k}/x", text) for k, text in enumerate(ANSWERS)]
    found = licenses.scan_licenses(spark.createDataFrame(rows, "path string, text string"))
    assert {r["text"]: r["license"] for r in found.collect()} == ANSWERS


def test_two_clause_text_is_not_taken_for_three_clauses(spark):
    folder = licenses.Path(licenses.__file__).parent / "license_texts"
    rows = [(n, (folder / f"{n}.txt").read_text()) for n in ("BSD-2-Clause", "BSD-3-Clause")]
    found = licenses.scan_licenses(spark.createDataFrame(rows, "path string, text string"))
    assert {r["path"]: (r["license"], r["license_cosine"]) for r in found.collect()} == {n: (n, 1.0) for n, _ in rows}


def test_the_nearest_directory_decides(spark):
    rows = [
        ("r/LICENSE", "Released under the MIT License."), ("r/a.py", "x"), ("r/s/b.py", "x"), ("r/s/t/c.py", "x"),
        ("r/s/t/long.md", "word " * 500 + "\nLicensed under CC BY 4.0."), ("r/s/t/u/d.py", "x"), ("rest/e.py", "x"), ("f.py", "x"),
        # A licence file goes before a better notice in another file.
        ("q/COPYING", "Released under the MIT License, all."), ("q/z.py", "Licensed under CC BY-NC 4.0."), ("q/y.py", ""),
    ]
    found = licenses.scan_licenses(spark.createDataFrame(rows, "path string, text string"))
    answers = {r["path"]: (r["license"], r["license_from"]) for r in found.collect()}
    assert answers == {
        "r/LICENSE": ("MIT", "notice"), "r/a.py": ("MIT", "directory"), "r/s/b.py": ("MIT", "directory"),
        "r/s/t/long.md": ("CC-BY-4.0", "notice"), "r/s/t/c.py": ("CC-BY-4.0", "directory"),
        "r/s/t/u/d.py": ("CC-BY-4.0", "directory"), "rest/e.py": (None, None), "f.py": (None, None),
        "q/COPYING": ("MIT", "notice"), "q/z.py": ("CC-BY-NC-4.0", "notice"), "q/y.py": ("MIT", "directory"),
    }


def test_columns_of_the_caller_stay(spark):
    taken = ["key", "dir", "_dir", "cosine", "is_whole", "_license_scan_0", "_license_scan_2", "above"]
    schema = "path string, text string, " + ", ".join(f"{c} int" for c in taken)
    rows = [("a/LICENSE", "Released under the MIT License.", *range(8)), ("a/b.py", None, *range(8)), ("a/b.py", None, *range(8))]
    found = licenses.scan_licenses(spark.createDataFrame(rows, schema))
    assert set(found.columns) == {"path", "text", *taken, "license", "license_cosine", "license_from"}
    for r in found.collect():
        assert [r[c] for c in taken] == list(range(8)) and r["license"] == "MIT"


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query_with_nested_directories(spark, folder):
    path = f"/root/testdata/{folder}"
    found = op7_license_scan(spark, path)
    assert differences(found, duckdb_on(path), oracle.OP7) == []
    above = found.filter("license_from = 'directory'")
    assert above.count() > 0
