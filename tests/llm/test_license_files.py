"""Whole licence texts and headers that are wrapped over commented lines."""

from __future__ import annotations

from pathlib import Path

from parcelstats.llm import licenses

TEXTS = Path(licenses.__file__).parent / "license_texts"
GPL = """/* tool.c
 *
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 */
int main() {}
"""
APACHE = "# Copyright 2020 Someone\n#\n# Licensed under the Apache\n# License, Version\n# 2.0 (the \"License\");\n" + "x = 1\n" * 80


def test_whole_texts_and_wrapped_headers(spark):
    rows = [(f"{p.stem}/LICENSE", "Copyright (c) 2020 Someone\n\n" + p.read_text()) for p in TEXTS.glob("*.txt")]
    rows += [(f"{p.stem}/src/a.py", "code") for p in TEXTS.glob("*.txt")]
    body = (TEXTS / "MIT.txt").read_text().split("\n", 2)[2]
    rows += [("t/terms.md", body), ("t/src/b.py", "code"), ("g/tool.c", GPL), ("a/x.py", APACHE),
             ("n/LICENSE.txt", "Released under the MIT License. " + "Words follow here. " * 50), ("n/c.py", "code")]
    files = spark.createDataFrame(rows, "path string, text string")
    found = {r["path"]: (r["license"], r["license_from"]) for r in licenses.scan_licenses(files).collect()}
    wanted = {f"{p.stem}/LICENSE": (p.stem, "notice") for p in TEXTS.glob("*.txt")}
    wanted |= {f"{p.stem}/src/a.py": (p.stem, "directory") for p in TEXTS.glob("*.txt")}
    wanted |= {"t/terms.md": ("MIT", "notice"), "t/src/b.py": ("MIT", "directory"), "g/tool.c": ("GPL-3.0", "notice"),
               "a/x.py": ("Apache-2.0", "notice"), "n/LICENSE.txt": ("MIT", "notice"), "n/c.py": ("MIT", "directory")}
    assert found == wanted
