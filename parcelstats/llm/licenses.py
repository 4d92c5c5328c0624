"""Licences of files: TF-IDF cosine to templates, then inheritance from ancestor directories.

Sentences that speak of a licence are compared with a list of notices and headers, as lines,
over neighbouring lines and over paragraphs without comment signs; whole files are compared
with whole licence texts; a tag with a licence's short name speaks for itself. A file without
a notice of its own takes the licence of the nearest directory above it in which one is
declared. Only DataFrame functions are used.
"""

from __future__ import annotations

from math import log
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelstats.llm.tables import settle, unused_names

# Notices by SPDX name.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "You may not use this file except in compliance with the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "You can redistribute it under the terms of the GNU General Public License, version 3."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, v. 2.0."),
)
# Standard headers that run over several lines.
_GNU = "redistribute it and/or modify it under the terms of the GNU {} Public License as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version."
HEADERS = (
    ("AGPL-3.0", _GNU.format("Affero General", "3")),
    ("GPL-2.0", _GNU.format("General", "2")),
    ("GPL-3.0", _GNU.format("General", "3")),
    ("LGPL-2.1", _GNU.format("Lesser General", "2.1")),
    ("LGPL-3.0", _GNU.format("Lesser General", "3")),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
)
# Every text in license_texts has one of these, however it is wrapped.
_GAP = r"[\s#*/;%-]+"
WHOLE = "(?i)" + "|".join(
    x.replace(" ", _GAP)
    for x in (
        "permission is hereby granted, free of charge", "permission to use, copy, modify",
        "redistribution and use in source and binary forms", "apache license", "gnu (lesser )?general public license",
        "mozilla public license", "cc0 1\\.0 universal",
    )
)
# A tag with the short name of a licence, without the endings that allow later versions.
TAG = r"SPDX-License-Identifier:[ \t]*\(?([A-Za-z0-9.+-]*[A-Za-z0-9])"
ENDINGS = r"-only$|-or-later$|\+$"
# Sentences that deny a licence.
DENIES = r"(?i)\b(not|never|no longer|nor)[ \t]+([a-z]+[ \t]+)?licen[sc]ed\b"
# Names of licence files.
NAMED = r"(?i)(^|/)(un)?(licen[sc]es?|copying)([.-][^/]*)?$"
# Beginnings of commented lines.
LEADER = r"^[ \t]*(#+|\*+/?|/\*+|//+|;+|%+|--+|<!--)?[ \t]*|[ \t\r]*(\*/|-->)?[ \t\r]*$"
# End of the fixed values.

#: Neighbouring lines that are joined where their paragraph says more than the header.
WRAPPED = 6
#: Least cosine of a whole file to a whole licence text.
LEAST_WHOLE = 0.85
SPEAKS = r"(?i)licen[sc]|\bCC BY|SPDX|all rights reserved"
SPEAKS_OR_GRANTS = SPEAKS + "|permission is hereby granted"
SENTENCE_END = r"\n|(?<=[.!?])[ \t\r\x0b\f]+"
WORD = r"[a-z]+|[0-9]+(\.[0-9]+)*"
#: Least cosine of a notice to its template.
LEAST = 0.6


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def _counted(sentences: DataFrame, *keys: str) -> DataFrame:
    return sentences.select(*keys, F.explode(_terms(F.col("sentence"))).alias("term")).groupBy(*keys, "term").agg(
        F.count("*").alias("tf")
    )


def template_vectors(spark) -> tuple[DataFrame, DataFrame, float]:
    """(template, license, term, weight), (term, idf) and the idf of terms in no template."""
    rows = [(k, name, text) for k, (name, text) in enumerate(TEMPLATES)]
    # The terms' weights are those of the notices; headers are compared by the same.
    headers = [(len(rows) + k, name, text) for k, (name, text) in enumerate(HEADERS)]
    counted = _counted(spark.createDataFrame(rows, "template int, license string, sentence string"), "template", "license")
    n = len(TEMPLATES)
    idf = counted.groupBy("term").agg((F.log((1.0 + n) / (1.0 + F.count("*"))) + 1.0).alias("idf"))
    unknown = log(1.0 + n) + 1.0
    more = _counted(spark.createDataFrame(headers, "template int, license string, sentence string"), "template", "license")
    weighted = counted.union(more.select(counted.columns)).join(F.broadcast(idf), "term", "left").withColumn(
        "weight", F.col("tf") * F.coalesce("idf", F.lit(unknown))
    )
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy("template")))
    return weighted.select("template", "license", "term", (F.col("weight") / norm).alias("unit")), idf, unknown


def _bare_lines(text: Column) -> Column:
    """The lines of a text without comment signs."""
    return F.transform(F.split(text, "\n"), lambda s: F.regexp_replace(s, LEADER, ""))


def _sentences(text: Column, bare: Column) -> Column:
    """Sentences of a text that speak of a licence.

    They end at line ends, at the end of up to WRAPPED lines joined, of which one speaks
    of a licence, or at the end of a paragraph of any length. ``bare`` has the lines without
    comment signs as a column of its own, since every mention of an expression would
    compute it anew.
    """
    speaks = lambda s: s.rlike(SPEAKS_OR_GRANTS)
    split = lambda s: F.split(s, SENTENCE_END)
    marked = F.transform(bare, lambda s, i: F.when(speaks(s), i))
    near = F.transform(F.array_compact(marked), lambda i: F.sequence(F.greatest(i - WRAPPED + 1, F.lit(0)), i))
    windows = F.transform(
        F.array_distinct(F.flatten(near)),
        lambda i: F.flatten(F.array(*(split(F.array_join(F.slice(bare, i + 1, n), " ")) for n in range(2, WRAPPED + 1)))),
    )
    paragraphs = F.filter(F.split(F.array_join(bare, "\n"), "\n[ \t]*\n"), speaks)
    joined = F.transform(paragraphs, lambda s: split(F.translate(s, "\n", " ")))
    own = F.filter(split(text), lambda s: s.rlike(SPEAKS))
    longer = F.filter(F.flatten(F.concat(windows, joined)), speaks)
    return F.filter(F.array_union(own, longer), lambda s: ~s.rlike(DENIES))


def whole_texts(docs: DataFrame, least: float = LEAST_WHOLE) -> DataFrame:
    """The licence text that a whole row (key, text) is: (key, whole, likeness)."""
    folder = Path(__file__).parent / "license_texts"
    texts = [(p.stem, p.read_text(encoding="utf-8")) for p in sorted(folder.glob("*.txt"))]
    known = _counted(docs.sparkSession.createDataFrame(texts, "whole string, sentence string"), "whole")
    n = len(texts)
    idf = known.groupBy("term").agg((F.log((1.0 + n) / (1.0 + F.count("*"))) + 1.0).alias("idf"))
    weigh = lambda counted: counted.join(F.broadcast(idf), "term", "left").withColumn(
        "weight", F.col("tf") * F.coalesce("idf", F.lit(log(1.0 + n) + 1.0))
    )
    length = F.sqrt(F.sum(F.col("weight") * F.col("weight")))
    known = weigh(known)
    own = settle(weigh(_counted(docs.select("key", F.col("text").alias("sentence")), "key")))
    unit = known.join(F.broadcast(known.groupBy("whole").agg(length.alias("n"))), "whole").select(
        "whole", "term", (F.col("weight") / F.col("n")).alias("unit")
    )
    dots = own.join(F.broadcast(unit), "term").groupBy("key", "whole").agg(F.sum(F.col("weight") * F.col("unit")).alias("dot"))
    cosines = dots.join(own.groupBy("key").agg(length.alias("length")), "key").withColumn(
        "cosine", F.round(F.col("dot") / F.col("length"), 6)
    )
    best = F.min(F.struct((-F.col("cosine")).alias("c"), F.col("whole")))
    return (
        cosines.filter(F.col("cosine") >= least).groupBy("key").agg(best.alias("best"))
        .select("key", F.col("best.whole").alias("whole"), (-F.col("best.c")).alias("likeness"))
    )


def notices(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """The best notice of each row (key, text, bare): (key, license, cosine)."""
    vectors, idf, unknown = template_vectors(docs.sparkSession)
    sentences = docs.select("key", F.posexplode(_sentences(F.col("text"), F.col("bare"))).alias("place", "sentence"))
    own = _counted(sentences, "key", "place").join(F.broadcast(idf), "term", "left")
    own = settle(own.withColumn("weight", F.col("tf") * F.coalesce("idf", F.lit(unknown))))
    # The templates are a fixed list; terms in none of them count in the length only.
    lengths = own.groupBy("key", "place").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("length"))
    dots = (
        own.join(F.broadcast(vectors), "term")
        .groupBy("key", "place", "template", "license")
        .agg(F.sum(F.col("weight") * F.col("unit")).alias("dot"))
    )
    cosines = dots.join(lengths, ["key", "place"]).withColumn("cosine", F.round(F.col("dot") / F.col("length"), 6))
    best = F.min(F.struct((-F.col("cosine")).alias("c"), F.col("license")))
    return (
        cosines.filter(F.col("cosine") >= least).groupBy("key").agg(best.alias("best"))
        .select("key", F.col("best.license").alias("license"), (-F.col("best.c")).alias("cosine"))
    )


def scan_licenses(files: DataFrame, path: str = "path", text: str = "text", least: float = LEAST) -> DataFrame:
    """``files`` with license, license_cosine and license_from ("notice", "directory" or null).

    ``path`` names a file with "/" between directories. A tag with a licence's short name goes
    before a whole licence text, and that before notices; tags and texts have a cosine of their
    own (1 for a tag). A directory's licence is declared by its file with a licence file's name or
    a whole licence text, otherwise by the file with the best notice, the first by path among
    equals; it holds for files without a notice in it and below, down to the next directory
    that declares one. A null path is in no directory, a null or empty text has no notice.
    Repeated rows get the same answer; existing columns of the three names are replaced, all
    others are kept; an empty table stays empty.
    """
    rows = files.drop("license", "license_cosine", "license_from")
    key, folder, license, cosine = unused_names(rows.columns, 4, "_license_scan")
    keyed = rows.withColumns(
        {
            key: F.xxhash64(F.col(path), F.col(text)),
            folder: F.when(F.col(path).contains("/"), F.regexp_replace(F.col(path), "/[^/]*$", "")),
        }
    )
    speaking = settle(
        keyed.filter(F.col(text).rlike(SPEAKS) | F.col(text).rlike(WHOLE))
        .select(F.col(key).alias("key"), F.col(folder).alias("dir"), F.col(path).alias("path"), F.col(text).alias("text"))
        .dropDuplicates(["key"])
        .withColumn("bare", _bare_lines(F.col("text")))
    )
    tag = F.regexp_replace(F.regexp_extract("text", TAG, 1), ENDINGS, "")
    tags = speaking.filter(tag != "").select("key", tag.alias("tag"))
    whole = whole_texts(speaking.filter(F.col("text").rlike(WHOLE)).select("key", "text"))
    found = settle(
        notices(speaking, least).join(whole, "key", "full").join(tags, "key", "full").select(
            "key",
            F.coalesce("tag", "whole", "license").alias("license"),
            F.when(F.col("tag").isNotNull(), 1.0).otherwise(F.coalesce("likeness", "cosine")).alias("cosine"),
            F.col("whole").isNotNull().alias("is_whole"),
        )
    )
    rank = F.when(F.col("path").rlike(NAMED) | F.col("is_whole"), 0).otherwise(1).alias("rank")
    declared = (
        speaking.select("key", "dir", "path").filter("dir is not null").join(found, "key")
        .groupBy("dir")
        .agg(F.min(F.struct(rank, (-F.col("cosine")).alias("c"), F.col("path"), F.col("license"))).alias("best"))
        .select(F.col("dir").alias("above"), F.col("best.license").alias("license"), (-F.col("best.c")).alias("cosine"))
    )
    steps = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda k: F.array_join(F.slice(steps, 1, k), "/"))
    dirs = keyed.select(F.col(folder).alias("dir")).filter("dir is not null").distinct()
    inherited = (
        dirs.withColumn("above", F.explode(above))
        .join(declared, "above")
        .groupBy("dir")
        .agg(F.max(F.struct(F.length("above").alias("depth"), F.col("license"), F.col("cosine"))).alias("near"))
        .select(F.col("dir").alias(folder), F.col("near.license").alias(license), F.col("near.cosine").alias(cosine))
    )
    own = found.select(F.col("key").alias(key), F.col("license"), F.col("cosine").alias("license_cosine"))
    return (
        keyed.join(own, key, "left")
        .join(inherited, folder, "left")
        .withColumns(
            {
                "license_from": F.when(F.col("license").isNotNull(), "notice").when(
                    F.col(license).isNotNull(), "directory"
                ),
                "license_cosine": F.coalesce("license_cosine", cosine),
                "license": F.coalesce("license", license),
            }
        )
        .drop(key, folder, license, cosine)
    )
