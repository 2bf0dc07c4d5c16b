"""Licences of files, by the words of their headers and by the directories they lie in.

A header is a sentence with a marker word of licensing, within a line or within a
paragraph whose lines are joined, as notices are wrapped; comment marks at line
starts do not count.  A licence file is compared as a whole too, and a licence found
so goes before that of a single sentence.  Headers are compared with notices and
texts of known licences by the cosine of their TF-IDF vectors, which are sparse:
rows of (digest of the header, term, weight), joined by term.  Equal headers are compared once.  A
file without a notice of its own takes the licence of the nearest ancestor directory
that has one, the root included: that of the directory's licence files, else the
one most of its files state.

All steps are DataFrame expressions.  Defined results: a null or empty text has
no header; a file with a null path inherits nothing; repeated rows count once;
equally good templates and equally frequent licences go by name; empty tables
give empty results; other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import stored

THRESHOLD = 0.6
MARKER = "(?i)licen[cs]|copyright|redistribut|permission|warrant|creative commons|public domain"
LICENSE_FILE = "(?i)^(licen[cs]e|copying|notice)([.-].*)?$"
TERM = r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*"

# In markup: elements within a line; all others end a paragraph, but for line breaks.
INLINE = r"(?i)</?(?:a|abbr|b|bdi|bdo|cite|code|em|font|i|kbd|mark|q|s|samp|small|span|strong|sub|sup|tt|u|var)(?:\s[^>]*)?>"
COMMENT_MARK = r"(?m)^[ \t]*(?:#+|//+|/?\*+/?|--+|;+|%+)[ \t]*"

# Sentences by which the licences are stated, and whole texts of short ones.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("MIT", "MIT License. Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Licensed under the ISC License."),
    ("ISC", "ISC License. Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "You may not use this file except in compliance with the License."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under the Creative Commons CC0 1.0 Universal Public Domain Dedication."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def url_path(url: str) -> Column:
    """Host and path of an address, without query and fragment; a host alone is a directory, an empty address null."""
    path = F.regexp_replace(F.regexp_replace(F.col(url), "^[A-Za-z][A-Za-z0-9+.-]*://", ""), "[?#].*$", "")
    return F.when(path.contains("/"), path).when(path != "", F.concat(path, F.lit("/")))


def visible_lines(html: str) -> Column:
    """Markup without tags: a space for one within a line, else the end of a line or paragraph."""
    flat = F.regexp_replace(F.regexp_replace(F.col(html), INLINE, " "), r"(?i)<br\s*/?>", "\n")
    return F.regexp_replace(flat, "<[^>]*>", "\n\n")


def directory(path: str) -> Column:
    """Everything before the last slash; empty for a path without one."""
    return F.regexp_replace(F.col(path), "/?[^/]*$", "")


def _terms(column: Column) -> Column:
    return F.regexp_extract_all(F.lower(column), F.lit(TERM), F.lit(0))


def is_license_file(path: str) -> Column:
    return F.coalesce(F.regexp_extract(path, "[^/]*$", 0).rlike(LICENSE_FILE), F.lit(False))


def _joined(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def _sentences(text: Column) -> Column:
    return F.split(F.regexp_replace(text, r"([.!?])\s+", "$1\n"), "\n")


def _marked(texts: Column) -> Column:
    return F.filter(texts, lambda t: t.rlike(MARKER))


def headers(files: DataFrame) -> DataFrame:
    """Sentences with a marker word, one row per file and header, which ``key`` is the digest of; ``whole`` marks a licence file's text."""
    bare = F.regexp_replace("text", COMMENT_MARK, "")
    paragraphs = _marked(F.split(bare, r"\n\s*\n"))
    wrapped = F.flatten(F.transform(paragraphs, lambda p: _marked(_sentences(_joined(p)))))
    within = F.concat(F.transform(_marked(_sentences(bare)), _joined), wrapped)
    single = F.transform(F.array_distinct(within), lambda h: F.struct(h.alias("header"), F.lit(False).alias("whole")))
    entire = F.array(F.struct(_joined(bare).alias("header"), F.lit(True).alias("whole")))
    found = F.when(is_license_file("path"), F.concat(single, entire)).otherwise(single)
    return (
        files.where(F.col("text").rlike(MARKER))
        .select("file_id", "path", F.explode(found).alias("h"))
        .select("file_id", "path", F.unhex(F.sha2("h.header", 256)).alias("key"), "h.whole", "h.header")
        .dropDuplicates(["file_id", "path", "key", "whole"])
    )


def _vectors(texts: DataFrame, key: list[str], text: str, idf: DataFrame) -> DataFrame:
    """Unit-length sparse TF-IDF vectors, one row per term."""
    counted = texts.select(*key, F.explode(_terms(F.col(text))).alias("term")).groupBy(*key, "term").agg(
        F.count(F.lit(1)).alias("tf")
    )
    weighted = counted.join(idf, "term").withColumn("w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(*key)))
    return weighted.select(*key, "term", (F.col("w") / norm).alias("w"))


def header_licenses(found: DataFrame, spark: SparkSession, threshold: float = THRESHOLD) -> DataFrame:
    """The best licence of each distinct header, by ``key``, whose cosine reaches ``threshold``."""
    distinct = found.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.any_value("header").alias("header"))
    rows = [(i, name, text) for i, (name, text) in enumerate(TEMPLATES)]
    templates = spark.createDataFrame(rows, "template int, license string, notice string")
    total = distinct.agg(F.sum("n").alias("total"))
    seen = distinct.select("n", F.explode(F.array_distinct(_terms(F.col("header")))).alias("term"))
    unseen = templates.select(F.lit(0).cast("bigint").alias("n"), F.explode(_terms(F.col("notice"))).alias("term"))
    # One row, so the cross join adds a number to every term.
    idf = (
        seen.unionByName(unseen)
        .groupBy("term")
        .agg(F.sum("n").alias("df"))
        .join(F.broadcast(total))
        .select("term", (F.log((1 + F.coalesce("total", F.lit(0))) / (1 + F.col("df"))) + 1).alias("idf"))
    )
    notices = _vectors(templates, ["template", "license"], "notice", idf)
    units = _vectors(distinct, ["key"], "header", idf)
    # As many rows as the fixed templates have terms.
    cosine = (
        units.join(F.broadcast(notices.withColumnRenamed("w", "v")), "term")
        .groupBy("key", "template", "license")
        .agg(F.round(F.sum(F.col("w") * F.col("v")), 9).alias("cosine"))
        .where(F.col("cosine") >= threshold)
    )
    # Of equal cosines the first name.
    best = F.array_sort(F.collect_list(F.struct((-F.col("cosine")).alias("c"), "license")))[0]
    return cosine.groupBy("key").agg(best.alias("b")).select("key", F.col("b.license"), (-F.col("b.c")).alias("cosine"))


def scan_licenses(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Licence of every file: ``license``, ``origin`` (own, inherited, none), ``source_dir`` and ``cosine``.

    ``files`` has ``file_id``, ``path`` and ``text``.
    """
    spark = files.sparkSession
    # Few rows, read four times: written once to the shared folder.
    found = stored(headers(files), "license-headers")
    scored = found.join(header_licenses(found, spark, threshold), "key")
    order = F.struct((~F.col("whole")).alias("part"), (-F.col("cosine")).alias("c"), "license")
    own = (
        scored.groupBy("file_id", "path")
        .agg(F.min(order).alias("b"))
        .select("file_id", "path", F.col("b.license").alias("own"), (-F.col("b.c")).alias("cosine"))
    )
    is_file = is_license_file("path")
    stated = own.where(F.col("path").isNotNull()).groupBy(directory("path").alias("dir"), "own").agg(
        F.max(is_file).alias("file"), F.count(F.lit(1)).alias("n")
    )
    rank = F.struct((~F.col("file")).alias("other"), (-F.col("n")).alias("rare"), F.col("own").alias("license"))
    by_dir = stated.groupBy("dir").agg(F.min(rank).alias("b")).select(
        F.col("dir").alias("source_dir"), F.col("b.license").alias("inherited")
    )
    every = files.select("file_id", "path").distinct().withColumn("dir", directory("path"))
    parts = F.split("dir", "/")
    ancestors = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    nearest = (
        every.where(F.col("dir").isNotNull())
        .select("dir")
        .distinct()
        .select("dir", F.posexplode(ancestors).alias("depth", "source_dir"))
        .join(by_dir, "source_dir")
        .groupBy("dir")
        .agg(F.max_by(F.struct("source_dir", "inherited"), "depth").alias("b"))
        .select("dir", "b.source_dir", "b.inherited")
    )
    origin = (
        F.when(F.col("own").isNotNull(), "own").when(F.col("inherited").isNotNull(), "inherited").otherwise("none")
    )
    own = own.withColumnsRenamed({"file_id": "o_id", "path": "o_path"})
    same = F.col("file_id").eqNullSafe(F.col("o_id")) & F.col("path").eqNullSafe(F.col("o_path"))
    return (
        every.join(own, same, "left")
        .drop("o_id", "o_path")
        .join(nearest, "dir", "left")
        .select(
            "file_id",
            "path",
            F.coalesce("own", "inherited").alias("license"),
            origin.alias("origin"),
            F.when(F.col("own").isNull(), F.col("source_dir")).alias("source_dir"),
            "cosine",
        )
    )


def page_licenses(pages: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Licences of web pages; their addresses are the paths."""
    files = pages.select(
        F.col("page_id").alias("file_id"), url_path("url").alias("path"), visible_lines("html").alias("text")
    )
    return scan_licenses(files, threshold).withColumnRenamed("file_id", "page_id")
