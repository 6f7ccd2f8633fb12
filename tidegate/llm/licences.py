"""Licence scans: normalised lines against licence templates by the Dice coefficient.

A text is compared in segments: each line, each paragraph of several lines, and the
whole text if it has several paragraphs. A segment's words are its runs of ASCII
letters and digits and of characters beyond ASCII, lower-cased; its features are
its distinct pairs of neighbouring words. With a pairs and b pairs, a Dice
coefficient of t needs a * t / (2 - t) <= b <= a * (2 - t) / t, which leaves few
templates for a segment, and none for most. What is left is joined on pairs.

The templates are constants of this module, a few hundred pairs, whatever the data.

Defined results: null and empty texts, and segments of one word, match nothing; a
segment may match several licences, each is listed once per document, in order; rows
that repeat get a row each; other columns are left alone.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

THRESHOLD = 0.8
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The notices of common licences, by SPDX identifier.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
]


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), BETWEEN_WORDS, -1), "")


def pairs(words: Column) -> Column:
    """Distinct pairs of neighbouring words, as 64-bit hashes."""
    count = F.greatest(F.size(words) - 1, F.lit(0))
    return F.array_distinct(F.zip_with(F.slice(words, 1, count), F.slice(words, 2, count), lambda a, b: F.xxhash64(a, b)))


def computed_once(value: Column) -> Column:
    """`value` as a generated column: later uses read it, the optimiser does not repeat its expression."""
    return F.explode(F.array(value))


def template_pairs(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """A row for each pair of each template, with the template's number of pairs."""
    rows = [(i, licence, text) for i, (licence, text) in enumerate(templates)]
    found = spark.createDataFrame(rows, "template int, licence string, text string").withColumn("pairs", pairs(words(F.col("text"))))
    return found.select("template", "licence", F.size("pairs").alias("b"), F.explode("pairs").alias("pair"))


def segments(text: Column) -> Column:
    lines = F.split(text, "\n", -1)
    paragraphs = F.filter(F.split(text, r"\n\s*\n", -1), lambda p: F.instr(p, "\n") > 0)
    whole = F.when(text.rlike(r"\n\s*\n"), F.array(text)).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(lines, paragraphs, whole))


def find_licences(documents: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, licences (sorted), best_dice."""
    known = template_pairs(documents.sparkSession, templates)
    sizes = [row["b"] for row in known.select("template", "b").distinct().collect()]  # one for each template
    low, high = min(sizes) * threshold / (2 - threshold), max(sizes) * (2 - threshold) / threshold
    row = [F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("digest")]
    found = (
        documents.select(*row, F.explode(segments(F.coalesce(F.col("text"), F.lit("")))).alias("segment"))
        .select("doc_id", "digest", F.xxhash64("segment").alias("at"), computed_once(words(F.col("segment"))).alias("words"))
        .filter(F.size("words") > low)
        .select("doc_id", "digest", "at", computed_once(pairs(F.col("words"))).alias("pairs"))
        .filter(F.size("pairs").between(low, high))
        .select("doc_id", "digest", "at", F.size("pairs").alias("a"), F.explode("pairs").alias("pair"))
        .join(F.broadcast(known), "pair")
        .filter((F.col("b") >= F.col("a") * threshold / (2 - threshold)) & (F.col("b") <= F.col("a") * (2 - threshold) / threshold))
        .groupBy("doc_id", "digest", "at", "a", "template", "licence", "b")
        .agg(F.count_distinct("pair").alias("shared"))
        .withColumn("dice", F.col("shared") * 2.0 / (F.col("a") + F.col("b")))
        .filter(F.col("dice") >= threshold)
        .groupBy("doc_id", "digest")
        .agg(F.array_sort(F.collect_set("licence")).alias("licences"), F.max("dice").alias("best_dice"))
    )
    rows = documents.select(*row)
    same = rows["doc_id"].eqNullSafe(found["doc_id"]) & (rows["digest"] == found["digest"])
    return rows.join(found, same, "left").select(
        rows["doc_id"],
        F.coalesce(found["licences"], F.array().cast("array<string>")).alias("licences"),
        F.coalesce(found["best_dice"], F.lit(0.0)).alias("best_dice"),
    )
