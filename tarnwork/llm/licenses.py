"""Licence scans: a paragraph classifier on word n-grams, calibrated, with templates to confirm it; DataFrame functions and Spark ML only."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from functools import reduce
from itertools import product

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tarnwork.llm.common import col, table
from tarnwork.llm.registry import query
from tarnwork.session import settle

NONE, UNKNOWN = "none", "unknown"
FEATURES = 1 << 13

# How the families are named in notices, and sentences of their texts.
NAMES = {
    "MIT": ["the MIT License", "the MIT license (MIT)", "the Expat License", "MIT"],
    "Apache-2.0": ["the Apache License, Version 2.0", "the Apache License 2.0", "Apache 2.0", "the Apache Software License, Version 2.0"],
    "GPL-2.0": ["the GNU General Public License, version 2", "the GNU GPL v2", "GPL-2.0", "the GNU General Public License version 2 or later", "the GNU GPLv2", "GPL-2.0-or-later"],
    "GPL-3.0": ["the GNU General Public License, version 3", "the GNU GPL v3", "GPL-3.0", "the GNU General Public License version 3 or later", "the GNU GPLv3", "GPL-3.0-or-later"],
    "LGPL": ["the GNU Lesser General Public License, version 2.1", "the GNU Lesser General Public License, version 3", "the GNU LGPL v3", "LGPL-2.1", "the GNU LGPLv3", "the GNU LGPLv2.1", "LGPL-3.0"],
    "AGPL-3.0": ["the GNU Affero General Public License, version 3", "the GNU AGPL v3", "AGPL-3.0", "the GNU AGPLv3"],
    "BSD": ["the BSD License", "the 3-Clause BSD License", "the 2-Clause BSD License", "the New BSD License", "BSD-3-Clause"],
    "MPL-2.0": ["the Mozilla Public License, version 2.0", "MPL 2.0", "the Mozilla Public License, v. 2.0"],
    "CC-BY-4.0": ["CC BY 4.0", "a Creative Commons Attribution 4.0 International License", "the Creative Commons Attribution License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC0": ["CC0 1.0", "CC0 1.0 Universal", "the Creative Commons Zero dedication"],
    "ISC": ["the ISC License", "the ISC license (ISC)"],
    "Unlicense": ["the Unlicense"],
    "Zlib": ["the zlib License", "the zlib/libpng License"],
    "BSL-1.0": ["the Boost Software License, Version 1.0", "BSL-1.0"],
    "EPL-2.0": ["the Eclipse Public License 2.0", "the Eclipse Public License, v. 2.0", "EPL-2.0"],
    "proprietary": [],
}
SENTENCES = {
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "See the License for the specific language governing permissions and limitations under the License.",
    ],
    "GPL-2.0": ["it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "GPL-3.0": ["it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "LGPL": [
        "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU Lesser General Public License along with this library",
    ],
    "AGPL-3.0": [
        "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "CC-BY-4.0": [],
    "CC-BY-SA-4.0": [],
    "CC-BY-NC-4.0": [],
    "CC0": ["has waived all copyright and related or neighboring rights to this work, to the extent possible under law"],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
        "The origin of this software must not be misrepresented; you must not claim that you wrote the original software.",
        "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.",
    ],
    "BSL-1.0": ["Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software"],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"],
    "proprietary": ["All rights reserved.", "Confidential and proprietary. Do not distribute without written permission.", "Unauthorized copying of this file is strictly prohibited.", "No part of this publication may be reproduced without prior written permission."],
}
LEADS = ["SPDX-License-Identifier: {}", "Licensed under {}.", "This work is licensed under {}.", "Released under {}.", "Distributed under the terms of {}.", "This file is available under {}, see LICENSE.", "Code in this article is published under {}.", "License: {}"]
TITLES = ["the {} Public License, version {}", "the {} License {}", "{} License v{}", "the terms of the {} agreement {}", "the {} Community License {}"]
INVENTED = ["Acorn", "Harbor", "Lantern", "Quill", "Summit", "Meadow", "Copper", "Falcon"]
PROSE = [
    "The house stands by the water and the road goes on to the next town.", "version 3 of the report came out in spring", "He said that all rights and wrongs are a matter of taste.", "This work is about rivers and the people who live there.",
    "The general opinion of the public was against it.", "Under the bridge, a boat was lying in the sun.", "The license plate of the car was covered in mud.", "She had a licence to fish in the lake, version or no version.",
    "See the article for more about the method and the data.", "Files are kept in a box under the table.", "The software is fast and its documentation is short.", "Permission to land was given at noon.",
]
#: Words that carry a version in themselves.
VERSIONED = frozenset({"gplv2", "gplv3", "lgplv3", "lgplv2", "agplv3", "v2", "v3", "cc0"})
#: Corpus lines with one of these are not taken as examples of prose.
CUE = r"(?i)licen[cs]|copyright|rights reserved|warrant|permission|redistribut|creative commons|\bgpl\b|\bcc\b"

#: Every template of more than one word has one of these in lower case, so a notice that goes over several lines has a line with one.
CUES = (
    "licen", "copyright", "rights", "reserved", "warrant", "permission", "redistribut", "commons", "gpl", "apache", "mozilla", "eclipse", "boost", "zlib", "confidential", "proprietary",
    "unauthorized", "publication", "software", "public domain",
)
SHORT_CUES = ("gnu", "mpl", "epl", "bsl", "bsd", "isc", "cc")


def has_cue(text: Column) -> Column:
    """Whether a text has a cue, short ones as words of their own; plain searches come first, as a pattern is slow on long texts."""

    def found(t: Column) -> Column:
        plain = reduce(Column.__or__, [F.contains(t, F.lit(c)) for c in CUES])
        short = reduce(Column.__or__, [F.contains(t, F.lit(c)) for c in SHORT_CUES])
        return plain | (short & t.rlike(r"\b(cc0|" + "|".join(SHORT_CUES) + r")\b"))

    return F.exists(F.array(F.lower(text)), found)  # lower case once


def examples() -> list[tuple[str, str]]:
    """Text and family: names in notices, sentences of the texts, notices of licences nobody knows, and prose."""
    rows = []
    for family, names in NAMES.items():
        rows += [(lead.format(n), family) for lead, n in product(LEADS, names)] + [(s, family) for s in SENTENCES[family]]
        rows += [(f"{a} {b}", family) for a, b in product(SENTENCES[family], ["Copyright (c) 2020 the authors.", "Copyright 2019 by the contributors."])]
    rows += [(lead.format(title.format(name, number)), UNKNOWN) for lead, title, (number, name) in product(LEADS, TITLES, enumerate(INVENTED, 1))]
    return rows + [(p, NONE) for p in PROSE]


def templates() -> list[tuple[str, str]]:
    return [(family, t) for family in NAMES for t in [*NAMES[family], *SENTENCES[family]]]


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), 0)


def grams(words: str) -> Column:
    """Words and pairs of neighbours."""
    w = F.col(words)
    pairs = F.when(F.size(w) > 1, F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1), lambda a, b: F.concat(a, F.lit(" "), b))).otherwise(F.array().cast("array<string>"))
    return F.concat(w, pairs)


def featured(df: DataFrame) -> DataFrame:
    """Rows with a ``text`` get ``words`` and ``features``."""
    hashing = HashingTF(numFeatures=FEATURES, binary=True, inputCol="grams", outputCol="features")
    # A list of one, exploded: a later filter on a prediction would else cut the text into words anew for each use of ``words``.
    cut = df.select("*", F.explode(F.array(tokens(F.col("text")))).alias("words"))
    return hashing.transform(cut.withColumn("grams", grams("words"))).drop("grams")


def paragraphs(df: DataFrame, id_col: str, text_col: str, longest: int = 800) -> DataFrame:
    """``doc_id, digest, paragraph, start, text``: the lines of each text; lines over ``longest`` characters in pieces of that length which overlap by half.

    ``paragraph`` counts lines from 0, ``start`` is the code point of the line where the piece begins, ``digest`` that of the whole text.
    """
    lines = F.split(F.coalesce(col(text_col), F.lit("")), "\n")
    rows = df.select(col(id_col).alias("doc_id"), F.xxhash64(col(text_col)).alias("digest"), F.posexplode(lines).alias("paragraph", "line")).where(F.col("line") != "")
    step = longest // 2
    offsets = F.when(F.length("line") <= longest, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.length("line") - step, F.lit(step)))
    pieces = rows.select("doc_id", "digest", "paragraph", "line", F.explode(offsets).alias("start"))
    return pieces.select("doc_id", "digest", "paragraph", "start", F.substring("line", F.col("start") + 1, F.lit(longest)).alias("text"))


def wrapped(df: DataFrame, id_col: str, text_col: str, alike: float) -> DataFrame:
    """``doc_id, digest, paragraph, last, text``: runs of two or more lines that hold a template, each as short as it can be.

    A stretch of lines without a blank one, some line of which has a licence word, is read once as one sequence of words. Where it
    holds ``alike`` of a template's word pairs, the lines of those pairs make the run: a run goes on as long as
    no more than one line in between is without such a pair, over any number of lines. A line of nothing but marks is blank.
    """
    rows = df.select(col(id_col).alias("doc_id"), F.xxhash64(col(text_col)).alias("digest"), col(text_col).alias("text"), F.monotonically_increasing_id().alias("row_no"))
    rows = rows.where(F.col("text").contains("\n") & has_cue(F.col("text")))
    unmarked = lambda x: F.regexp_replace(x, r"(?i)^\W*(rem|dnl)\b", "")
    lines = rows.select("doc_id", "digest", "row_no", F.posexplode(F.split("text", "\n")).alias("line", "text")).where(F.col("text").rlike(r"[\p{L}\p{N}]"))
    lines = lines.withColumn("cue", has_cue(F.col("text")))
    # Lines in a row share their number less their place among the lines that are not blank.
    placed = lines.withColumn("stretch", F.col("line") - F.row_number().over(Window.partitionBy("row_no").orderBy("line")))
    whole = Window.partitionBy("row_no", "stretch")
    # Of the other lines only those beside a stretch's cues matter, but which they are the templates tell.
    near = placed.withColumn("cues", F.max("cue").over(whole)).withColumn("lines", F.count(F.lit(1)).over(whole)).where("cues AND lines > 1")
    near = settle(near.select("doc_id", "digest", "row_no", "stretch", "line", "text", tokens(unmarked(F.col("text"))).alias("words")), "licence-lines")
    # Each word with the one before it, also over the line's end.
    order = Window.partitionBy("row_no", "stretch").orderBy("line")
    before = F.lag(F.element_at("words", -1)).over(order)
    joined = near.where(F.size("words") > 0).withColumn("all", F.when(before.isNull(), F.col("words")).otherwise(F.concat(F.array(before), F.col("words"))))
    pairs = F.zip_with(F.slice("all", 1, F.size("all") - 1), F.slice("all", 2, F.size("all")), lambda a, b: F.concat(a, F.lit(" "), b))
    joined = joined.withColumn("over", before.isNotNull()).where(F.size("all") > 1)
    at = joined.select("row_no", "stretch", "line", "over", F.posexplode(pairs).alias("i", "pair"))
    at = at.withColumn("from", F.when(F.col("over") & (F.col("i") == 0), F.col("line") - 1).otherwise(F.col("line")))
    known = [(k, f"{a} {b}") for k, (_, t) in enumerate(templates()) if len(w := words_of(t)) > 1 for a, b in {*zip(w, w[1:], strict=False)}]
    spark = df.sparkSession
    sizes = spark.createDataFrame([(k, n) for k, n in Counter(k for k, _ in known).items()], "template int, size long")
    hits = at.join(F.broadcast(spark.createDataFrame(known, "template int, pair string")), "pair")  # the templates' pairs, fixed values
    hits = hits.groupBy("row_no", "stretch", "template", "pair", "from", "line").agg(F.lit(1).alias("one")).drop("one")
    share = F.count_distinct("pair") / F.first("size")
    full = hits.join(F.broadcast(sizes), "template").groupBy("row_no", "stretch", "template").agg(share.alias("share")).where(F.col("share") >= alike).drop("share")
    hits = hits.join(full, ["row_no", "stretch", "template"], "left_semi")
    one = Window.partitionBy("row_no", "stretch", "template").orderBy("from", "line")
    gap = F.col("from") - F.max("line").over(one.rowsBetween(Window.unboundedPreceding, -1)) > 2
    hits = hits.withColumn("part", F.sum(F.when(gap, 1).otherwise(0)).over(one.rowsBetween(Window.unboundedPreceding, 0)))
    runs = hits.join(F.broadcast(sizes), "template").groupBy("row_no", "stretch", "template", "part").agg(F.min("from").alias("paragraph"), F.max("line").alias("last"), share.alias("share"))
    runs = runs.where((F.col("share") >= alike) & (F.col("last") > F.col("paragraph"))).select("row_no", "stretch", "paragraph", "last").distinct()
    told = near.join(runs, ["row_no", "stretch"]).where(F.col("line").between(F.col("paragraph"), F.col("last")))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda x: unmarked(x["text"])), " ")
    return told.groupBy("doc_id", "digest", "row_no", "paragraph", "last").agg(text.alias("text")).drop("row_no")


def best_places(found: DataFrame) -> DataFrame:
    """``found`` without runs and lines that overlap a better place of their family or its kin, and without unconfirmed lines inside a run that stays.

    The higher ``template_share`` is better, then fewer lines, then the higher probability. Runs stay only if they are confirmed.
    """
    text = ["doc_id", "digest"]
    kin = F.when(F.col("predicted").contains("GPL"), "GPL").when(F.col("predicted").startswith("CC"), "CC").otherwise(F.col("predicted"))
    found = found.withColumn("kin", kin).where(F.col("confirmed") | (F.col("paragraph") == F.col("last")))
    rank = F.struct(F.col("template_share"), F.col("paragraph") - F.col("last"), F.col("probability"), -F.col("paragraph"))
    sure = found.where("confirmed").withColumn("rank", rank)
    covered = sure.select(*text, "kin", "paragraph", "last", "rank", F.explode(F.sequence("paragraph", "last")).alias("line"))
    top = covered.groupBy(*text, "kin", "line").agg(F.max_by(F.struct("paragraph", "last"), "rank").alias("top"))
    # Places whose every line has them as its best.
    whole = top.groupBy(*text, "kin", "top").agg(F.count(F.lit(1)).alias("lines")).where("lines = top.last - top.paragraph + 1").select(*text, "kin", "top.paragraph", "top.last")

    def same(left: DataFrame, right: DataFrame, names: list[str]):
        return [left[n].eqNullSafe(right[n]) for n in names]

    whole = settle(whole, "places")
    kept = sure.join(whole, same(sure, whole, [*text, "kin", "paragraph", "last"]), "left_semi").drop("rank")
    inside = whole.where("last > paragraph").select(*text, F.explode(F.sequence("paragraph", "last")).alias("paragraph"))
    rest = found.where("NOT confirmed")
    return kept.unionByName(rest.join(inside, same(rest, inside, [*text, "paragraph"]), "left_anti"))


def temperature(rows: list[tuple[list[float], int]]) -> float:
    """The divisor of the raw scores under which held-out examples are most likely."""

    def cost(t: float) -> float:
        total = 0.0
        for raw, label in rows:
            top = max(raw)
            total += math.log(sum(math.exp((x - top) / t) for x in raw)) - (raw[label] - top) / t
        return total

    return min((0.25 * 1.15**k for k in range(32)), key=cost) if rows else 1.0


def train(df: DataFrame, id_col: str, text_col: str, prose_lines: int = 2_000) -> tuple[LogisticRegressionModel, list[str], float]:
    """Model, families by label and temperature, from the examples and at most ``prose_lines`` lines of the corpus (by smallest hash) that have no licence word.

    A third of all examples is kept from fitting to find the temperature, then the model is fitted on all.
    """
    spark = df.sparkSession
    labels = [NONE, UNKNOWN, *NAMES]
    made = examples()
    sizes = Counter(f for _, f in made)
    # Every family weighs the same, and all prose as much as a few families.
    known = spark.createDataFrame([(t, float(labels.index(f)), 100.0 / sizes[f], zlib.crc32(t.encode()) % 3 == 0) for t, f in made], "text string, label double, weight double, held boolean")
    lines = paragraphs(df, id_col, text_col).select("text").orderBy(F.xxhash64("text"), "text").limit(prose_lines)
    prose = lines.where(~F.col("text").rlike(CUE)).select("text", F.lit(0.0).alias("label"), F.lit(400.0 / prose_lines).alias("weight"), (F.pmod(F.crc32(F.col("text").cast("binary")), F.lit(3)) == 0).alias("held"))
    rows = settle(featured(known.unionByName(prose)).select("features", "label", "weight", "held").coalesce(2), "licence-examples")
    fitting = LogisticRegression(family="multinomial", regParam=0.002, elasticNetParam=0.0, maxIter=50, standardization=False, weightCol="weight")
    trial = fitting.fit(rows.where("NOT held"))
    checked = trial.transform(rows.where("held")).select(vector_to_array("rawPrediction").alias("raw"), "label").collect()
    return fitting.fit(rows), labels, temperature([(r.raw, int(r.label)) for r in checked])


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5, alike: float = 0.6) -> DataFrame:
    """One row per paragraph that is a licence notice: ``doc_id, paragraph, start, family, probability, template_share, confirmed``.

    A paragraph is a line (long lines in overlapping pieces), or a run of lines without a blank one where that
    holds more of a template than its lines do; it is numbered by its first line. It is a notice where prose is not the most probable class.
    Its family is the most probable one; with a calibrated probability under ``least`` it is ``unknown``. A prediction is confirmed where a template of its family has at
    least ``alike`` of its word pairs in the paragraph (``template_share``; of single words for one-word
    templates), and all pairs with its version, if it names one; an unconfirmed one is reported as ``unknown`` too, with its probability.

    NULL and empty texts have no paragraphs; repeated rows are reported each; an empty table gives no
    rows; other columns are ignored.
    """
    spark = df.sparkSession
    model, labels, heat = train(df, id_col, text_col)
    lines = paragraphs(df, id_col, text_col).withColumn("last", F.col("paragraph"))
    runs = settle(wrapped(df, id_col, text_col, alike).withColumn("start", F.lit(0)), "licence-runs")
    scored = model.setProbabilityCol("").transform(featured(lines.unionByName(runs)))
    notices = scored.where(F.col("prediction") != labels.index(NONE)).select("doc_id", "digest", "paragraph", "last", "start", "words", vector_to_array("rawPrediction").alias("raw"))
    # Few paragraphs come this far. Written, so that what follows is not folded into the scan and done again per use.
    sure = settle(notices, "notices")
    shifted = F.transform("raw", lambda x: F.exp((x - F.array_max("raw")) / heat))
    total = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    sure = sure.withColumn("e", shifted).withColumn("p", F.transform("e", lambda x: x / total))
    best = F.array_max(F.slice("p", 3, len(labels)))
    family = F.when(best >= least, F.element_at(F.array(*map(F.lit, labels)), F.array_position("p", best).cast("int"))).otherwise(UNKNOWN)
    found = sure.select("doc_id", "digest", "paragraph", "last", "start", "words", family.alias("predicted"), best.alias("probability"))
    numbered = lambda gs: [g for g in gs if any(w[0].isdigit() or w in VERSIONED for w in g.split())]
    texts = lambda xs: F.array(*map(F.lit, xs)).cast("array<string>")
    fixed = F.array(
        *[F.struct(F.lit(f).alias("family"), texts(g).alias("grams"), texts(numbered(g)).alias("numbered")) for f, t in templates() for g in [pairs_of(words_of(t))]]
    )
    own = F.array_distinct(grams("words"))
    found = found.withColumn("own", own)
    mine = F.filter(fixed, lambda t: t["family"] == F.col("predicted"))
    # A template that names a version is met only with its version; a template's other pairs do not make up for it.
    met = lambda t: F.size(F.array_except(t["numbered"], F.col("own"))) == 0
    shares = F.transform(mine, lambda t: F.struct(F.when(met(t), F.size(F.array_intersect(t["grams"], F.col("own"))) / F.size(t["grams"])).otherwise(0.0).alias("share")))
    found = found.withColumn("template_share", F.coalesce(F.array_max(shares)["share"], F.lit(0.0)))
    found = found.withColumn("confirmed", F.col("template_share") >= alike).drop("words", "own")
    found = best_places(settle(found, "found"))
    confirmed = F.col("confirmed")
    return found.select(
        F.col("doc_id").alias(id_col), "paragraph", "start", F.when(confirmed, F.col("predicted")).otherwise(UNKNOWN).alias("family"), "probability", "template_share", "confirmed"
    )


def words_of(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def pairs_of(words: list[str]) -> list[str]:
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)}) or words


@query("op4_license_scan")
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in all documents."""
    return scan_licenses(table(spark, sf_dir, "documents"))
