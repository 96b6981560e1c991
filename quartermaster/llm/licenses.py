"""Licence scans: a trained paragraph classifier with template confirmation.

A paragraph is a window of ``2 * BLOCK`` words, one from every ``BLOCK``-th
word on: line ends, comment marks and blank lines are no words, so a notice
may be wrapped at any width, and any notice of up to ``BLOCK`` words lies whole
in some paragraph. Every paragraph of every text is scored by sparse
multinomial logistic regression over its hashed words and word pairs. It is
trained here on the templates below (whole, with words left out, and set among
other words) and, for ``unknown``, on paragraphs of the corpus, on sentences
that use the same words otherwise, and on templates with their words shuffled.
A paragraph may name several families: each whose odds against ``unknown``
reach the probability that is calibrated on held-out examples of ``unknown``.

A prediction counts when a template of the family confirms it: the paragraph
must hold ``CONFIRM`` of the template's word pairs (runs of three words where
it is short), and no rival (a template that shares half of its pairs and is confirmed itself) may hold more of the pairs
that tell the two apart (cut at a paragraph's border before any of these, a
notice is confirmed by the next paragraph only). So a version 3 notice does not confirm version 2,
and a paragraph with both notices confirms both. SPDX expressions are read as
one identifier line for each of their licences.

Scoring has two steps, with the same result as one: the sum of each word's and
pair's largest positive weight bounds every family's odds from above, and only
paragraphs whose bound reaches the calibrated one go on to the model. The
bound comes from the trained weights, not from a list of words.

Only DataFrame functions and the DataFrame-based ``pyspark.ml`` run.
"""

from __future__ import annotations

import math
import random
from functools import reduce

from pyspark.ml import PipelineModel, Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quartermaster.llm.common import materialize, read, row_key, stage

UNKNOWN = "unknown"
CONFIRM = 0.8
FEATURES = 1 << 14
#: words from one paragraph's start to the next one's; a paragraph has twice as many
BLOCK = 40
#: documents and paragraphs of the corpus that examples of ``unknown`` come from, at most
SAMPLE_DOCS, SAMPLE_LINES = 200, 1500
#: variants made of each template, and the calibration's share of examples
VARIANTS, HELD_OUT = 24, 0.25
#: share of the held-out examples of ``unknown`` that may be believed (no template confirms them)
FALSE_BELIEFS = 0.01
#: templates of up to so many words are compared by runs of three words, longer ones by pairs
SHORT = 8
SEED = 7
#: weight of a family's example in training (of ``unknown``: 1)
WEIGHT = 3.0
_SPDX = "SPDX-License-Identifier:"

# Paragraphs of the corpus with one of these are no examples of ``unknown``.
STEMS = ("licen", "copyright", "permission", "warrant", "redistribut", "public domain", "spdx", "gnu", "gpl")

# Notices of licence families, as their publishers word them.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Distributed under the terms of the GNU GPL, version 3 or later.",
        "Licensed under the GNU General Public License v3.0.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-3.0-only",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "Distributed under the terms of the GNU GPL, version 2 or later.",
        "Licensed under the GNU General Public License v2.0.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-2.0-or-later",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "LGPL": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "SPDX-License-Identifier: LGPL-2.1-only",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
        "SPDX-License-Identifier: LGPL-3.0-only",
        "modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "AGPL-3.0": [
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
        "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "SPDX-License-Identifier: BSD-2-Clause",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "SPDX-License-Identifier: ISC",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC0-1.0": [
        "To the extent possible under law, the author has dedicated all copyright and related rights to the public domain worldwide.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: Unlicense",
    ],
}

# Sentences with the same words that name no licence.
OTHERWISE = [
    "The driver renewed the license of the car under the new rules.",
    "She had permission to use the library for any purpose.",
    "A fishing license is required, version of the form 2.0 or 3.",
    "The warranty covers all copies of the parts sold this year.",
    "He studied at MIT and worked for Apache before the license expired.",
    "Copyright law was changed twice in the last century.",
    "The general public was licensed to enter the park free of charge.",
    "Songs in the public domain were played at the works party.",
    "Redistribution of income was the subject of the debate.",
    "The committee released a statement under the name of the foundation.",
    "No license was mentioned in the terms of the agreement.",
    "Please read the license before you continue.",
    "All rights reserved, copyright of the author.",
    "The version of the file is licensed to somebody else.",
]


def words(text: Column) -> Column:
    """Lower-case runs of letters, digits and dots between digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+(?:\.[\p{N}]+)*"), F.lit(0))


def spelled_out(text: Column) -> Column:
    """``text`` (NULL: empty) with an SPDX line for each licence of an SPDX expression."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.contains(text, F.lit(_SPDX)), F.regexp_replace(
        text, rf"(?<={_SPDX}[^\n]{{0,400}})\s(?:OR|AND)\s", f" {_SPDX} ")).otherwise(text)


def pairs(ws: Column) -> Column:
    """Hashes of adjacent words, from the words' hashes."""
    return F.when(F.size(ws) > 1, F.transform(
        F.sequence(F.lit(0), F.size(ws) - 2), lambda i: F.xxhash64(F.get(ws, i), F.get(ws, i + 1)))
    ).otherwise(F.array().cast("array<bigint>"))


def has_stem(text: Column) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(F.lower(text), F.lit(s)) for s in STEMS))


def triples(ws: Column) -> Column:
    """Hashes of three words in a row, from the words' hashes."""
    return F.when(F.size(ws) > 2, F.transform(
        F.sequence(F.lit(0), F.size(ws) - 3), lambda i: F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)))
    ).otherwise(F.array().cast("array<bigint>"))


def _featured(df: DataFrame) -> DataFrame:
    """Add ``words``, ``pairs`` and ``terms`` (hashes) of column ``line``."""
    return _with_terms(df.withColumn("words", F.transform(words(F.col("line")), lambda x: F.xxhash64(x))))


def _with_terms(df: DataFrame) -> DataFrame:
    d = df.withColumn("pairs", pairs(F.col("words")))
    return d.withColumn("terms", F.concat("words", "pairs"))


def _examples() -> list[tuple[str, str]]:
    """(family, line): the templates, variants of them and look-alikes."""
    rng = random.Random(SEED)
    known = [w for line in OTHERWISE for w in line.split()]
    letters = "etaoinshrdlu"

    def other(most):  # words around a notice: of the sentences below, or made up
        return [rng.choice(known) if rng.random() < 0.5 else "".join(rng.choice(letters) for _ in range(rng.randint(2, 8)))
                for _ in range(rng.randint(0, most))]

    out = []
    for family, notices in TEMPLATES.items():
        for notice in notices:
            out += [(family, notice)] * 2
            ws = notice.split()
            for v in range(VARIANTS):
                kept = [w for w in ws if rng.random() > 0.06] or ws
                most = (4, BLOCK)[v % 2]
                out.append((family, " ".join(other(most) + kept + other(most))))
            for _ in range(VARIANTS // 4):
                mixed = ws + other(6)
                rng.shuffle(mixed)
                if len(ws) > 3:
                    out.append((UNKNOWN, " ".join(mixed)))
    for line in OTHERWISE:
        ws = line.split()
        out += [(UNKNOWN, line)] * 4
        for v in range(VARIANTS):
            out.append((UNKNOWN, " ".join(w for w in ws + other((5, BLOCK)[v % 2]) if rng.random() > 0.15)))
    return out


def train(docs: DataFrame) -> tuple[PipelineModel, list[str], float]:
    """The model, its classes in the order of its probabilities, and the
    calibrated probability from which a family is believed."""
    spark = docs.sparkSession
    classes = [UNKNOWN, *TEMPLATES]
    made = spark.createDataFrame(_examples(), "family string, line string")
    some = docs.select(docs["doc_id"].alias("id"), docs["text"].alias("t")).orderBy(F.xxhash64("id"), "id").limit(SAMPLE_DOCS)
    lines = materialize(some.select(F.explode(F.split(F.coalesce("t", F.lit("")), "\n")).alias("line"))
             .filter(~has_stem(F.col("line"))).orderBy(F.xxhash64("line"), "line").limit(SAMPLE_LINES)
             .select(F.lit(UNKNOWN).alias("family"), "line"))
    # notices set among the corpus' own words: each has a few of the (at most SAMPLE_LINES) paragraphs around it
    number = lambda d: d.withColumn("i", F.row_number().over(Window.orderBy(F.xxhash64("line"), "line")) - 1)
    notices = spark.createDataFrame([(f, n, v) for f, ns in TEMPLATES.items() for n in ns for v in range(VARIANTS // 2)], "f string, n string, v int")
    around = F.pmod(F.xxhash64("n", "v"), F.lit(max(lines.count(), 1)))
    among = notices.join(number(lines), around == F.col("i")).select(
        F.col("f").alias("family"), F.when(F.col("v") % 2 == 0, F.concat_ws(" ", "line", "n")).otherwise(F.concat_ws(" ", "n", "line")).alias("line"))
    label = F.element_at(F.create_map(*(F.lit(x) for i, c in enumerate(classes) for x in (c, float(i)))), F.col("family"))
    examples = materialize(_featured(made.unionByName(among).unionByName(lines)).withColumn("label", label)
                           .select("line", "terms", "label", F.when(F.col("label") == 0, 1.0).otherwise(WEIGHT).alias("weight"))
                           .withColumn("fold", F.pmod(F.xxhash64("line"), F.lit(1000)) / 1000.0)).coalesce(2)
    model = Pipeline(stages=[
        HashingTF(numFeatures=FEATURES, inputCol="terms", outputCol="features", binary=True),
        LogisticRegression(family="multinomial", maxIter=30, regParam=0.0005, elasticNetParam=0.3,
                           featuresCol="features", labelCol="label", weightCol="weight"),
    ]).fit(examples.filter(F.col("fold") >= HELD_OUT))
    held = _believed(model, classes, examples.filter((F.col("fold") < HELD_OUT) & (F.col("label") == 0)))
    most = held.agg(F.percentile(F.array_max("odds"), 1.0 - FALSE_BELIEFS)).first()[0] or 0.0
    return model, classes, min(max(0.5, most), 0.95)


def _believed(model: PipelineModel, classes: list[str], df: DataFrame) -> DataFrame:
    """Add ``family``, the likeliest class, ``probability``, its own against
    ``unknown``, and ``odds``, those of all families in their order."""
    names = F.array(*map(F.lit, classes))
    keep = [F.col(c) for c in df.columns if c not in ("features", "probability")]
    d = model.transform(df).select(*keep, vector_to_array("probability").alias("p"))
    unknown, best = F.get("p", F.lit(0)), F.array_max("p")
    # bound once: a condition on the odds is moved down to the model's functions
    d = d.withColumn("odds", F.get(F.transform(F.array("p"), lambda p: F.transform(
        F.slice(p, 2, len(classes) - 1), lambda x: x / (x + F.get(p, F.lit(0))))), F.lit(0)))
    d = d.withColumn("family", F.get(names, F.array_position("p", best).cast("int") - 1))
    return d.withColumn("probability", F.when(F.col("family") == UNKNOWN, unknown).otherwise(best / (best + unknown))).drop("p")


def _bounds(model: PipelineModel) -> tuple[Column, float]:
    """Of each feature the largest weight that any family has above
    ``unknown``'s (0 if none), as a constant array, and of the intercepts."""
    lr = model.stages[-1]
    w, b = lr.coefficientMatrix.toArray(), lr.interceptVector.toArray()
    most = (w[1:] - w[0]).max(axis=0).clip(min=0)
    text = ",".join("0" if x == 0 else repr(float(x)) for x in most)
    return F.split(F.lit(text), ",").cast("array<double>"), float((b[1:] - b[0]).max())


def paragraphs(docs: DataFrame, model: PipelineModel | None = None, least: float = 0.0) -> DataFrame:
    """``(doc_id, key, pos, words, terms)``: the paragraphs of
    ``(doc_id, key, text)``, ``pos`` their first word (from 0). With a model,
    only those that may reach the probability ``least`` for some family."""
    d = docs.select("doc_id", "key", words(spelled_out(F.col("text"))).alias("words"))
    d = d.select("doc_id", "key", F.transform("words", lambda x: F.xxhash64(x)).alias("words"))  # (a filter here would be moved below and cut the words twice)
    starts = F.sequence(F.lit(0), F.greatest(F.ceil(F.size("words") / BLOCK) - 2, F.lit(0)).cast("int"))
    if model is not None:
        weight, base = _bounds(model)
        of = lambda term: F.get(weight, F.pmod(F.hash(term), F.lit(FEATURES)))  # noqa: E731 - HashingTF's place of a bigint
        last = F.size("words") - 1
        d = d.withColumn("most", F.transform("words", lambda x, i: of(x) + F.when(
            i < last, of(F.xxhash64(x, F.get("words", i + 1)))).otherwise(0.0)))
        total = lambda k: F.aggregate(F.slice("most", k * BLOCK + 1, BLOCK), F.lit(0.0), lambda a, x: a + x)
        d = d.withColumn("sums", F.transform(F.sequence(F.lit(0), F.floor((F.size("most") - 1) / BLOCK).cast("int")), total))
        enough = math.log(least / (1 - least)) - base - 1e-6
        starts = F.filter(starts, lambda j: F.get("sums", j) + F.coalesce(F.get("sums", j + 1), F.lit(0.0)) >= enough)
    starts = F.when(F.size("words") > 0, starts)
    cut = F.transform(starts, lambda j: F.struct((j * BLOCK).alias("pos"), F.slice("words", j * BLOCK + 1, 2 * BLOCK).alias("words")))
    cut = F.transform(cut, lambda x: F.struct(
        x["pos"].alias("pos"), x["words"].alias("words"), F.concat(x["words"], pairs(x["words"])).alias("terms")))
    if model is not None:  # once more, as the model does it: a term that repeats counts once
        cut = F.filter(cut, lambda x: F.aggregate(F.array_distinct(x["terms"]), F.lit(0.0), lambda a, t: a + of(t)) >= enough)
    return d.select("doc_id", "key", F.explode(cut).alias("x")).select("doc_id", "key", "x.*")


def _templates(spark: SparkSession) -> list[dict]:
    """The templates with the hashes of their pairs and of what a paragraph
    must hold (``want``: pairs, or runs of three words), and of each its rivals:
    (number, pairs of the rival alone, pairs of the template alone)."""
    flat = [(f, n) for f, notices in TEMPLATES.items() for n in notices]
    rows = (_featured(spark.createDataFrame(flat, "family string, line string"))
            .select("family", "line", "words", "pairs", triples(F.col("words")).alias("triples")).collect())  # a fixed table
    out = [{"family": r.family, "line": r.line, "pairs": set(r.pairs),
            "want": set(r.triples if 2 < len(r.words) <= SHORT else r.pairs)} for r in rows]
    for t in out:
        t["rivals"] = [(i, sorted(r["pairs"] - t["pairs"]), sorted(t["pairs"] - r["pairs"])) for i, r in enumerate(out)
                       if r is not t and 2 * len(r["pairs"] & t["pairs"]) >= len(t["pairs"]) and r["pairs"] - t["pairs"]]
    return out


def _longs(values) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>") if values else F.array().cast("array<bigint>")


def scan(docs: DataFrame, trained: tuple[PipelineModel, list[str], float] | None = None) -> DataFrame:
    """``(doc_id, key, pos, family, template, probability, likeness,
    confirmed)``: for every paragraph (``pos``, its first word) of ``docs`` in
    which the classifier believes a licence family, the templates that confirm
    it; where none does, one row of the likeliest family, not confirmed.
    ``key`` is the row's key. Rows that repeat give the same paragraphs once
    each; NULL and empty texts none. ``trained`` is what ``train`` returns
    (by default it is trained on ``docs``)."""
    model, classes, least = trained or train(docs)
    d = docs.select(docs["doc_id"].alias("doc_id"), row_key(docs).alias("key"), docs["text"].alias("text"))
    scored = _believed(model, classes, paragraphs(d, model, least))
    # an explode, as a filter on the odds would be moved below the model and run it twice; only what is believed is written
    believed = F.filter(F.array(F.struct("pos", "words", "odds", "family", "probability")),
                        lambda x: F.array_max(x["odds"]) >= least)
    found = stage(scored.select("doc_id", "key", F.explode(believed).alias("x")).select("doc_id", "key", "x.*")
                  .dropDuplicates(["key", "doc_id", "pos"])
                  .withColumn("grams", F.concat(pairs(F.col("words")), triples(F.col("words")))).drop("words"))
    known = _templates(docs.sparkSession)
    share = lambda want: F.size(F.array_intersect("grams", _longs(sorted(want)))) / float(max(len(want), 1))
    found = found.withColumn("held", F.array(*(share(t["want"]) for t in known)))
    held = lambda i: F.get("held", F.lit(i))
    hits = []
    for i, t in enumerate(known):
        odds = F.get("odds", F.lit(classes.index(t["family"]) - 1))
        beaten = F.lit(False)
        for j, theirs, own in t["rivals"]:
            less = (share(theirs) > share(own)) | (share(own) == 0) if own else share(theirs) > 0
            beaten = beaten | ((held(j) >= CONFIRM) & less)
        hits.append(F.when((odds >= least) & (held(i) >= CONFIRM) & ~beaten, F.struct(
            F.lit(t["family"]).alias("family"), F.lit(t["line"]).alias("template"), odds.alias("probability"),
            held(i).alias("likeness"), F.lit(True).alias("confirmed"))))
    none = F.struct("family", F.lit(None).cast("string").alias("template"), "probability",
                    F.array_max("held").alias("likeness"), F.lit(False).alias("confirmed"))
    found = found.withColumn("hits", F.array_compact(F.array(*hits)))
    return found.select("doc_id", "key", "pos", F.explode(F.when(F.size("hits") > 0, F.col("hits")).otherwise(
        F.when(F.col("family") != UNKNOWN, F.array(none)))).alias("x")).select("doc_id", "key", "pos", "x.*")


def licences(docs: DataFrame, trained: tuple[PipelineModel, list[str], float] | None = None) -> DataFrame:
    """``(doc_id, n_lines, n_licences, n_unconfirmed, families)`` for every
    row of ``docs``: its lines, how many notices are confirmed (a template in
    paragraphs that follow each other counts once), how many paragraphs were
    believed but not confirmed, and the confirmed families in order,
    comma-joined ('' if none).

    NULL and empty texts have one empty line and no licence; rows that
    repeat get the same result; a NULL doc_id is kept; an empty table gives
    an empty result; other columns are not looked at.
    """
    by = Window.partitionBy("key", "doc_id", "template").orderBy("pos")
    found = scan(docs, trained).withColumn("before", F.lag("pos").over(by))
    new = F.col("confirmed") & (F.col("before").isNull() | (F.col("pos") - F.col("before") > BLOCK))
    per = found.groupBy(F.col("key").alias("__key"), F.col("doc_id").alias("__id")).agg(
        F.count(F.when(new, 1)).alias("n_licences"), F.count(F.when(~F.col("confirmed"), 1)).alias("n_unconfirmed"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("confirmed"), F.col("family")))), ",").alias("families"))
    text = F.coalesce(docs["text"], F.lit(""))
    d = docs.select(docs["doc_id"].alias("doc_id"), row_key(docs).alias("key"),
                    (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"))
    return d.join(per, (d["key"] == per["__key"]) & d["doc_id"].eqNullSafe(per["__id"]), "left").select(
        "doc_id", "n_lines", F.coalesce("n_licences", F.lit(0)).cast("long").alias("n_licences"),
        F.coalesce("n_unconfirmed", F.lit(0)).cast("long").alias("n_unconfirmed"),
        F.coalesce("families", F.lit("")).alias("families"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences(read(spark, sf_dir, "documents"))
