"""Licence scan: held-out variants, look-alikes, edges."""

import random
import textwrap

import pytest
from pyspark.sql import functions as F

from quartermaster.llm import licenses as L


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(11)
    filler = ["thesonou", "wher", "inder", "of", "the", "ation", "eren", "shly"]
    rows, want = [], {}
    families = list(L.TEMPLATES)
    for i in range(120):
        lines = [" ".join(rng.choice(filler) for _ in range(8)) for _ in range(4)]
        if i % 2 == 0:
            f = families[(i // 2) % len(families)]
            lines.insert(rng.randint(0, 4), rng.choice(L.TEMPLATES[f]))
            want[i] = f
        elif i % 5 == 0:
            lines.insert(1, "She had a license for the boat and permission of the public office.")
        rows.append((i, "\n".join(lines)))
    return spark.createDataFrame(rows, "doc_id long, text string"), want


def test_families(corpus):
    docs, want = corpus
    got = {r.doc_id: r for r in L.licences(docs).collect()}
    assert len(got) == 120
    assert {i: r.families for i, r in got.items() if r.families} == want
    assert all(r.n_lines == (5 if i in want or (i % 2 and i % 5 == 0) else 4) for i, r in got.items())


def test_unknown_is_calibrated(corpus):
    docs, _ = corpus
    model, classes, least = L.train(docs)
    assert classes[0] == L.UNKNOWN and 0.5 <= least <= 0.95
    lines = docs.sparkSession.createDataFrame(
        [("the car license of the new version was renewed by permission",), ("copyright is a word of the law",), ("wher inder of the",)], "line string")
    for r in L._believed(model, classes, L._featured(lines)).collect():
        assert r.family == L.UNKNOWN or r.probability < least


def test_edges(edge_docs, no_docs):
    got = L.licences(edge_docs)
    assert got.count() == edge_docs.count() and got.filter("families <> '' or n_licences > 0").count() == 0
    assert {r.n_lines for r in got.filter("doc_id in (2, 3)").collect()} == {1}
    assert L.licences(no_docs).count() == 0


def test_repeated_rows_and_two_notices(spark):
    text = "Released under the MIT License.\nnothing\nLicensed under CC BY 4.0."
    docs = spark.createDataFrame([(1, text), (1, text), (2, "released UNDER the mit license")], "doc_id long, text string")
    got = sorted((r.doc_id, r.families, r.n_licences) for r in L.licences(docs).collect())
    assert got == [(1, "CC-BY-4.0,MIT", 2), (1, "CC-BY-4.0,MIT", 2), (2, "MIT", 1)]


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
GPL = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
WRAPPED = {
    "MIT": MIT,
    "GPL-3.0": GPL + "\n\nThis program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "GPL-2.0": GPL.replace("software: you", "software; you").replace("Foundation, either version 3", "Foundation; either version 2"),
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n"
           "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "ISC": L.TEMPLATES["ISC"][0],
    "Unlicense": L.TEMPLATES["Unlicense"][0],
    "Apache-2.0": "You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0",
}


def test_wrapped_notices(spark):
    """Published wording, wrapped at several widths, as it is and in comments."""
    docs, want = [], {}
    for f, text in WRAPPED.items():
        for width in (30, 55, 70, 79):
            for mark in ("", " * ", "# "):
                lines = [mark + x for p in text.split("\n") for x in (textwrap.wrap(p, width) or [""])]
                want[len(docs)] = (f, {"MIT": 2, "BSD": 2}.get(f, 1))
                docs.append((len(docs), "\n".join(["wher inder of", *lines, "int main() of the"])))
    got = {r.doc_id: (r.families, r.n_licences) for r in L.licences(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == want, {i: (docs[i][1], got[i], w) for i, w in want.items() if got[i] != w}


HEADER = ("This {0} is free software{1} you can redistribute it and/or modify it under the terms of the GNU {2}General Public License as "
          "published by the Free Software Foundation{3} either version {4} of the License, or (at your option) any later version.")
NOTICES = [
    (HEADER.format("library", ";", "Lesser ", ";", "2.1"), "LGPL"), (HEADER.format("library", ":", "Lesser ", ",", "3"), "LGPL"),
    (HEADER.format("program", ":", "Affero ", ",", "3"), "AGPL-3.0"), (HEADER.format("program", ":", "", ",", "3"), "GPL-3.0"),
    (HEADER.format("program", ";", "", ";", "2"), "GPL-2.0"),
    (MIT.split("\n")[0] + " " + L.TEMPLATES["Apache-2.0"][1], "Apache-2.0,MIT"),
    ("// SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0"), ("# SPDX-License-Identifier: LGPL-3.0-only", "LGPL"),
    ("/* SPDX-License-Identifier: BSD-2-Clause */", "BSD"), ("// SPDX-License-Identifier: (MIT OR Apache-2.0)", "Apache-2.0,MIT"),
    ("SPDX-License-Identifier: (GPL-2.0-only OR BSD-3-Clause) AND ISC", "BSD,GPL-2.0,ISC"),
    ("Distributed under the terms of the GNU GPL, version 3 or later", "GPL-3.0"),
]


@pytest.fixture(scope="module")
def trained(spark):
    return L.train(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def test_published_notices(spark, trained):
    """Alone, within long texts at places around the borders of paragraphs."""
    filler = "wher inder of the ation eren shly thesonou".split()
    rows, want = [], {}
    for text, families in NOTICES:
        for before in (0, 17, 39, 61, 70, 118):
            pad = lambda n: " ".join(filler[i % 8] for i in range(n))
            want[len(rows)] = families
            rows.append((len(rows), f"{pad(before)}\n{text}\n{pad(before)}"))
    got = {r.doc_id: r.families for r in L.licences(spark.createDataFrame(rows, "doc_id long, text string"), trained).collect()}
    assert got == want, {i: (rows[i][1], got[i], w) for i, w in want.items() if got[i] != w}


def test_bound_loses_nothing(spark, trained):
    """The paragraphs kept by the bound hold all that the model believes."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", F.lit(0).alias("key"), "text")
    docs = docs.unionByName(spark.createDataFrame([(-1 - i, 0, t) for i, (t, _) in enumerate(NOTICES)], "doc_id long, key int, text string"))
    model, classes, least = trained
    sure = lambda d: {(r.doc_id, r.pos) for r in L._believed(model, classes, d).filter(F.array_max("odds") >= least).collect()}
    every = L.paragraphs(docs)
    kept = L.paragraphs(docs, model, least)
    assert len(sure(every)) >= len(NOTICES) and sure(every) == sure(kept) and kept.count() < every.count()


def test_templates_against_brute_force(spark, trained):
    """Every line of the table that holds all of a template is confirmed."""
    import re
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    norm = lambda t: " " + " ".join(re.findall(r"[^\W_]+(?:\.[^\W_]+)*", (t or "").lower())) + " "
    known = [(f, norm(n)) for f, notices in L.TEMPLATES.items() for n in notices]
    want = {}
    for r in docs.collect():
        text = norm(r.text)
        hits = [(f, n) for f, n in known if n in text]
        want[r.doc_id] = ",".join(sorted({f for f, _ in hits}))
    got = {r.doc_id: r.families for r in L.licences(docs, trained).collect()}
    assert sum(map(bool, want.values())) > 20 and got == want


def test_only_built_in_functions(spark):
    plan = L.op2_license_scan(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert not any(x in plan for x in ("MapInPandas", "MapInArrow", "PythonUDF", "ArrowEval"))
    assert F.col("x") is not None
