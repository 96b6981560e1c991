"""Line dedup against a plain loop."""

import random

import pytest
from pyspark.sql import functions as F

from quartermaster.llm import lines as L


def plain(rows):
    """(doc_id, text) with distinct ids -> {doc_id: text that stays}"""
    seen, gone = set(), {}
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        ls = (text or "").split("\n")
        for p in range(len(ls) - 2):
            w = tuple(ls[p:p + 3])
            if w in seen:
                gone.setdefault(i, set()).update((p, p + 1, p + 2))
            seen.add(w)
    return {i: text if i not in gone else "\n".join(x for p, x in enumerate(text.split("\n")) if p not in gone[i])
            for i, text in rows}


def test_random_lines(spark):
    rng = random.Random(6)
    rows = [(i, "\n".join(rng.choice(["a", "b", "c", ""]) for _ in range(rng.randint(0, 14)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "same\n" * 30), (None, "a\nb\nc\na")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.text for r in L.dedup_lines(docs).collect()} == plain(rows)


def test_counts(spark):
    docs = spark.createDataFrame([(1, "x\ny\nz"), (2, "0\nx\ny\nz\n1"), (3, "x\ny")], "doc_id long, text string")
    got = {r.doc_id: (r.text, r["__n_lines"], r["__n_removed"]) for r in L.dedup_lines(docs, counts=True).collect()}
    assert got == {1: ("x\ny\nz", 3, 0), 2: ("0\n1", 5, 3), 3: ("x\ny", 2, 0)}


def test_edges(edge_docs, no_docs):
    assert L.dedup_lines(no_docs).count() == 0
    got = L.dedup_lines(edge_docs)
    assert got.columns == edge_docs.columns and got.count() == edge_docs.count()
    changed = got.join(edge_docs.dropDuplicates(["doc_id", "text"]).select("doc_id", F.col("text").alias("old")), "doc_id") \
        .filter("doc_id in (1, 4, 6, 7)")
    by_id = {r.doc_id: (r.text, r.old) for r in changed.collect()}
    assert by_id[7][0] == "Intro.\nOutro." and all(a == b for i, (a, b) in by_id.items() if i != 7)


def test_only_built_in_functions(spark):
    plan = L.op9_line_dedup(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("text", ["a\nb\nc\n" * 20_000])
def test_very_long_text(spark, text):
    docs = spark.createDataFrame([(1, text), (2, "q\nr\ns")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in L.dedup_lines(docs).collect()}
    assert got == plain([(1, text), (2, "q\nr\ns")])


def test_columns_with_names_of_its_own(spark):
    para = "a line\nanother line\nthe third line"
    docs = spark.createDataFrame([(1, para, "X", [1]), (2, para, "Y", [2])], "doc_id long, text string, __lines string, __kept array<int>")
    got = sorted(tuple(r) for r in L.dedup_lines(docs).collect())
    assert got == [(1, para, "X", [1]), (2, "", "Y", [2])]
