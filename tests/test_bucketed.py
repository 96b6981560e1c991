"""Bucketed tables: only touched buckets are rewritten, a run that dies at any
step is run again, readers see whole versions."""

import os

import pytest

from helpers import rows
from quartermaster.operators import bucketed as B

SCHEMA = "id bigint, v string, curated string"


def source(spark, items):
    return spark.createDataFrame([(i, v, n) for n, (i, v) in enumerate(items)], "id bigint, v string, pos int")


def put(spark, path, items, **more):
    return B.merge_into_path(source(spark, items), path, "id", ["v"], order_cols="pos", buckets=8, **more)


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, [(i, f"v{i}") for i in range(200)], target_schema=SCHEMA)
    return path


def test_only_touched_buckets_are_written(spark, table):
    before = B.current_version(spark, table)
    assert sorted(before.folders) == list(range(8))
    touched = put(spark, table, [(3, "new3"), (3, "newer3"), (1000, "n")])
    after = B.current_version(spark, table)
    assert {b for b in after.folders if after.folders[b] != before.folders[b]} == set(touched) and len(touched) <= 2
    t = B.read_bucketed(spark, table)
    assert t.columns == ["id", "v", "curated"] and t.count() == 201
    assert rows(t.filter("id in (3, 1000)"), "id", "v") == [(1000, "n"), (3, "newer3")]
    # the version before is still there for its readers
    assert rows(B.read_bucketed(spark, table, before.number).filter("id = 3"), "v") == [("v3",)]


def test_keys_open_only_their_buckets(spark, table):
    found = B.read_bucketed(spark, table, keys=spark.createDataFrame([(3,)], "id bigint"))
    assert len({os.path.dirname(f) for f in found.inputFiles()}) == 1
    assert rows(found.filter("id = 3"), "v") == [("v3",)]


@pytest.mark.parametrize("step", ["before the data", "within the data", "before the commit"])
@pytest.mark.parametrize("first", [True, False])
def test_a_run_that_dies_is_run_again(spark, tmp_path, monkeypatch, step, first):
    path = str(tmp_path / "t")
    if not first:
        put(spark, path, [(i, f"v{i}") for i in range(50)], target_schema=SCHEMA)

    def die(*args, **kw):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        if step == "before the data":
            m.setattr(B, "merge", die)
        elif step == "within the data":
            from pyspark.sql import functions as F
            m.setattr(B, "merge", lambda *a, **k: own(*a, **k).withColumn("v", F.raise_error(F.col("v")).cast("string")))
        else:
            m.setattr(B, "_commit", die)
        own = __import__("quartermaster.operators.merge", fromlist=["merge"]).merge
        with pytest.raises(Exception):
            put(spark, path, [(1, "one"), (99, "new")], target_schema=SCHEMA)
    if first:
        assert B.current_version(spark, path) is None
        with pytest.raises(FileNotFoundError):
            B.read_bucketed(spark, path)
    else:
        assert rows(B.read_bucketed(spark, path), "id", "v") == sorted(((i, f"v{i}") for i in range(50)), key=repr)
    put(spark, path, [(1, "one"), (99, "new")], target_schema=SCHEMA)
    got = dict(rows(B.read_bucketed(spark, path), "id", "v"))
    assert got == ({} if first else {i: f"v{i}" for i in range(50)}) | {1: "one", 99: "new"}
    B.remove_unused(spark, path, keep=1)
    used = {os.path.join(path, f) for f in B.current_version(spark, path).folders.values()}
    there = {os.path.join(path, "data", run, b) for run in os.listdir(os.path.join(path, "data"))
             for b in os.listdir(os.path.join(path, "data", run)) if b.startswith("key_bucket=")}
    assert there == used
    assert dict(rows(B.read_bucketed(spark, path), "id", "v")) == got


def test_layout_is_part_of_the_table(spark, table):
    with pytest.raises(ValueError, match="8 buckets"):
        B.merge_into_path(source(spark, [(1, "x")]), table, "id", ["v"], order_cols="pos", buckets=16)
    with pytest.raises(ValueError, match="keyed by"):
        B.merge_into_path(source(spark, [(1, "x")]), table, "v", ["id"], order_cols="pos", buckets=8)
    with pytest.raises(ValueError, match="no version"):
        B.read_bucketed(spark, table, 77)


def test_only_a_missing_table_starts_empty(spark, tmp_path):
    with pytest.raises(ValueError, match="target_schema"):
        put(spark, str(tmp_path / "none"), [(1, "x")])
    (tmp_path / "odd" / "_manifest").mkdir(parents=True)
    (tmp_path / "odd" / "_manifest" / "part-0.parquet").write_text("no parquet", encoding="utf-8")
    with pytest.raises(Exception):
        put(spark, str(tmp_path / "odd"), [(1, "x")], target_schema=SCHEMA)


def test_empty_sources(spark, tmp_path):
    path = str(tmp_path / "t")
    assert put(spark, path, [], target_schema=SCHEMA) == []
    assert B.read_bucketed(spark, path).count() == 0
    put(spark, path, [(1, "x")])
    assert put(spark, path, []) == []
    assert rows(B.read_bucketed(spark, path), "id", "v") == [(1, "x")]
