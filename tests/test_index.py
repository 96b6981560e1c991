import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import rows
from quartermaster.operators.index import (IndexBranch, IndexEmit, contiguous_number,
                                           publish_all, read_published, search_index)


def test_contiguous_number_matches_global_row_number(spark):
    rnd = random.Random(7)
    data = [(rnd.randint(0, 5), str(rnd.randint(0, 10_000)), i) for i in range(3_500)]
    df = spark.createDataFrame(data, "branch int, page string, uniq int").repartition(6)
    got = contiguous_number(df, ["branch", "page", "uniq"], partitions=6)
    want = df.withColumn("order", F.row_number().over(Window.orderBy("branch", "page", "uniq")))
    assert rows(got) == rows(want)
    assert got.agg(F.min("order"), F.max("order"), F.countDistinct("order")).first() == (1, 3_500, 3_500)


def test_index_branches(spark):
    t = spark.createDataFrame([(1, "A", "가"), (2, None, "나")], "id int, name_en string, name_kr string")
    u = spark.createDataFrame([("x", "X")], "id string, name string")
    idx = search_index([
        IndexBranch(t, [IndexEmit("H : ", "name_en", "/hideout", "HIDEOUT", with_id=False),
                        IndexEmit("H : ", "name_kr", "/hideout", "HIDEOUT", with_id=False)]),
        IndexBranch(u, [IndexEmit("W : ", "name", "/weapon?id=", "WEAPON")]),
    ])
    assert rows(idx) == sorted([
        ("H : A", "/hideout", "1", "HIDEOUT", 1), (None, "/hideout", "2", "HIDEOUT", 2),
        ("H : 가", "/hideout", "1", "HIDEOUT", 3), ("H : 나", "/hideout", "2", "HIDEOUT", 4),
        ("W : X", "/weapon?id=x", "x", "WEAPON", 5)], key=repr)


def test_publish_versions(spark, tmp_path):
    root = str(tmp_path / "tables")
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2,), (3,)], "x int")
    publish_all({"t": a}, root, version="001")
    publish_all({"t": b, "u": a}, root, version="002")
    assert rows(read_published(spark, root, "t")) == [(2,), (3,)]
    assert rows(read_published(spark, root, "u")) == [(1,)]


def test_contiguous_number_splits_a_hot_value(spark):
    # one order value holds 40 % of the rows: it must not end up in one partition
    df = spark.createDataFrame([(0 if i % 5 < 2 else i, i) for i in range(5_000)], "k int, i int").repartition(4)
    got = contiguous_number(df, ["k"], partitions=8)
    assert got.agg(F.min("order"), F.max("order"), F.countDistinct("order")).first() == (1, 5_000, 5_000)
    hot = got.filter("k = 0").agg(F.min("order"), F.max("order")).first()
    assert hot == (1, 2_000)


def test_latest_commit_wins_over_version_label(spark, tmp_path):
    root = str(tmp_path / "tables")
    publish_all({"t": spark.createDataFrame([(1,)], "x int")}, root, version="b000000000009")
    publish_all({"t": spark.createDataFrame([(2,)], "x int")}, root, version="20240101T000000Z")
    assert rows(read_published(spark, root, "t")) == [(2,)]
