import pytest

from helpers import rows
from quartermaster.operators.merge import (assert_unique_keys, duplicate_keys, last_per_key,
                                           merge, update_from)

TGT = "id string, a int, b int, curated string"


def test_merge_presence_markers(spark):
    t = spark.createDataFrame([("k1", 1, 1, "keep"), ("k2", 2, 2, "keep2")], TGT)
    s = spark.createDataFrame([("k1", None, 10, 0), ("k3", 3, 30, 0)], "id string, a int, b int, pos int")
    out = merge(t, s, "id", insert_cols=["a", "b"], update_cols=["a", "b"], order_cols="pos")
    # NULL in the source overwrites; T6: curated survives; k2 untouched; k3 inserted
    assert rows(out) == sorted([("k1", None, 10, "keep"), ("k2", 2, 2, "keep2"),
                                ("k3", 3, 30, None)], key=repr)


def test_merge_insert_only_column(spark):
    t = spark.createDataFrame([("k1", 1, 1, None)], TGT)
    s = spark.createDataFrame([("k1", 9, 9, 0), ("k2", 5, 5, 0)], "id string, a int, b int, pos int")
    out = merge(t, s, "id", insert_cols=["a", "b"], update_cols=["b"], order_cols="pos")
    # A is written for new keys only
    assert rows(out, "id", "a", "b") == [("k1", 1, 9), ("k2", 5, 5)]


def test_merge_last_wins_by_position(spark):
    t = spark.createDataFrame([], TGT)
    s = spark.createDataFrame([("k", 1, 1, 0), ("k", 2, 2, 2), ("k", 3, 3, 1)],
                              "id string, a int, b int, pos int")
    out = merge(t, s, "id", insert_cols=["a", "b"], order_cols="pos")
    assert rows(out, "id", "a") == [("k", 2)]


def test_merge_duplicates_error(spark):
    t = spark.createDataFrame([], TGT)
    s = spark.createDataFrame([("k", 1, 1), ("k", 2, 2)], "id string, a int, b int")
    with pytest.raises(Exception) as e:
        merge(t, s, "id", insert_cols=["a", "b"], duplicates="error").collect()
    assert "duplicate" in str(e.value).lower()


def test_merge_null_key_error(spark):
    s = spark.createDataFrame([(None, 1)], "id string, a int")
    with pytest.raises(Exception):
        assert_unique_keys(s, "id").collect()


def test_merge_idempotent(spark):
    t = spark.createDataFrame([("k1", 1, 1, "c")], TGT)
    s = spark.createDataFrame([("k1", 2, None, 0), ("k2", 3, 3, 1)], "id string, a int, b int, pos int")
    once = merge(t, s, "id", insert_cols=["a", "b"], order_cols="pos")
    twice = merge(once, s, "id", insert_cols=["a", "b"], order_cols="pos")
    assert rows(once) == rows(twice)


def test_merge_composite_key(spark):
    t = spark.createDataFrame([("l1", "A", "old", 1.0)], "level_id string, type string, name string, v double")
    s = spark.createDataFrame([("l1", "A", "new", 2.0, 1), ("l1", "A", "newer", 3.0, 2),
                               ("l1", "B", "b", 4.0, 0)],
                              "level_id string, type string, name string, v double, pos int")
    out = merge(t, s, ["level_id", "type"], insert_cols=["name", "v"], order_cols="pos")
    assert rows(out) == [("l1", "A", "newer", 3.0), ("l1", "B", "b", 4.0)]


def test_update_from_keeps_unmatched(spark):
    t = spark.createDataFrame([("a", 1), ("b", 2)], "email string, grade int")
    s = spark.createDataFrame([("a", 5)], "email string, g int")
    assert rows(update_from(t, s, "email", {"grade": "g"})) == [("a", 5), ("b", 2)]


def test_duplicate_keys_and_last_per_key(spark):
    df = spark.createDataFrame([(1, "x", 0), (1, "y", 1), (2, "z", 0)], "k int, v string, pos int")
    assert rows(duplicate_keys(df, "k")) == [(1, 2)]
    assert rows(last_per_key(df, "k", "pos", cols=["k", "v"])) == [(1, "y"), (2, "z")]


def test_merge_last_wins_rejects_null_key(spark):
    t = spark.createDataFrame([], TGT)
    s = spark.createDataFrame([(None, 1, 1, 0)], "id string, a int, b int, pos int")
    with pytest.raises(Exception) as e:
        merge(t, s, "id", insert_cols=["a", "b"], order_cols="pos").collect()
    assert "NULL key" in str(e.value)


def test_merge_keeps_null_keys_and_reads_each_side_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = spark.range(2000).selectExpr("CASE WHEN id % 3 = 0 THEN NULL ELSE id END AS a", "id % 7 AS b", "1 AS v", "map(1, id) AS m")
        s = spark.range(500).selectExpr("id + 1800 AS a", "(id + 1800) % 7 AS b", "-1 AS v", "id AS pos")
        out = merge(t, s, ["a", "b"], insert_cols=["v"], order_cols="pos")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 2 and plan.count("Range (") == 2, plan
        got = out.cache()
        assert got.count() == 2000 + 500 - t.filter("a >= 1800").count()
        assert got.filter("a IS NULL").count() == t.filter("a IS NULL").count()
        assert got.filter("v = -1").count() == 500
        assert got.filter("m IS NULL").count() == 500 - t.filter("a >= 1800").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_null_keys_of_one_content_do_not_meet_in_one_task(spark):
    from pyspark.sql import functions as F
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        t = spark.range(0, 8000, 1, 8).selectExpr("CASE WHEN id < 0 THEN id END AS k", "0 AS v")
        s = spark.createDataFrame([(1, 1, 0)], "k bigint, v int, pos int")
        out = merge(t, s, "k", insert_cols=["v"], order_cols="pos")
        per_task = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert sum(per_task) == 8001 and max(per_task) <= 5000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_merge_checks_the_source_even_where_nothing_is_taken_from_it(spark):
    t = spark.createDataFrame([("k", 1)], "id string, a int")
    s = spark.createDataFrame([("k", 1), ("k", 2)], "id string, a int")
    with pytest.raises(Exception, match="duplicate"):
        merge(t, s, "id", insert_cols=["a"], update_cols=[], duplicates="error").collect()


def test_key_types(spark):
    t = spark.createDataFrame([(1, 1)], "id bigint, a int")
    s = spark.createDataFrame([(1, 5, 0), (2, 6, 0)], "id int, a int, pos int")
    assert rows(merge(t, s, "id", insert_cols=["a"], order_cols="pos")) == [(1, 5), (2, 6)]
    with pytest.raises(ValueError, match="key id"):
        merge(t, s.selectExpr("string(id) AS id", "a", "pos"), "id", insert_cols=["a"], order_cols="pos")


def test_issue_board_by_cases(spark):
    """The one-pass board against its three steps."""
    from quartermaster.operators.deletes import delete_in, delete_not_exists, issue_board
    boards = spark.createDataFrame([(1, "t1", 12), (2, "t2", 3), (3, "t3", None), (4, "t4", 10), (6, "t6", 11), (6, "t6", 2)],
                                   "id int, type string, like_count int")
    old = spark.createDataFrame([(1, "o1", "x"), (2, "o2", "x"), (3, "o3", "x"), (5, "o5", "x"), (None, "on", "x"), (6, "o6", "x")],
                                "board_id int, board_type string, note string")
    out = issue_board(old, boards, insert_map={"board_type": "type"})
    step = delete_not_exists(delete_in(old, boards.filter("like_count < 10").select("id"), "board_id", "id"), boards.select("id"), "board_id", "id")
    up = boards.filter("like_count >= 10").selectExpr("id AS board_id", "type AS board_type")
    assert rows(out) == rows(merge(step, up, "board_id", duplicates="error")) == sorted(
        [(1, "t1", "x"), (3, "o3", "x"), (4, "t4", None), (6, "t6", None)], key=repr)
    twice = boards.union(spark.createDataFrame([(1, "again", 20)], boards.schema))
    with pytest.raises(Exception, match="duplicate"):
        issue_board(old, twice, insert_map={"board_type": "type"}).collect()
    nobody = boards.union(spark.createDataFrame([(None, "n", 20)], boards.schema))
    with pytest.raises(Exception, match="NULL key"):
        issue_board(old, nobody, insert_map={"board_type": "type"}).collect()


def test_key_checks_see_only_rows_that_a_filter_lets_through(spark):
    t = spark.createDataFrame([(1, 0)], "id int, a int")
    s = spark.createDataFrame([(None, 1, 0), (2, 2, 1)], "id int, a int, pos int").filter("id IS NOT NULL")
    assert rows(merge(t, s, "id", insert_cols=["a"], order_cols="pos")) == [(1, 0), (2, 2)]
    assert rows(merge(t, s.drop("pos"), "id", insert_cols=["a"], duplicates="error")) == [(1, 0), (2, 2)]
