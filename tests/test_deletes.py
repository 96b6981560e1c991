import datetime as dt

from pyspark.sql import functions as F

from helpers import rows
from quartermaster.operators.deletes import (cascade_delete, delete_in, delete_not_exists,
                                             delete_where, expired, issue_board)

AS_OF = dt.datetime(2024, 1, 15)


def test_delete_where_keeps_null(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 14)), (2, dt.datetime(2024, 1, 15)),
                                (3, dt.datetime(2024, 1, 16)), (4, None)],
                               "id int, ban_end_time timestamp_ntz")
    # T4: before -> deleted, equal / after / NULL -> kept
    assert rows(delete_where(df, expired("ban_end_time", AS_OF)), "id") == [(2,), (3,), (4,)]


def test_in_vs_not_exists_null_keys(spark):
    issues = spark.createDataFrame([("a",), ("b",), (None,), ("zz",)], "board_id string")
    boards = spark.createDataFrame([("a", 9), ("b", 10), (None, 1)], "id string, like_count int")
    low = boards.filter(F.col("like_count") < 10).select("id")
    # T5: IN-delete keeps NULL keys, NOT EXISTS-delete removes them
    assert rows(delete_in(issues, low, "board_id", "id")) == sorted([("b",), (None,), ("zz",)], key=repr)
    assert rows(delete_not_exists(issues, boards, "board_id", "id")) == [("a",), ("b",)]


def test_cascade_one_instant(spark):
    req = spark.createDataFrame([("u1", dt.datetime(2024, 1, 1)), ("u2", dt.datetime(2024, 2, 1)),
                                 ("u3", None)], "email string, delete_end_time timestamp_ntz")
    icons = spark.createDataFrame([("u1", 1), ("u2", 2), ("u3", 3), (None, 4)], "user_email string, i int")
    out = cascade_delete(req, "email", "delete_end_time", AS_OF, {"icons": (icons, "user_email")})
    assert rows(out["parent"], "email") == [("u2",), ("u3",)]
    assert rows(out["icons"], "i") == [(2,), (3,), (4,)]


def test_issue_board_order_and_thresholds(spark):
    issues = spark.createDataFrame([("p9", "old"), ("p10", "old"), ("pnull", "old"), ("gone", "old"),
                                    (None, "nokey")], "board_id string, board_type string")
    boards = spark.createDataFrame([("p9", "T9", 9), ("p10", "T10", 10), ("pnull", "TN", None),
                                    ("p11", "T11", 11)], "id string, type string, like_count int")
    out = issue_board(issues, boards, insert_map={"board_type": "type"})
    # 9 likes demoted, NULL likes neither demoted nor promoted, orphan and NULL key removed,
    # 10 and 11 likes promoted (10 updated, 11 inserted)
    assert rows(out) == [("p10", "T10"), ("p11", "T11"), ("pnull", "old")]
