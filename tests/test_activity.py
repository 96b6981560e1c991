import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import rows
from quartermaster.operators import activity

USERS = "email string, attendance_count int, grade int"
BOARDS = "id string, writer string, type string, like_count int"
COMMENTS = "board_id string, user_email string, is_delete_by_user boolean, is_delete_by_admin boolean"


def _community(spark):
    users = spark.createDataFrame([("a", 10, 0), ("b", None, 7), ("c", 0, 1), ("d", 2, 2)], USERS)
    boards = spark.createDataFrame([("p1", "a", "t", 1), ("p2", "a", "t", 1), ("p3", "b", "t", 1),
                                    ("p4", "zz", "t", 1)], BOARDS)
    comments = spark.createDataFrame([
        ("p1", "a", False, False), ("p1", "a", False, False),   # twice on one post: counts once
        ("p2", "a", True, False),                                # deleted by user
        ("p3", "a", False, True),                                # deleted by admin
        ("p3", "c", None, False),                                # NULL flag excluded
        ("p4", "c", False, False), ("p9", "c", False, False),    # unknown post excluded
        ("p1", "zz", False, False)], COMMENTS)                   # unknown user
    return users, boards, comments


def test_statistics(spark):
    users, boards, comments = _community(spark)
    s = activity.user_post_statistics(users, boards, comments)
    assert rows(s) == [("a", 2, 1), ("b", 1, 0), ("c", 0, 1), ("d", 0, 0)]


def test_grades(spark):
    users, boards, comments = _community(spark)
    stats = activity.user_post_statistics(users, boards, comments)
    grades = spark.createDataFrame([(1, 10), (2, 75), (3, 75), (4, 100)], "id int, score int")
    out = activity.update_user_grade(users, stats, grades)
    # a: 50+20+5 = 75 -> tie of 2 and 3 -> highest id 3; b: NULL attendance -> keeps 7;
    # c: 0+0+5 = 5 -> below every threshold -> keeps 1; d: 10 -> equal to threshold -> 1
    assert rows(out) == [("a", 10, 3), ("b", None, 7), ("c", 0, 1), ("d", 2, 1)]
    sweep = activity.update_user_grade(users, stats, grades, strategy="sweep")
    assert rows(sweep) == rows(out)
    assert rows(activity.grades_max_by(activity.total_scores(users, stats), grades)) == \
        [("a", 3), ("d", 1)]


@settings(max_examples=15, deadline=None)
@given(scores=st.lists(st.one_of(st.none(), st.integers(-5, 60)), min_size=1, max_size=40),
       thresholds=st.lists(st.tuples(st.integers(1, 9), st.integers(0, 50)), min_size=1, max_size=8))
def test_threshold_paths_agree(spark, scores, thresholds):
    facts = spark.createDataFrame([(str(i), s) for i, s in enumerate(scores)], "email string, total_score bigint")
    g = spark.createDataFrame(thresholds, "id int, score int")
    a = activity.best_grades(facts, g)
    b = activity.best_grades(facts, g, strategy="sweep")
    want = []
    for i, s in enumerate(scores):
        ok = [(sc, gid) for gid, sc in thresholds if s is not None and sc <= s]
        want.append((str(i), s, max(ok)[1] if ok else None))
    assert rows(a) == sorted(want, key=repr)
    assert rows(b) == sorted(want, key=repr)


@pytest.mark.parametrize("strategy", ["broadcast", "sweep"])
def test_threshold_ties_without_a_tie_column(spark, strategy):
    from quartermaster.operators.joins import threshold_lookup
    t = spark.createDataFrame([(1.0, "x"), (1.0, "z"), (1.0, "y"), (3.0, "w"), (None, "n")], "t double, p string")
    f = spark.createDataFrame([(0.5,), (1.0,), (2.9,), (3.0,), (None,)], "v double")
    got = rows(threshold_lookup(f, "v", t, "t", ["p"], strategy=strategy))
    assert got == sorted([(0.5, None), (1.0, "z"), (2.9, "z"), (3.0, "w"), (None, None)], key=repr)


@pytest.mark.parametrize("strategy", ["broadcast", "sweep"])
def test_threshold_of_other_types(spark, strategy):
    import datetime as dt
    from quartermaster.operators.joins import threshold_lookup
    day = lambda n: dt.datetime(2024, 1, n)
    t = spark.createDataFrame([(day(2), 1), (day(5), 2)], "t timestamp_ntz, p int")
    f = spark.createDataFrame([(day(1),), (day(2),), (day(9),)], "v timestamp_ntz")
    assert rows(threshold_lookup(f, "v", t, "t", ["p"], strategy=strategy)) == [(day(1), None), (day(2), 1), (day(9), 2)]
    t = spark.createDataFrame([("b", 1), ("d", 2)], "t string, p int")
    f = spark.createDataFrame([("a",), ("c",), ("d",)], "v string")
    assert rows(threshold_lookup(f, "v", t, "t", ["p"], strategy=strategy)) == [("a", None), ("c", 1), ("d", 2)]


def test_broadcast_over_its_bound_fails(spark, monkeypatch):
    from quartermaster.operators import joins
    monkeypatch.setattr(joins, "BROADCAST_THRESHOLDS", 5)
    t = spark.range(10).selectExpr("id AS t", "id AS p")
    with pytest.raises(Exception, match="more than 5 thresholds"):
        joins.threshold_lookup(spark.range(3).toDF("v"), "v", t, "t", ["p"]).collect()
    with pytest.raises(ValueError):
        joins.threshold_lookup(spark.range(3).toDF("v"), "v", t, "t", ["p"], strategy="auto")


def test_no_job_runs_while_a_query_is_built(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "building queries")
    try:
        u = spark.createDataFrame([("a", 1, 0)], "email string, attendance_count int, grade int")
        b = spark.createDataFrame([("p", "a")], "id string, writer string")
        c = spark.createDataFrame([("p", "a", False, False)],
                                  "board_id string, user_email string, is_delete_by_user boolean, is_delete_by_admin boolean")
        g = spark.createDataFrame([(1, 0)], "id int, score int")
        activity.update_user_grade(u, activity.user_post_statistics(u, b, c), g)
        assert list(tracker.getJobIdsForGroup("build")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_counts_are_combined_before_any_shuffle_on_the_user(spark):
    """A writer with a third of all posts: the plan counts below the first
    exchange, and what is shuffled is one row per writer and task."""
    import contextlib
    import io
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        boards = spark.range(30_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS writer")
        users = spark.range(100).selectExpr("id AS email")
        comments = spark.range(30_000).selectExpr("id % 50 AS board_id", "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS user_email",
                                                  "false AS is_delete_by_user", "false AS is_delete_by_admin")
        df = activity.user_post_statistics(users, boards, comments)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        lines = buf.getvalue().splitlines()
        shuffles = [i for i, x in enumerate(lines) if "Exchange hashpartitioning(__e" in x or "Exchange hashpartitioning(writer" in x]
        assert shuffles and all(any("functions=[partial" in y or "Range" in y or "functions=[]" in y for y in lines[i + 1:i + 4]) for i in shuffles)
        got = {r.user_email: (r.post_count, r.comment_count) for r in df.collect()}
        assert got[0] == (10_000, 50) and len(got) == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
