"""Property tests on generated rows."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import rows
from quartermaster.functions.effects import effect, split_effects
from quartermaster.functions import vocab as V
from quartermaster.operators import activity
from quartermaster.operators.deletes import deleted_where, delete_where, expired

AS_OF = dt.datetime(2024, 1, 15)
day = st.one_of(st.none(), st.integers(1, 30).map(lambda d: dt.datetime(2024, 1, d)))


@settings(max_examples=10, deadline=None)
@given(ends=st.lists(day, max_size=30))
def test_delete_and_deleted_partition_the_input(spark, ends):
    df = spark.createDataFrame(list(enumerate(ends)), "id int, end timestamp_ntz")
    kept = delete_where(df, expired("end", AS_OF))
    gone = deleted_where(df, expired("end", AS_OF))
    assert sorted(rows(kept) + rows(gone), key=repr) == rows(df)
    assert not set(rows(kept)) & set(rows(gone))


@settings(max_examples=8, deadline=None)
@given(users=st.lists(st.sampled_from("abcdefgh"), min_size=1, max_size=8, unique=True),
       posts=st.lists(st.tuples(st.sampled_from("abcdefghz"), st.integers(0, 5)), max_size=20),
       comments=st.lists(st.tuples(st.integers(0, 7), st.sampled_from("abcdz"),
                                   st.sampled_from([True, False, None])), max_size=30))
def test_every_user_once_in_statistics(spark, users, posts, comments):
    u = spark.createDataFrame([(x, 1, 0) for x in users], "email string, attendance_count int, grade int")
    b = spark.createDataFrame([(f"p{i}", w, "t", n) for i, (w, n) in enumerate(posts)],
                              "id string, writer string, type string, like_count int")
    c = spark.createDataFrame([(f"p{i}", who, f, False) for i, who, f in comments],
                              "board_id string, user_email string, is_delete_by_user boolean, "
                              "is_delete_by_admin boolean")
    s = activity.user_post_statistics(u, b, c)
    got = {r.user_email: (r.post_count, r.comment_count) for r in s.collect()}
    assert sorted(got) == sorted(users) and s.count() == len(users)
    post_ids = {f"p{i}" for i in range(len(posts))}
    for x in users:
        want_posts = sum(1 for w, _ in posts if w == x)
        want_boards = len({f"p{i}" for i, who, f in comments if who == x and f is False} & post_ids)
        assert got[x] == (want_posts, want_boards)


effect_st = st.tuples(
    st.sampled_from(V.ALWAYS_BUFF + V.ALWAYS_DEBUFF + V.SIGNED_TYPES +
                    [V.INVERTED_TYPE, V.DURATION_TYPE, "Skill", "Unknown"]),
    st.sampled_from(V.SIGNED_SKILLS + ["Memory", None]),
    st.one_of(st.none(), st.floats(-5, 5, allow_nan=False)),
    st.one_of(st.none(), st.integers(-5, 5)))


@settings(max_examples=10, deadline=None)
@given(effs=st.lists(effect_st, max_size=12))
def test_buffs_and_debuffs_are_disjoint(spark, effs):
    arr = F.array(*[effect(type=t, skillName=s, value=v, duration=d) for t, s, v, d in effs]) \
        if effs else F.array().cast("array<struct<delay:int,value:double,type:string,skillName:string,"
                                    "duration:int,chance:double,krSkill:string>>")
    r = spark.range(1).select(F.posexplode(arr).alias("i", "e")).select(
        "i", F.size(split_effects(F.array("e"), "buff")).alias("b"),
        F.size(split_effects(F.array("e"), "debuff")).alias("d")).collect()
    assert all(not (x.b and x.d) for x in r)
