import datetime as dt
import os
import shutil

from helpers import FIXTURES, rows
from quartermaster.operators.index import publish_all, read_published
from quartermaster.plans import community as C
from quartermaster.plans.items import knife_rows
from quartermaster.sources.documents import ITEM_SCHEMA
from quartermaster.streaming.landed import merge_landed


def test_community_jobs(spark, tmp_path):
    root = str(tmp_path / "db")
    T = lambda data, schema: spark.createDataFrame(data, schema)
    publish_all({
        "user": T([("a", 10, 0), ("b", 1, 0)], "email string, attendance_count int, grade int"),
        "user_post_statistics": T([], "user_email string, post_count bigint, comment_count bigint"),
        "user_grade": T([(1, 0), (2, 60)], "id int, score int"),
        "board_union": T([("p1", "a", "t", 12, None), ("p2", "b", "t", 3, None)],
                             "id string, writer string, type string, like_count int, create_time timestamp_ntz"),
        "comments": T([("p1", "b", False, False)],
                          "board_id string, user_email string, is_delete_by_user boolean, is_delete_by_admin boolean"),
        "board_issue": T([("p2", "t", None)], "board_id string, board_type string, create_time timestamp_ntz"),
        "user_ban": T([(dt.datetime(2024, 1, 1),), (None,)], "ban_end_time timestamp_ntz"),
        "user_delete": T([("a", dt.datetime(2024, 1, 1))], "email string, delete_end_time timestamp_ntz"),
        "user_icon": T([("a", 1), ("b", 2)], "user_email string, icon int"),
        "user_quest": T([("a", 1)], "user_email string, quest int"),
    }, root, version="000")
    C.issue_job(spark, root)
    assert rows(read_published(spark, root, "board_issue"), "board_id") == [("p1",)]
    C.statistics_and_grades_job(spark, root)
    assert rows(read_published(spark, root, "user")) == [("a", 10, 2), ("b", 1, 1)]
    C.expiry_job(spark, root, dt.datetime(2024, 1, 15))
    assert read_published(spark, root, "user_ban").count() == 1
    assert rows(read_published(spark, root, "user_icon"), "icon") == [(2,)]
    assert read_published(spark, root, "user_quest").count() == 0
    ok = C.snapshot_job(spark, root, str(tmp_path / "snap"), ["user"], dt.date(2024, 1, 15))
    assert ok


def test_streaming_merge(spark, tmp_path):
    root = str(tmp_path / "db")
    landing = tmp_path / "landing"
    landing.mkdir()
    publish_all({"knife": spark.createDataFrame(
        [], "id string, name string, short_name string, image string, category string, "
            "slash_damage int, stab_damage int, hit_radius double")}, root, version="a0")
    shutil.copy(os.path.join(FIXTURES, "items.jsonl"), landing / "batch1.jsonl")
    from quartermaster.operators.routing import catalogue_rules, route

    def build(batch):
        return knife_rows(route(batch, catalogue_rules(only=["Knife"])).drop("route"))

    merge_landed(spark, str(landing), ITEM_SCHEMA, root, "knife", "id",
                 ["name", "short_name", "image", "category", "slash_damage", "stab_damage", "hit_radius"],
                 build, str(tmp_path / "ckpt"))
    assert rows(read_published(spark, root, "knife"), "id", "name") == [("k1", "Bayonet v2")]


def test_streaming_merge_bucketed(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    shutil.copy(os.path.join(FIXTURES, "items.jsonl"), landing / "batch1.jsonl")
    from quartermaster.operators.routing import catalogue_rules, route

    def build(batch):
        return knife_rows(route(batch, catalogue_rules(only=["Knife"])).drop("route"))

    cols = ["name", "short_name", "image", "category", "slash_damage", "stab_damage", "hit_radius"]
    schema = ("id string, name string, short_name string, image string, category string, "
              "slash_damage int, stab_damage int, hit_radius double")
    root = str(tmp_path / "db")
    merge_landed(spark, str(landing), ITEM_SCHEMA, root, "knife", "id", cols, build,
                 str(tmp_path / "ckpt"), buckets=4, target_schema=schema)
    from quartermaster.operators.bucketed import read_bucketed
    t = read_bucketed(spark, f"{root}/knife")
    assert rows(t, "id", "name") == [("k1", "Bayonet v2")]


def test_retention_runs_behind_the_gate(spark, tmp_path, monkeypatch):
    root, snap = str(tmp_path / "db"), str(tmp_path / "snap")
    publish_all({"t": spark.createDataFrame([(1,)], "x int")}, root, version="a")
    days = lambda: sorted(x.split("=")[1] for x in os.listdir(f"{snap}/t") if x.startswith("snapshot_date="))
    for d in (1, 2, 3, 5):
        assert C.snapshot_job(spark, root, snap, ["t"], dt.date(2024, 1, d))
    assert days() == ["2024-01-02", "2024-01-03", "2024-01-05"]
    monkeypatch.setattr(C, "verify_snapshot", lambda *a: False)
    assert not C.snapshot_job(spark, root, snap, ["t"], dt.date(2024, 1, 20))
    assert days() == ["2024-01-02", "2024-01-03", "2024-01-05", "2024-01-20"]


def test_a_retried_version_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "db")
    one, two = (spark.createDataFrame([(x,)], "x int") for x in (1, 2))
    first = publish_all({"t": one}, root, version="b1")
    assert publish_all({"t": two}, root, version="b1") == first
    assert rows(read_published(spark, root, "t")) == [(1,)]
    # an attempt that died before its commit is written over
    two.write.parquet(f"{root}/t/v=b2")
    publish_all({"t": one}, root, version="b2")
    assert rows(read_published(spark, root, "t")) == [(1,)]


def test_streaming_order_over_files(spark, tmp_path):
    """Two files in one batch with the same positions: the later file wins."""
    root, landing = str(tmp_path / "db"), tmp_path / "landing"
    landing.mkdir()
    publish_all({"t": spark.createDataFrame([], "id string, v string")}, root, version="a0")
    for name, v, at in (("b.jsonl", "old", 1_700_000_000), ("a.jsonl", "new", 1_700_000_100)):
        (landing / name).write_text(f'{{"pos": 1, "id": "k", "v": "{v}"}}\n', encoding="utf-8")
        os.utime(landing / name, (at, at))
    merge_landed(spark, str(landing), "pos bigint, id string, v string", root, "t", "id", ["v"], lambda b: b, str(tmp_path / "ckpt"))
    assert rows(read_published(spark, root, "t"), "id", "v") == [("k", "new")]


def test_statistics_are_read_back_not_computed_twice(spark, tmp_path, monkeypatch):
    root, calls = str(tmp_path / "db"), []
    publish_all({"user": spark.createDataFrame([("a", 10, 0)], "email string, attendance_count int, grade int"),
                 "user_post_statistics": spark.createDataFrame([], "user_email string, post_count bigint, comment_count bigint"),
                 "user_grade": spark.createDataFrame([(1, 0)], "id int, score int"),
                 "board_union": spark.createDataFrame([("p", "a")], "id string, writer string"),
                 "comments": spark.createDataFrame([], "board_id string, user_email string, is_delete_by_user boolean, is_delete_by_admin boolean")},
                root, version="0")
    own = C.activity.update_user_grade

    def seen(users, stats, grades, **kw):
        calls.append(stats.inputFiles())
        return own(users, stats, grades, **kw)

    monkeypatch.setattr(C.activity, "update_user_grade", seen)
    C.statistics_and_grades_job(spark, root)
    assert len(calls) == 1 and all("user_post_statistics" in f for f in calls[0]) and calls[0]
    assert rows(read_published(spark, root, "user")) == [("a", 10, 1)]


def test_index_reads_each_table_once():
    seen = []
    branches = C.index_branches(lambda name: seen.append(name))
    assert len(seen) == len(set(seen)) == len(branches) and sum(len(b.emits) for b in branches) == 25


def test_expired_keys_are_written_once(spark):
    from quartermaster.operators.deletes import cascade_delete
    p = spark.createDataFrame([("a", dt.datetime(2024, 1, 1)), ("b", None)], "email string, e timestamp_ntz")
    kids = {n: (spark.createDataFrame([("a", 1), ("b", 2)], "u string, x int"), "u") for n in ("one", "two")}
    out = cascade_delete(p, "email", "e", dt.datetime(2024, 2, 1), kids)
    for n in kids:
        assert rows(out[n]) == [("b", 2)]
        assert "ExistingRDD" in out[n]._jdf.queryExecution().executedPlan().toString()


def test_checkpoint_folder_must_be_named_on_a_cluster(spark, monkeypatch):
    import pytest
    from quartermaster import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:  # noqa: N801
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
    assert session.ensure_checkpoint_dir(spark)


def test_gate_sees_a_changed_row(spark, tmp_path):
    from quartermaster.operators.snapshot import snapshot, table_digest, verify_snapshot
    schema = "a string, b string, n double, xs array<string>, m map<string,int>, s struct<p:int,q:int>"
    base = [("x", None, 1.5, ["u", None], {"k": 1}, (1, None)), (None, "x", None, [], None, (None, 1)), ("y", "z", 2.0, None, {}, None)]
    T = lambda data: spark.createDataFrame(data, schema)
    day, root = dt.date(2024, 1, 15), str(tmp_path / "s")
    snapshot({"t": T(base)}, root, day)
    assert verify_snapshot(spark, root, "t", T(base[::-1]).select("s", "m", "xs", "n", "b", "a"), day)
    for other in ([base[0], ("x", None, None, [], None, (None, 1)), base[2]],       # a value in the other column
                  [base[0], base[1], ("y", "z", 2.5, None, {}, None)],               # a changed value
                  [base[0], base[1], ("y", "z", 2.0, [], {}, None)],                 # an empty list for none
                  [("x", None, 1.5, [None, "u"], {"k": 1}, (1, None)), *base[1:]],   # another order in a list
                  [("x", None, 1.5, ["u", None], {"k": 1}, (None, 1)), *base[1:]],   # a nested value in the other field
                  base[:2], [*base, base[0]], [base[0], base[0], base[2]]):
        assert not verify_snapshot(spark, root, "t", T(other), day), other
    assert table_digest(T([])) == (0, 0, 0)


def test_snapshot_job_keeps_old_days_when_a_row_changed(spark, tmp_path, monkeypatch):
    root, snap = str(tmp_path / "db"), str(tmp_path / "snap")
    publish_all({"t": spark.createDataFrame([(1,), (2,)], "x int")}, root, version="a")
    assert C.snapshot_job(spark, root, snap, ["t"], dt.date(2024, 1, 1))
    own = C.snapshot
    # the copy loses one row's value on the way
    monkeypatch.setattr(C, "snapshot", lambda frames, *a: own({k: f.selectExpr("nullif(x, 2) AS x") for k, f in frames.items()}, *a))
    assert not C.snapshot_job(spark, root, snap, ["t"], dt.date(2024, 1, 20))
    assert sorted(x for x in os.listdir(f"{snap}/t") if "=" in x) == ["snapshot_date=2024-01-01", "snapshot_date=2024-01-20"]
