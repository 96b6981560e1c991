import contextlib
import datetime as dt
import io

from pyspark.sql import functions as F

from helpers import rows
from quartermaster.functions import vocab as V
from quartermaster.functions.effects import effect, split_effects
from quartermaster.functions.labels import (bucket, label_value, normalise_element, relabel_array,
                                            substring_rules)
from quartermaster.functions.predicates import bag_empty, bag_nonempty
from quartermaster.functions.scalars import composite_text, drop_last_chars, falsy_to_null, json_text
from quartermaster.functions.windows import reporting_window, window_bounds
from quartermaster.operators.snapshot import (read_snapshot, retain, snapshot, verify_snapshot)


def test_bag_predicates(spark):
    df = spark.createDataFrame([("{}",), ('{"class":null}',), (None,), ('{"a":1}',)], "p string")
    got = df.select("p", bag_nonempty("p").alias("ne"), bag_empty("p").alias("em")).collect()
    assert [(r.ne, r.em) for r in got] == [(False, True), (True, False), (True, False), (True, False)]


def test_bucket_null_guard(spark):
    df = spark.createDataFrame([(0.19,), (0.2,), (0.39,), (0.4,), (None,)], "r double")
    got = [r[0] for r in df.select(bucket("r", V.RICOCHET_BOUNDS, V.RICOCHET_EN)).collect()]
    assert got == ["Low", "Medium", "Medium", "High", None]


def test_relabel_policies(spark):
    df = spark.createDataFrame([(["Head, Neck", "Head, Ears", "Odd"],), (None,)], "z array<string>")
    z = normalise_element("z", *V.HEAD_ZONE_RENAME)
    got = df.select(relabel_array(z, V.HEAD_ZONES_KR, "default", "?").alias("d"),
                    relabel_array("z", V.ARMOR_ZONES_KR, "drop").alias("x"),
                    relabel_array("z", {"Odd": "O"}, "passthrough").alias("p")).collect()
    assert got[0].d == ["목 뒤쪽", "귀", "?"]
    assert got[0].x == ["머리 - 목 뒤쪽"]
    assert got[0].p == ["Head, Neck", "Head, Ears", "O"]
    assert got[1].d is None and got[1].x is None


def test_substring_rules_and_labels(spark):
    df = spark.createDataFrame([(["Burst Fire, Semi-auto", "Laser"], "Vaseline balm")],
                               "m array<string>, n string")
    r = df.select(substring_rules("m", V.FIRE_MODES_KR).alias("k"),
                  label_value("n", V.PAINKILLER_DURATION, default=None).alias("d")).first()
    assert r.k == ["점사", "반자동"] and r.d == 350


def test_scalars(spark):
    df = spark.createDataFrame([("AK-74 Default", None, ""), ("abc", 3, "x")], "s string, n int, e string")
    got = df.select(drop_last_chars("s", 8).alias("d"), composite_text("n", "s").alias("k"),
                    composite_text("n", "s", null_text="None").alias("kn"),
                    falsy_to_null("e").alias("f")).collect()
    assert [tuple(r) for r in got] == [("AK-74", None, "None-AK-74 Default", None), ("", "3-abc", "3-abc", "x")]


def test_json_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert df.select(json_text(F.struct("a", "b"))).first()[0] == '{"a":1,"b":null}'


def test_effect_split_disjoint(spark):
    effs = [effect(type="Body temperature", value=-1.0), effect(type="Pain"),
            effect(type="Skill", skillName="Health", value=0.0),
            effect(type="Skill", skillName="Memory", value=5.0),
            effect(type="painkillerDuration", duration=10), effect(type="Weight limit", value=-2.0)]
    df = spark.range(1).select(F.array(*effs).alias("e"))
    r = df.select(split_effects("e", "buff")["type"].alias("b"),
                  split_effects("e", "debuff")["type"].alias("d")).first()
    assert r.b == ["Body temperature", "painkillerDuration"]
    assert r.d == ["Pain", "Weight limit"]


def test_windows():
    assert window_bounds(dt.date(2024, 3, 15), "prev_month") == (dt.date(2024, 2, 1), dt.date(2024, 2, 29))
    assert window_bounds(dt.date(2024, 1, 30), "trailing") == (dt.date(2024, 1, 11), dt.date(2024, 1, 16))
    assert window_bounds(dt.date(2024, 1, 12), "interval", start=dt.date(2024, 1, 5)) == \
        (dt.date(2024, 1, 5), dt.date(2024, 1, 11))


def test_reporting_window_pushdown(spark, tmp_path):
    p = str(tmp_path / "ev")
    spark.createDataFrame([(1, dt.datetime(2024, 1, 31, 23)), (2, dt.datetime(2024, 2, 1))],
                          "id int, ts timestamp_ntz").write.parquet(p)
    df = reporting_window(spark.read.parquet(p), "ts", dt.date(2024, 2, 10), "prev_month")
    assert rows(df, "id") == [(1,)]
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in buf.getvalue()


def test_snapshot_roundtrip_and_retention(spark, tmp_path):
    root = str(tmp_path / "snap")
    n = spark.createDataFrame([(i,) for i in range(5)], "k int")
    for days in (5, 4, 3, 0):
        snapshot({"nation": n}, root, dt.date(2024, 1, 15) - dt.timedelta(days=days))
    snapshot({"nation": n}, root, dt.date(2024, 1, 15))  # rerun of the day is idempotent
    assert verify_snapshot(spark, root, "nation", n, dt.date(2024, 1, 15))
    assert read_snapshot(spark, root, "nation", dt.date(2024, 1, 15)).count() == 5
    all_ = spark.read.parquet(f"{root}/nation")
    kept = retain(all_, 4, dt.date(2024, 1, 15)).select(F.col("snapshot_date").cast("string")).distinct()
    assert rows(kept) == [("2024-01-11",), ("2024-01-12",), ("2024-01-15",)]


def test_observed_routing_and_labels(spark):
    from pyspark.sql import Observation
    from quartermaster.functions.labels import label
    from quartermaster.operators.routing import Fields, category_is, route
    df = spark.createDataFrame(
        [("a", ("Knife", ("Melee",))), ("b", None), ("c", ("Other", None))],
        "name string, category struct<name:string, parent:struct<name:string>>")
    obs = Observation("routing")
    out = route(df, {"Knife": category_is(Fields(), "Knife")}, observation=obs)
    assert rows(out, "name", "route") == [("a", "Knife")]
    assert obs.get == {"rows": 3, "unrouted": 2, "null_category": 2}
    lk = spark.createDataFrame([("Knife", "칼")], "k string, v string")
    obs2 = Observation("labels")
    lab = label(df.select("name", F.col("category.name").alias("c")), "c", lk, "k", "v", "kr",
                observation=obs2)
    assert rows(lab, "name", "kr") == [("a", "칼"), ("b", None), ("c", "Other")]
    assert obs2.get == {"rows": 3, "unmatched": 1}


def test_read_lookup(spark, tmp_path):
    from quartermaster.functions.labels import label
    from quartermaster.sources.tables import read_lookup
    p = tmp_path / "lk.csv"
    p.write_text("k,v\nThorax,흉부\nStomach,복부\n", encoding="utf-8")
    lk = read_lookup(spark, str(p), "k string, v string")
    assert rows(lk) == [("Stomach", "복부"), ("Thorax", "흉부")]
    # L3 / L7 shapes from files: an array value with an empty default, an int value with 0
    q = str(tmp_path / "arrays")
    spark.createDataFrame([("a", [1, 2]), ("b", [3])], "k string, v array<int>").write.parquet(q)
    arrays = read_lookup(spark, q, "k string, v array<int>", "parquet")
    df = spark.createDataFrame([("a",), ("z",), (None,)], "k2 string")
    assert rows(label(df, "k2", arrays, "k", "v", "out", default=[])) == [("a", [1, 2]), ("z", []), (None, [])]
    bad = tmp_path / "bad.csv"
    bad.write_text("k,v\nx,notanumber\n", encoding="utf-8")
    import pytest
    with pytest.raises(Exception):
        read_lookup(spark, str(bad), "k string, v int").collect()


def test_repeated_dictionary_keys(spark):
    import pytest
    from quartermaster.functions.labels import label
    df = spark.createDataFrame([("a",)], "k2 string")
    lk = spark.createDataFrame([("a", "z", 0), ("a", "b", 1)], "k string, v string, pos int")
    assert rows(label(df, "k2", lk, "k", "v", "out", order="pos")) == [("a", "b")]
    with pytest.raises(Exception, match="repeated dictionary key"):
        label(df, "k2", lk, "k", "v", "out").collect()
