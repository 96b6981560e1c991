"""Golden rows for the document jobs (P1-P27) on the hand-written fixtures."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from helpers import FIXTURES, rows
from quartermaster.plans import items as I
from quartermaster.plans import quests as Q
from quartermaster.plans import stations as S
from quartermaster.sources.documents import (ITEM_SCHEMA, MAP_SCHEMA, QUEST_ITEM_SCHEMA,
                                             QUEST_SCHEMA, STATION_SCHEMA, read_documents,
                                             read_enveloped)

AS_OF = dt.datetime(2024, 5, 1)


@pytest.fixture(scope="module")
def sources(spark):
    it = read_documents(spark, os.path.join(FIXTURES, "items.jsonl"), ITEM_SCHEMA)
    mp = read_documents(spark, os.path.join(FIXTURES, "maps.jsonl"), MAP_SCHEMA)
    return {k: v.drop("update_time").cache() for k, v in I.item_sources(it, mp, AS_OF).items()}


def by_id(df):
    return {r["id"]: r.asDict() for r in df.collect()}


def test_weapon(sources):
    w = by_id(sources["weapon"])
    assert set(w) == {"w1", "w2", "w4", "w5", "w6", "w7"}          # image-only rows are not weapons
    assert w["w1"]["image"] == "img/w1-default-2"                   # strip 8, last wins
    assert w["w4"]["image"] == "img/dvl-urbana"                     # strip 7
    assert w["w6"]["image"].endswith("5c98bd7386f7740cfb15654e-512.webp")  # constant override
    assert w["w2"]["short_name"] == "FN SCAR-L" and w["w2"]["image"] == "img/w2"
    assert w["w5"]["category"] == "Grenade launcher" and w["w7"]["category"] == "Handgun"
    assert w["w1"]["modes_kr"] == ["단발", "자동", "점사", "반자동"]
    assert w["w5"]["modes_kr"] == [] and w["w1"]["default_ammo"] == "5.45 PS"


def test_headwear_and_face_cover(sources):
    h = by_id(sources["headwear"])
    assert "hw5" not in h
    assert h["hw1"]["areas_en"] == ["Head, Top of the head", "Head, Back Neck", "Head, Mystery"]
    assert h["hw1"]["areas_kr"] == ["윗머리", "목 뒤쪽", "알 수 없는 부위"]
    assert [h[k]["ricochet_str_en"] for k in ("hw1", "hw2", "hw6", "hw7")] == ["Low", "Medium", "Medium", "High"]
    assert h["hw3"]["ricochet_chance"] == 0.4 and h["hw3"]["ricochet_str_kr"] == "높음"
    assert h["hw4"]["class_value"] is None and h["hw4"]["ricochet_str_en"] is None
    f = by_id(sources["face_cover"])
    assert f["fc1"]["areas_kr"] == ["목 뒤쪽", "얼굴"] and f["fc2"]["areas_en"] is None


def test_zones_rig_glasses(sources):
    assert by_id(sources["armor_vest"])["av1"]["areas_kr"] == ["흉부", "복부"]
    r = by_id(sources["rig"])
    assert r["rig1"]["areas_kr"] == ["흉부"] and r["rig2"]["class_value"] is None
    assert r["rig2"]["capacity"] == 16
    g = by_id(sources["glasses"])
    assert g["gl2"]["durability"] is None and g["gl1"]["blindness_protection"] == 0.2


def test_keys(sources):
    k = by_id(sources["key"])
    assert k["key1"]["map_value"] == ["SHORELINE"]                 # last map wins
    assert k["key6"]["map_value"] == ["N/A"]                       # last map unknown
    assert k["key2"]["map_value"] == ["SHORELINE"]                 # fixed list
    assert k["key3"]["use_map_kr"] == ["해안선"] and k["key4"]["use_map_en"] == ["The Lab"]
    assert k["key5"]["use_map_en"] == ["N/A"]


def test_medical(sources):
    m = by_id(sources["medical"])
    morph = m["md1"]
    assert morph["category"] == "Stimulant" and morph["cures_en"] is None and morph["uses"] is None
    assert [e["type"] for e in json.loads(morph["buff"])] == ["painkillerDuration"]
    assert [e["krSkill"] for e in json.loads(morph["debuff"])] == ["에너지", "수분"]
    assert m["md2"]["painkiller_duration"] == 95 and m["md2"]["cures_kr"] == ["고통 제거"]
    adr = m["md3"]
    assert [(e["skillName"], e["type"]) for e in json.loads(adr["buff"])] == \
        [("Strength", "Skill"), (None, "painkillerDuration")]
    assert [e["type"] for e in json.loads(adr["debuff"])] == ["Skill", "Body temperature"]
    assert json.loads(adr["buff"])[1]["duration"] == 65
    assert m["md5"]["buff"] == "[]" and m["md4"]["buff"] is None


def test_provisions(sources):
    p = by_id(sources["provisions"])
    eff = json.loads(p["pv1"]["stim_effects"])
    assert [e.get("krSkill") for e in eff] == ["손 떨림", None, "진통제"]
    assert [set(e) - {"krSkill"} for e in eff] == [{"delay", "value", "type", "skillName", "duration"}] * 3
    assert ["krSkill" in e for e in eff] == [True, False, True]
    assert eff[-1]["duration"] == 250 and eff[-1]["skillName"] == "Painkiller"
    assert json.loads(p["pv2"]["stim_effects"])[0]["krSkill"] == "신진대사"


def test_loot_and_routing(sources):
    lt = by_id(sources["loot"])
    assert {k: v["category"] for k, v in lt.items()} == {
        "lt1": "Building material", "lt2": "Special equipment", "lt3": "Jewelry",
        "lt4": "Lubricant", "lt7": "Info"}
    assert set(by_id(sources["knife"])) == {"k1"}
    assert set(by_id(sources["backpack"])) == {"bp1"}
    assert json.loads(by_id(sources["container"])["ct1"]["grids"]) == \
        [{"width": 2, "height": 2}, {"width": 1, "height": 3}]


def test_upserts_with_curated_columns(spark):
    it = read_documents(spark, os.path.join(FIXTURES, "items.jsonl"), ITEM_SCHEMA)
    mp = read_documents(spark, os.path.join(FIXTURES, "maps.jsonl"), MAP_SCHEMA)
    targets = {}
    for t, src in I.item_sources(it, mp, AS_OF).items():
        cols = [f"{c.name} {c.dataType.simpleString()}" for c in src.schema if c.name != "pos"]
        targets[t] = spark.createDataFrame([], ", ".join(cols))
    ammo_schema = "id string, name string, short_name string, category string, round string, " \
                  "damage int, penetration_power int, armor_damage int, accuracy_modifier double, " \
                  "recoil_modifier double, light_bleed_modifier double, heavy_bleed_modifier double, " \
                  "image string, update_time timestamp_ntz"
    targets["ammo"] = spark.createDataFrame(
        [("am1", "old", "PS-OLD", "Curated", "5.45", 1, 1, 1, 0.0, 0.0, 0.0, 0.0, "old", None)], ammo_schema)
    out = I.upsert_items(targets, it, mp, AS_OF)
    a = by_id(out["ammo"])
    # Short name kept for an existing row; T6: curated columns kept; values updated
    assert a["am1"]["short_name"] == "PS-OLD" and a["am1"]["category"] == "Curated"
    assert a["am1"]["damage"] == 50 and a["am2"]["short_name"] == "BT" and a["am2"]["category"] is None
    assert a["am1"]["update_time"] == AS_OF
    assert by_id(out["knife"])["k1"]["name"] == "Bayonet v2"      # last in document order
    loot = out["loot"].withColumn("name_kr", F.lit(None).cast("string"))
    qi = read_documents(spark, os.path.join(FIXTURES, "quest_items.jsonl"), QUEST_ITEM_SCHEMA)
    l2 = by_id(Q.upsert_quest_items(loot, qi, AS_OF))
    # The quest-item feed updates its own columns, keeps the first feed's short name
    assert l2["lt1"]["name_en"] == "Bolts (quest)" and l2["lt1"]["short_name"] == "Bolts"
    assert l2["lt1"]["category"] == "Quest items"
    assert l2["qi1"]["short_name"] is None and l2["qi1"]["category"] == "Quest items"


def test_stations(spark):
    st = read_documents(spark, os.path.join(FIXTURES, "stations.jsonl"), STATION_SCHEMA)
    src = S.station_sources(st, AS_OF)
    m = by_id(src["hideout_master"])
    assert m["st1"]["level_ids"] == ["st1-l1", "st1-l2"] and m["st2"]["level_ids"] == []
    assert rows(src["hideout_level"], "id", "level", "construction_time") == \
        [("st1-l1", 1, 0), ("st1-l2", 2, 3600)]
    tr = by_id(src["hideout_trader_require"])
    assert tr["tr2"]["name_en"] is None and tr["tr1"]["image"] == "img/mech"
    assert rows(src["hideout_item_require"], "id", "level_id", "name_en") == [("ir1", "st1-l1", "Bolts")]
    cr = by_id(src["hideout_crafts"])
    assert cr["cr1"]["level_id"] == "st1-1" and cr["cr1"]["name_en"] == "Ammo pack"
    assert cr["cr2"]["level_id"] is None and cr["cr2"]["name_en"] is None
    empty = {t: spark.createDataFrame([], ", ".join(
        f"{c.name} {c.dataType.simpleString()}" for c in s.schema if c.name != "pos"))
        for t, s in src.items()}
    out = S.upsert_stations(empty, st, AS_OF)
    b = rows(out["hideout_bonus"], "level_id", "type", "name_en", "skill_name_en")
    assert b == [("st1-l1", "ExperienceRate", "XP", None),
                 ("st1-l1", "SkillGroupLevelingBoost", "Skill boost later", "Strength")]


def test_quests(spark):
    q = read_documents(spark, os.path.join(FIXTURES, "quests.jsonl"), QUEST_SCHEMA)
    r = by_id(Q.quest_rows(q))
    assert r["q1"]["npc_name"] == "Prapor" and r["q2"]["npc_name"] is None
    assert json.loads(r["q1"]["objectives"])[0]["questItem"] is None
    assert json.loads(r["q2"]["task_requirements"]) == [{"task": {"id": "q1", "name": "Debut"}}]


def test_enveloped_read(spark, tmp_path):
    p = tmp_path / "env.json"
    p.write_text(json.dumps({"data": {"items": [{"id": "a", "name": "A"}, {"id": "b", "name": "B"}]}}))
    df = read_enveloped(spark, str(p), "items", "pos int, id string, name string")
    assert rows(df, "pos", "id") == [(0, "a"), (1, "b")]


def test_staged_routing_matches_cached(spark, tmp_path):
    it = read_documents(spark, os.path.join(FIXTURES, "items.jsonl"), ITEM_SCHEMA)
    mp = read_documents(spark, os.path.join(FIXTURES, "maps.jsonl"), MAP_SCHEMA)
    cached = I.item_sources(it, mp, AS_OF)
    staged = I.item_sources(it, mp, AS_OF, stage_dir=str(tmp_path / "routed"))
    for t in cached:
        assert rows(cached[t].drop("update_time")) == rows(staged[t].drop("update_time")), t
    assert sorted(p.name for p in (tmp_path / "routed").iterdir() if p.name.startswith("route=")) \
        == sorted(f"route={r}" for r in {"Gun", "Gun image", "Headphones", "Headwear", "Provisions", "Key",
                                          "Meds", "Loot", "Face Cover", "Arm Band", "Vis. observ. device",
                                          "Knife", "Armor", "Backpack", "Common container", "Chest rig", "Ammo"})


def test_malformed_bags_fail_the_job(spark):
    from quartermaster.sources.documents import decode_variant
    ok = spark.createDataFrame([('{"uses": 2}',), ("{}",), ("null",), (None,)], "p string")
    assert [r[0] for r in ok.select(decode_variant("p", "uses int")["uses"]).collect()] == [2, None, None, None]
    for bad in ('{"uses": 2.5}', '{"uses": "x"}', '{"uses": 1'):
        with pytest.raises(Exception):
            spark.createDataFrame([(bad,)], "p string").select(decode_variant("p", "uses int")).collect()


def test_malformed_lines_fail_the_job(spark, tmp_path):
    from quartermaster.sources.documents import MAP_SCHEMA, read_documents
    (tmp_path / "m.jsonl").write_text('{"pos": 3000000000, "name": "x", "locks": []}\n', encoding="utf-8")
    assert [tuple(r) for r in read_documents(spark, str(tmp_path / "m.jsonl"), MAP_SCHEMA).select("pos", "name").collect()] == [(3_000_000_000, "x")]
    (tmp_path / "bad.jsonl").write_text('{"pos": "one"}\n{"pos"\n', encoding="utf-8")
    with pytest.raises(Exception):
        read_documents(spark, str(tmp_path / "bad.jsonl"), MAP_SCHEMA).collect()


def test_image_candidates_are_read_once(spark):
    import contextlib
    import io
    from quartermaster.operators.lookup import lookup_first
    path = "/root/testdata/sf0.001/part.parquet"
    c = spark.read.parquet(path)
    df = spark.createDataFrame([("a", "own")], "k string, own string")
    out = lookup_first(df, "k", c, "p_name", "p_type", [8, 7, 6], "image", order="p_partkey", own="own")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain()
    assert buf.getvalue().count("FileScan parquet") == 1


def test_a_match_without_an_image_gives_null(spark):
    from quartermaster.operators.lookup import lookup_first
    c = spark.createDataFrame([("gun Default", None, 1), ("pistol Default", "old", 1), ("pistol Default", None, 2)], "n string, i string, pos int")
    df = spark.createDataFrame([("gun", "own"), ("pistol", "own"), ("none", "own")], "k string, own string")
    got = rows(lookup_first(df, "k", c, "n", "i", [8, 7, 6], "image", order="pos", own="own"), "k", "image")
    assert got == sorted([("gun", None), ("none", "own"), ("pistol", None)], key=repr)
