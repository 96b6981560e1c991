"""More checks on the provided tables: whole jobs and whole rows, load time
included. Registered beside those of :mod:`quartermaster.plans.catalog`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermaster.functions import vocab as V
from quartermaster.plans import community, items, quests
from quartermaster.plans.catalog import AS_OF, _station_sources, read_table, register
from quartermaster.sources.documents import ITEM_SCHEMA, QUEST_ITEM_SCHEMA

_AT = "TIMESTAMP '2024-01-15 00:00:00' AS update_time"


# ------------------------------------------------ gear documents from ``part``

#: kind = p_partkey % 7 -> category name
_GEAR = ["Throwable weapon", "Backpack", "Common container", "Chest rig", "Face Cover", "Arm Band", "Vis. observ. device"]


def part_gear(spark, d) -> DataFrame:
    """Item documents from ``part``, one of seven kinds by key: bags filled
    from the part's own columns, some without a class, some ``{}`` or null."""
    p = read_table(spark, d, "part", spread=True)
    kind = F.col("p_partkey") % 7
    size = F.col("p_size")
    grids = F.struct(F.array(F.struct((size % 4 + 1).alias("width"), F.lit(2).alias("height"))).alias("grids"), size.alias("capacity"))
    classed = F.when(size % 2 == 0, (size % 6).cast("int"))
    bags = [
        F.to_json(F.struct((size / 10).alias("fuse"), (size % 5).alias("minExplosionDistance"),
                           (size % 5 + 2).alias("maxExplosionDistance"), (size * 3).alias("fragments"))),
        F.to_json(grids), F.to_json(grids),
        F.to_json(F.struct(classed.alias("class"), F.array(F.lit("Thorax"), F.lit("Elbow")).alias("zones"), size.alias("capacity")),
                  {"ignoreNullFields": "false"}),
        F.when(size % 10 == 0, F.lit(None)).when(size % 10 == 1, F.lit("{}")).otherwise(F.to_json(F.struct(
            (size % 6).alias("class"), F.array(F.lit("Head, Neck"), F.lit("Head, Tail")).alias("headZones"),
            F.when(size % 3 > 0, size / 100).alias("ricochetY")))),
        F.lit("{}"),
        F.to_json(F.struct(classed.alias("class"), size.alias("durability"), (size / 100).alias("blindnessProtection")),
                  {"ignoreNullFields": "false"}),
    ]
    props, category = F.lit(None).cast("string"), F.lit(None).cast("string")
    for k, (bag, name) in enumerate(zip(bags, _GEAR)):
        props = F.when(kind == k, bag).otherwise(props)
        category = F.when(kind == k, F.lit(name)).otherwise(category)
    doc = F.struct(F.col("p_partkey").alias("pos"), F.concat(F.lit("g"), F.col("p_partkey").cast("string")).alias("id"),
                   F.col("p_name").alias("name"), (F.col("p_retailprice") / 100).alias("weight"),
                   F.col("p_brand").alias("shortName"), F.concat(F.lit("/img/"), F.col("p_type")).alias("image512pxLink"),
                   F.struct(category.alias("name"), F.struct(F.lit("Equipment").alias("name")).alias("parent")).alias("category"),
                   props.alias("properties"))
    return p.select(F.to_json(doc).alias("j")).select(F.from_json("j", ITEM_SCHEMA, {"mode": "FAILFAST"}).alias("d")).select("d.*")


def _gear(spark, d, table):
    maps = spark.createDataFrame([], "pos bigint, name string, locks array<struct<key:struct<name:string>>>")
    return items.item_sources(part_gear(spark, d), maps, AS_OF, only=[table])[table].drop("pos")


def _gear_sql(kind, columns, where="TRUE", name="name", weight=True):
    return f"""
SELECT 'g' || CAST(p_partkey AS VARCHAR) AS id, p_name AS {name}, p_brand AS short_name,
       {"p_retailprice / 100 AS weight," if weight else ""} '/img/' || p_type AS image, {_AT}{"," if columns else ""}
       {columns}
FROM part WHERE p_partkey % 7 = {kind} AND {where}"""


_GRIDS_SQL = "'[{\"width\":' || CAST(p_size % 4 + 1 AS VARCHAR) || ',\"height\":2}]' AS grids, p_size AS capacity"


@register("catalogue_throwable", _gear_sql(0, """'Throwable weapon' AS category, p_size / 10 AS fuse,
       CAST(p_size % 5 AS DOUBLE) AS min_explosion_distance, CAST(p_size % 5 + 2 AS DOUBLE) AS max_explosion_distance,
       p_size * 3 AS fragments""", weight=False))
def q_throwable(spark, d):
    """P3."""
    return _gear(spark, d, "throwable").select(
        "id", "name", "short_name", "image", "update_time", "category", "fuse", F.col("min_explosion_distance").cast("double"),
        F.col("max_explosion_distance").cast("double"), "fragments")


@register("catalogue_backpack", _gear_sql(1, _GRIDS_SQL))
def q_backpack(spark, d):
    """Grids as JSON text."""
    return _gear(spark, d, "backpack")


@register("catalogue_container", _gear_sql(2, _GRIDS_SQL, name="name_en", weight=False))
def q_container(spark, d):
    """P8."""
    return _gear(spark, d, "container")


@register("catalogue_rig", _gear_sql(3, f"""CASE WHEN p_size % 2 = 0 THEN CAST(p_size % 6 AS INTEGER) END AS class_value,
       CASE WHEN p_size % 2 = 0 THEN 'Thorax|Elbow' END AS areas_en,
       CASE WHEN p_size % 2 = 0 THEN '{V.ARMOR_ZONES_KR["Thorax"]}' END AS areas_kr, p_size AS capacity"""))
def q_rig(spark, d):
    """P10: class, zones and labels only when the class is present."""
    r = _gear(spark, d, "rig")
    return r.withColumns({c: F.array_join(c, "|") for c in ("areas_en", "areas_kr")})


_FACE = "p_size % 10 > 1"


@register("catalogue_face_cover", _gear_sql(4, f"""CASE WHEN {_FACE} THEN CAST(p_size % 6 AS INTEGER) END AS class_value,
       CASE WHEN {_FACE} THEN 'Head, Back Neck|Head, Tail' END AS areas_en,
       CASE WHEN {_FACE} THEN '{V.HEAD_ZONES_KR["Head, Back Neck"]}|{V.HEAD_ZONE_UNKNOWN_KR}' END AS areas_kr,
       CASE WHEN {_FACE} AND p_size % 3 > 0 THEN p_size / 100 END AS ricochet_chance,
       CASE WHEN {_FACE} AND p_size % 3 > 0 THEN CASE WHEN p_size < 20 THEN 'Low' WHEN p_size < 40 THEN 'Medium' ELSE 'High' END END AS ricochet_str_en,
       CASE WHEN {_FACE} AND p_size % 3 > 0 THEN CASE WHEN p_size < 20 THEN '낮음' WHEN p_size < 40 THEN '중간' ELSE '높음' END END AS ricochet_str_kr"""))
def q_face_cover(spark, d):
    """Zones renamed and labelled, no ricochet without a value, NULL for
    a null or empty bag."""
    r = _gear(spark, d, "face_cover")
    return r.withColumns({c: F.array_join(c, "|") for c in ("areas_en", "areas_kr")})


@register("catalogue_arm_band", _gear_sql(5, ""))
def q_arm_band(spark, d):
    """P16."""
    return _gear(spark, d, "arm_band")


@register("catalogue_glasses", _gear_sql(6, """CASE WHEN p_size % 2 = 0 THEN CAST(p_size % 6 AS INTEGER) END AS class_value,
       CASE WHEN p_size % 2 = 0 THEN p_size END AS durability,
       CASE WHEN p_size % 2 = 0 THEN p_size / 100 END AS blindness_protection""", weight=False))
def q_glasses(spark, d):
    """Attributes only with a class."""
    return _gear(spark, d, "glasses")


# --------------------------------------------------------- stations (orders)

@register("stations_level", f"""
SELECT CAST(o_orderkey AS VARCHAR) || '-' || CAST(k AS VARCHAR) AS id, k AS level,
       CAST(o_custkey * k AS INTEGER) AS construction_time, {_AT}
FROM orders, (VALUES (1), (2)) AS t(k)
""")
def q_stations_level(spark, d):
    """P19 (N1)."""
    return _station_sources(spark, d, "hideout_level").drop("pos")


@register("stations_item_require", f"""
WITH r AS (
  SELECT o_orderkey, '-1' AS l, '-1-a' AS i, o_orderpriority AS name_en, 1 AS quantity, 1 AS count FROM orders
  UNION ALL SELECT o_orderkey, '-2', '-2-a', o_orderpriority, 2, 1 FROM orders WHERE o_orderstatus <> 'F'
  UNION ALL SELECT o_orderkey, '-2', '-2-b', o_orderstatus, 2, 2 FROM orders WHERE o_orderstatus <> 'F')
SELECT CAST(o_orderkey AS VARCHAR) || i AS id, CAST(o_orderkey AS VARCHAR) || l AS level_id, name_en, quantity, count,
       CAST(NULL AS VARCHAR) AS image, {_AT} FROM r
""")
def q_stations_item_require(spark, d):
    """P20 (N2)."""
    return _station_sources(spark, d, "hideout_item_require").drop("pos")


@register("stations_station_require", f"""
SELECT CAST(o_orderkey AS VARCHAR) || '-n' || CAST(i AS VARCHAR) AS id, CAST(o_orderkey AS VARCHAR) || '-2' AS level_id,
       CAST(o_custkey % 3 + i AS INTEGER) AS level,
       CASE WHEN o_orderstatus <> 'F' THEN 'station ' || CAST(o_custkey + i AS VARCHAR) END AS name_en,
       CASE WHEN o_orderstatus <> 'F' THEN '/station' END AS image, {_AT}
FROM orders, (VALUES (0), (1)) AS t(i)
""")
def q_stations_station_require(spark, d):
    """P22 (N2, C2: a NULL station gives NULLs)."""
    return _station_sources(spark, d, "hideout_station_require").drop("pos")


@register("stations_skill_require", f"""
SELECT CAST(o_orderkey AS VARCHAR) || '-s' AS id, CAST(o_orderkey AS VARCHAR) || '-1' AS level_id,
       CAST(o_custkey % 5 AS INTEGER) AS level, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS name_en, {_AT}
FROM orders
""")
def q_stations_skill_require(spark, d):
    """P23 (N2)."""
    return _station_sources(spark, d, "hideout_skill_require").drop("pos")


# ------------------------------------------------------ quest items

@register("quest_items_upsert", f"""
WITH t AS (SELECT 'p' || CAST(p_partkey AS VARCHAR) AS id, p_name AS name_en, p_brand AS short_name, '/old' AS image,
                  'Tools' AS category, 'curated ' || p_brand AS name_kr, TIMESTAMP '2023-01-01 00:00:00' AS at FROM part),
s AS (SELECT 'p' || CAST(c_custkey // 2 * 3 AS VARCHAR) AS id, arg_max(c_name, c_custkey) AS name_en,
             arg_max('/quest/' || c_mktsegment, c_custkey) AS image FROM customer GROUP BY 1)
SELECT COALESCE(t.id, s.id) AS id, COALESCE(s.name_en, t.name_en) AS name_en, t.short_name,
       COALESCE(s.image, t.image) AS image, CASE WHEN s.id IS NULL THEN t.category ELSE '{V.QUEST_ITEM_CATEGORY}' END AS category,
       t.name_kr, CASE WHEN s.id IS NULL THEN t.at ELSE TIMESTAMP '2024-01-15 00:00:00' END AS update_time
FROM t FULL JOIN s ON t.id = s.id
""")
def q_quest_items_upsert(spark, d):
    """Quest items (customers, two to an id, ids beyond the parts' among
    them) as second feed of a loot table (parts): short and local names
    survive, the load time moves where it is fed."""
    p = read_table(spark, d, "part")
    loot = p.select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("id"), F.col("p_name").alias("name_en"),
                    F.col("p_brand").alias("short_name"), F.lit("/old").alias("image"), F.lit("Tools").alias("category"),
                    F.concat(F.lit("curated "), F.col("p_brand")).alias("name_kr"),
                    F.lit("2023-01-01 00:00:00").cast("timestamp_ntz").alias("update_time"))
    c = read_table(spark, d, "customer")
    fed = F.floor(F.col("c_custkey") / 2) * 3
    doc = F.struct(F.col("c_custkey").alias("pos"), F.concat(F.lit("p"), fed.cast("string")).alias("id"),
                   F.col("c_name").alias("name"), F.concat(F.lit("/quest/"), F.col("c_mktsegment")).alias("image512pxLink"))
    feed = c.select(F.from_json(F.to_json(doc), QUEST_ITEM_SCHEMA, {"mode": "FAILFAST"}).alias("q")).select("q.*")
    return quests.upsert_quest_items(loot, feed, AS_OF)


# --------------------------------------------------------- dictionary shapes

@register("label_array", """
SELECT p_partkey, array_to_string(CASE p_type WHEN 'STANDARD' THEN [1, 2] WHEN 'PROMO' THEN [7] ELSE [] END, '|') AS label FROM part
""")
def q_label_array(spark, d):
    """L3: an int-array value, an empty array by default."""
    from quartermaster.functions.labels import label
    from quartermaster.sources.tables import lookup_from_pairs
    lk = lookup_from_pairs(spark, [("STANDARD", [1, 2]), ("PROMO", [7])], "k string, v array<int>")
    p = read_table(spark, d, "part").select("p_partkey", "p_type")
    return label(p, "p_type", lk, "k", "v", "label", default=[]).select(
        "p_partkey", F.array_join(F.col("label").cast("array<string>"), "|").alias("label"))


@register("label_int", """
SELECT p_partkey, CASE p_brand WHEN 'Brand#1' THEN 50 WHEN 'Brand#2' THEN 75 ELSE 0 END AS label FROM part
""")
def q_label_int(spark, d):
    """An int value, 0 by default; later rows of a repeated key
    replace earlier ones."""
    from quartermaster.functions.labels import label
    from quartermaster.sources.tables import lookup_from_pairs
    lk = lookup_from_pairs(spark, [("Brand#1", 90, 0), ("Brand#1", 50, 1), ("Brand#2", 75, 2)], "k string, v int, pos int")
    p = read_table(spark, d, "part").select("p_partkey", "p_brand")
    return label(p, "p_brand", lk, "k", "v", "label", default=0, order="pos").select("p_partkey", "label")


# --------------------------------------------------- community jobs on frames

#: the 25 branches in order: number, table (as numbered below), label, column, link, link ends with the id, type
_INDEX_SQL = """
WITH b(branch, k, label, col, link, with_id, type) AS (VALUES
  (0, 0, '타르코프 지도 : ', 'kr', '/map-of-tarkov/', TRUE, 'MAP_OF_TARKOV'),
  (1, 0, '대화형 지도 : ', 'kr', '/map/', TRUE, 'MAP'),
  (2, 1, '보스 : ', 'kr', '/boss/', TRUE, 'BOSS'),
  (3, 2, '하이드아웃 : ', 'en', '/hideout', FALSE, 'HIDEOUT'),
  (4, 2, '하이드아웃 : ', 'kr', '/hideout', FALSE, 'HIDEOUT'),
  (5, 3, '퀘스트 : ', 'kr', '/quest/detail/', TRUE, 'QUEST'),
  (6, 3, '퀘스트 : ', 'en', '/quest/detail/', TRUE, 'QUEST'),
  (7, 4, '상인 : ', 'kr', '/quest', FALSE, 'TRADER'),
  (8, 5, '무기 : ', 'name', '/weapon?id=', TRUE, 'WEAPON'),
  (9, 6, '무기 : ', 'name', '/weapon?id=', TRUE, 'WEAPON'),
  (10, 7, '무기 : ', 'name', '/weapon?id=', TRUE, 'WEAPON'),
  (11, 8, '탄약 : ', 'name', '/ammo?id=', TRUE, 'AMMO'),
  (12, 9, '방탄모 : ', 'name', '/head-wear?id=', TRUE, 'HEADWEAR'),
  (13, 10, '전술 조끼 : ', 'name', '/rig?id=', TRUE, 'RIG'),
  (14, 11, '방탄 조끼 : ', 'name', '/armor-vest?id=', TRUE, 'ARMOR_VEST'),
  (15, 12, '헤드셋 : ', 'name', '/headset?id=', TRUE, 'HEADSET'),
  (16, 13, '가방 : ', 'name', '/backpack?id=', TRUE, 'BACKPACK'),
  (17, 14, '의료품 : ', 'kr', '/medical?id=', TRUE, 'MEDICAL'),
  (18, 15, '컨테이너 : ', 'kr', '/container?id=', TRUE, 'CONTAINER'),
  (19, 16, '키 : ', 'name', '/key?id=', TRUE, 'KEY'),
  (20, 17, '식량 : ', 'kr', '/provisions?id=', TRUE, 'PROVISIONS'),
  (21, 18, '전리품 : ', 'kr', '/loot?id=', TRUE, 'LOOT'),
  (22, 19, '얼굴 커버 : ', 'name', '/face-cover?id=', TRUE, 'FACE_COVER'),
  (23, 20, '완장 : ', 'name', '/arm-band?id=', TRUE, 'ARM_BAND'),
  (24, 21, '안경 : ', 'name', '/glasses?id=', TRUE, 'GLASSES')),
u AS (SELECT label || CASE col WHEN 'name' THEN p_name WHEN 'en' THEN upper(p_name)
                               WHEN 'kr' THEN CASE WHEN p_size % 9 > 0 THEN 'kr ' || p_name END END AS value,
             link || CASE WHEN with_id THEN CAST(p_partkey AS VARCHAR) ELSE '' END AS link,
             CAST(p_partkey AS VARCHAR) AS page_value, type, branch
      FROM part JOIN b ON p_partkey % 22 = k)
SELECT value, link, page_value, type,
       CAST(ROW_NUMBER() OVER (ORDER BY branch, page_value, value NULLS FIRST, link) AS BIGINT) AS "order" FROM u"""

#: the tables as the SQL above numbers them
_INDEX_TABLES = ["map_parent", "boss", "hideout_master", "quest", "npc", "weapon", "throwable", "knife", "ammo", "headwear", "rig",
                 "armor_vest", "headset", "backpack", "medical", "container", "key", "provisions", "loot", "face_cover", "arm_band", "glasses"]


@register("search_index_job", _INDEX_SQL)
def q_search_index_job(spark, d):
    """P32 over every branch of its specification (U1-U5: two languages, one
    table under two paths, several tables under one type, links without id):
    ``part`` is dealt over the spec's tables."""
    from quartermaster.operators.index import search_index
    p = read_table(spark, d, "part")

    def table(name):
        return p.filter(F.col("p_partkey") % len(_INDEX_TABLES) == _INDEX_TABLES.index(name)).select(
            F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.upper("p_name").alias("name_en"),
            F.when(F.col("p_size") % 9 > 0, F.concat(F.lit("kr "), F.col("p_name"))).alias("name_kr"))

    return search_index(community.index_branches(table))


@register("expiry_job", """
WITH e AS (SELECT event_id, user_id, CASE WHEN event_type <> 'error' THEN ts END AS ends FROM events),
gone AS (SELECT DISTINCT user_id FROM e WHERE ends < TIMESTAMP '2024-01-15 00:00:00')
SELECT 'user_ban' AS tbl, event_id AS id FROM e WHERE ends IS NULL OR ends >= TIMESTAMP '2024-01-15 00:00:00'
UNION ALL SELECT 'user_delete', event_id FROM e WHERE ends IS NULL OR ends >= TIMESTAMP '2024-01-15 00:00:00'
UNION ALL SELECT 'user_icon', c_custkey FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM gone)
UNION ALL SELECT 'user_quest', o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM gone)
""")
def q_expiry_job(spark, d):
    """P31 on frames: bans, accounts, icons and quests, one instant, one
    expired key set."""
    e = read_table(spark, d, "events")
    ends = F.when(F.col("event_type") != "error", F.col("ts"))
    frames = {
        "user_ban": e.select(F.col("event_id").alias("id"), ends.alias("ban_end_time")),
        "user_delete": e.select(F.col("event_id").alias("id"), F.col("user_id").alias("email"), ends.alias("delete_end_time")),
        "user_icon": read_table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_custkey").alias("user_email")),
        "user_quest": read_table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_email"))}
    out = None
    for name, df in community.expire(frames, AS_OF).items():
        part = df.select(F.lit(name).alias("tbl"), F.col("id").cast("bigint").alias("id"))
        out = part if out is None else out.unionByName(part)
    return out
