"""Checks that go through files: documents landed in the shared folder and
read back, parameter tables from files, tables published, merged by bucket and
kept as dated snapshots. Registered beside those of
:mod:`quartermaster.plans.catalog`."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermaster.plans import community
from quartermaster.plans.catalog import AS_OF, quest_docs, read_table, register, station_docs
from quartermaster.session import ensure_checkpoint_dir
from quartermaster.sources import documents as D


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _landed(spark, docs: DataFrame, name: str) -> str:
    """Documents written as JSON lines."""
    path = _folder(spark, name)
    docs.select(F.to_json(F.struct(*docs.columns), {"ignoreNullFields": "false"}).alias("value")).write.text(path)
    return path


# ------------------------------------------------------- document files (A1-A5)

@register("files_stations", """
SELECT o_orderkey AS pos, CAST(o_orderkey AS VARCHAR) AS id, CAST(2 AS INTEGER) AS n_levels,
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 3 END AS n_items, CAST(o_custkey * 2 AS INTEGER) AS construction_time FROM orders
""")
def q_files_stations(spark, d):
    """A3: station documents as files of JSON lines."""
    s = D.read_documents(spark, _landed(spark, station_docs(spark, d), "landed"), D.STATION_SCHEMA)
    n_items = F.aggregate("levels", F.lit(0), lambda n, lv: n + F.size(lv["itemRequirements"]))
    return s.select("pos", "id", F.size("levels").alias("n_levels"), n_items.alias("n_items"),
                    F.element_at("levels", -1)["constructionTime"].alias("construction_time"))


@register("files_quests", """
SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderpriority END AS trader FROM orders
""")
def q_files_quests(spark, d):
    """A4: quest documents as files of JSON lines."""
    q = D.read_documents(spark, _landed(spark, quest_docs(spark, d), "landed"), D.QUEST_SCHEMA)
    return q.select("id", F.col("trader.name").alias("trader"))


@register("files_quest_items", """
SELECT c_custkey AS pos, 'p' || CAST(c_custkey AS VARCHAR) AS id, c_name AS name, '/quest/' || c_mktsegment AS image512pxLink FROM customer
""")
def q_files_quest_items(spark, d):
    """A5: quest item documents as files of JSON lines."""
    docs = read_table(spark, d, "customer").select(
        F.col("c_custkey").alias("pos"), F.concat(F.lit("p"), F.col("c_custkey").cast("string")).alias("id"),
        F.col("c_name").alias("name"), F.concat(F.lit("/quest/"), F.col("c_mktsegment")).alias("image512pxLink"))
    return D.read_documents(spark, _landed(spark, docs, "landed"), D.QUEST_ITEM_SCHEMA)


#: parts per enveloped file
_ENVELOPE = 1000


def _envelopes(spark, d) -> str:
    """Files of one JSON document each, ``{"data": {..., "items": [...]}}``
    over the parts of a range of keys: names hold brackets and quotes, and
    other lists stand before and after the list that is read."""
    item = F.struct(F.concat(F.lit("i"), F.col("p_partkey").cast("string")).alias("id"),
                    F.concat(F.col("p_name"), F.lit(' }{ "[], \\')).alias("name"), F.col("p_retailprice").alias("weight"),
                    F.struct(F.col("p_type").alias("name"), F.struct(F.col("p_brand").alias("name")).alias("parent")).alias("category"),
                    F.to_json(F.struct(F.col("p_size").alias("size"))).alias("properties"))
    group = F.floor(F.col("p_partkey") / _ENVELOPE).cast("bigint").alias("part_range")
    rows = read_table(spark, d, "part").groupBy(group).agg(F.array_sort(F.collect_list(F.struct(F.col("p_partkey"), F.to_json(item).alias("j")))).alias("r"))
    body = F.array_join(F.transform("r", lambda x: x["j"]), ",\n")
    text = F.concat(F.lit('{"meta": {"items": [{"id": "no"}]}, "data": {"maps": [{"id": "no"}], "items": ['), body,
                    F.lit('], "more": {"items": [{"id": "no"}]}}}'))
    path = _folder(spark, "enveloped")
    rows.select("part_range", text.alias("value")).write.partitionBy("part_range").text(path)
    return path


@register("files_enveloped", f"""
SELECT ROW_NUMBER() OVER (PARTITION BY p_partkey // {_ENVELOPE} ORDER BY p_partkey) - 1 AS pos, 'i' || CAST(p_partkey AS VARCHAR) AS id,
       p_name || ' }}{{ "[], \\' AS name, p_retailprice AS weight, p_type AS category, p_brand AS parent,
       CAST(p_size AS INTEGER) AS size FROM part
""")
def q_files_enveloped(spark, d):
    """A1: one large list inside an envelope, read in byte ranges."""
    items = D.read_enveloped(spark, _envelopes(spark, d), "items", D.ITEM_SCHEMA)
    return items.select("pos", "id", "name", "weight", F.col("category.name").alias("category"),
                        F.col("category.parent.name").alias("parent"), F.get_json_object("properties", "$.size").cast("int").alias("size"))


@register("files_malformed", """
SELECT CASE WHEN o_orderstatus = 'F' THEN 'malformed' ELSE 'document' END AS kind, o_orderkey FROM orders
""")
def q_files_malformed(spark, d):
    """A1-A5: lines that are no documents (cut short here) are set aside with
    their text, and all others are read."""
    o = read_table(spark, d, "orders")
    line = F.to_json(F.struct(F.col("o_orderkey").alias("pos"), F.col("o_orderpriority").alias("name")))
    path = _folder(spark, "landed")
    cut = F.regexp_replace(line, "}$", "")
    o.select(F.when(F.col("o_orderstatus") == "F", cut).otherwise(line).alias("value")).write.text(path)
    good, bad = D.scan_documents(spark, path, "pos bigint, name string")
    key = F.regexp_extract("line", r'"pos":(\d+)', 1).cast("bigint")
    return good.select(F.lit("document").alias("kind"), F.col("pos").alias("o_orderkey")).unionByName(
        bad.select(F.lit("malformed").alias("kind"), key.alias("o_orderkey")))


# ---------------------------------------------------- parameter tables (A9, L)

@register("label_file", """
SELECT c_custkey, COALESCE(n_name, 'none') AS label FROM customer
LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) ON n_nationkey = c_nationkey
""")
def q_label_file(spark, d):
    """A label dictionary kept as a CSV file (the nations of four
    regions), with a default for what it lacks."""
    from quartermaster.functions.labels import label
    from quartermaster.sources.tables import read_lookup
    path = _folder(spark, "lookup")
    (read_table(spark, d, "nation").filter("n_regionkey <> 2")
     .select(F.col("n_nationkey").cast("int").alias("k"), F.col("n_name").alias("v")).write.option("header", "true").csv(path))
    c = read_table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return label(c, "c_nationkey", read_lookup(spark, path, "k int, v string"), "k", "v", "label", default="none").select("c_custkey", "label")


# ------------------------------------------------------- published tables

@register("bucketed_merge", """
SELECT COALESCE(o_orderkey, k) AS id, CASE WHEN k IS NULL THEN o_orderpriority ELSE 'line ' || CAST(n AS VARCHAR) END AS note,
       o_totalprice AS price
FROM orders FULL JOIN (SELECT l_orderkey + 3 AS k, MAX(l_linenumber) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) ON k = o_orderkey
""")
def q_bucketed_merge(spark, d):
    """B1 + B7: a table kept by key bucket: loaded from orders, then merged
    with lines (last wins by line number; ids beside the orders' are new),
    unused folders removed, and read back from its manifest."""
    from quartermaster.operators.bucketed import merge_into_path, read_bucketed, remove_unused
    path = _folder(spark, "table")
    schema = "id bigint, note string, price double"
    o = read_table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("note"),
                                              F.col("o_totalprice").alias("price"))
    merge_into_path(o, path, "id", ["note", "price"], duplicates="error", buckets=8, target_schema=schema)
    li = read_table(spark, d, "lineitem").filter("l_returnflag = 'R'").select(
        (F.col("l_orderkey") + 3).alias("id"), F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("note"), "l_linenumber")
    merge_into_path(li, path, "id", ["note"], order_cols="l_linenumber", buckets=8)
    remove_unused(spark, path, keep=1)
    return read_bucketed(spark, path)


@register("truncate_reload", """
SELECT '부품 : ' || p_name AS value, '/part?id=' || CAST(p_partkey AS VARCHAR) AS link, CAST(p_partkey AS VARCHAR) AS page_value,
       'PART' AS type, ROW_NUMBER() OVER (ORDER BY CAST(p_partkey AS VARCHAR)) AS "order"
FROM part WHERE p_size > 25
""")
def q_truncate_reload(spark, d):
    """The search table loaded, then emptied and loaded anew; a reader of
    the first version is not disturbed, and the latest one is read."""
    from quartermaster.operators.index import IndexBranch, IndexEmit, read_published, replace_table, search_index
    root = _folder(spark, "db")
    p = read_table(spark, d, "part")
    emit = IndexEmit("부품 : ", "p_name", "/part?id=", "PART")
    for rows in (p, p.filter("p_size > 25")):
        replace_table(search_index([IndexBranch(rows, [emit], "p_partkey")]), root, "search")
    return read_published(spark, root, "search")


# ---------------------------------------------------------- snapshots

@register("snapshot_roundtrip", """
WITH days(snapshot_date) AS (VALUES (DATE '2024-01-12'), (DATE '2024-01-14'), (DATE '2024-01-15'))
SELECT 'customer' AS tbl, snapshot_date, c_custkey AS id, c_name AS name, c_acctbal AS amount FROM customer, days
UNION ALL SELECT 'nation', snapshot_date, n_nationkey, n_name, NULL FROM nation, days
""")
def q_snapshot_roundtrip(spark, d):
    """Nightly snapshots of two published tables over five days (one is
    left out); each must hold its source's rows, and days that are more than
    three back go."""
    from quartermaster.operators.index import publish_all
    root, snaps = _folder(spark, "db"), _folder(spark, "snapshots")
    publish_all({"customer": read_table(spark, d, "customer"), "nation": read_table(spark, d, "nation")}, root)
    for day in (10, 11, 12, 14, 15):
        if not community.snapshot_job(spark, root, snaps, ["customer", "nation"], dt.date(2024, 1, day)):
            raise RuntimeError(f"the snapshot of day {day} is not complete")
    c = spark.read.parquet(f"{snaps}/customer")
    n = spark.read.parquet(f"{snaps}/nation")
    return c.select(F.lit("customer").alias("tbl"), "snapshot_date", F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                    F.col("c_acctbal").alias("amount")).unionByName(
        n.select(F.lit("nation").alias("tbl"), "snapshot_date", F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("name"),
                 F.lit(None).cast("double").alias("amount")))


# ------------------------------------------------------------ all station targets

@register("stations_all", """
WITH o AS (SELECT CAST(o_orderkey AS VARCHAR) AS s, o_orderstatus AS st FROM orders)
SELECT 'hideout_master' AS target, s AS id FROM o
UNION ALL SELECT 'hideout_level', s || '-' || CAST(k AS VARCHAR) FROM o, (VALUES (1), (2)) AS t(k)
UNION ALL SELECT 'hideout_item_require', s || '-1-a' FROM o
UNION ALL SELECT 'hideout_item_require', s || '-2-' || x FROM o, (VALUES ('a'), ('b')) AS t(x) WHERE st <> 'F'
UNION ALL SELECT 'hideout_trader_require', s || '-t' FROM o
UNION ALL SELECT 'hideout_station_require', s || '-n' || CAST(i AS VARCHAR) FROM o, (VALUES (0), (1)) AS t(i)
UNION ALL SELECT 'hideout_skill_require', s || '-s' FROM o
UNION ALL SELECT 'hideout_bonus', s || '-1/' || x FROM o, (VALUES (0, 'SkillBoost'), (1, 'Rate')) AS t(i, x)
          WHERE i = 0 OR st <> 'O'
UNION ALL SELECT 'hideout_bonus', s || '-1/SkillBoost' FROM o WHERE st = 'O'
UNION ALL SELECT 'hideout_crafts', s || '-c' FROM o
""")
def q_stations_all(spark, d):
    """All eight targets from one pass over the documents."""
    from quartermaster.plans import stations as S
    out = None
    for t, rows in S.station_sources(station_docs(spark, d), AS_OF).items():
        key = F.concat_ws("/", "level_id", "type") if t == "hideout_bonus" else F.col("id")
        part = rows.select(F.lit(t).alias("target"), key.alias("id"))
        out = part if out is None else out.unionByName(part)
    return out
