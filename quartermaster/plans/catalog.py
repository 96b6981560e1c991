"""Checks on the provided tables: each operator of the inventory applied to
the driver's tables (whole tables, no row caps), paired with an independent
SQL statement that DuckDB runs on the same Parquet files.

Mapping of the community schema onto the provided tables:

* users     = ``customer``  (email = c_custkey, attendance = c_nationkey)
* posts     = ``orders``    (id = o_orderkey, writer = o_custkey,
                             type = o_orderpriority, likes = floor(o_totalprice / 20000))
* comments  = ``lineitem``  (board = l_orderkey, user = l_suppkey,
                             deleted by user = l_returnflag = 'R',
                             deleted by admin = l_linestatus = 'O')
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermaster.operators import activity
from quartermaster.sources.tables import read_table as _read_table


def read_table(spark, d, name, spread: bool = False):
    """A provided table; ``spread`` deals it out over all task slots, for the
    checks that build and parse a JSON document per row."""
    return _read_table(spark, d, name, spark.sparkContext.defaultParallelism if spread else None)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: Fixed run clock of the checks (T9: one instant per run).
AS_OF = _dt.datetime(2024, 1, 15)

#: Grading scale used by the checks: (grade id, minimum score). 3 and 6 tie.
GRADES = [(1, 50), (2, 120), (3, 165), (4, 250), (5, 800), (6, 165)]
GRADES_SQL = "(VALUES (1, 50), (2, 120), (3, 165), (4, 250), (5, 800), (6, 165)) AS g(id, score)"


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# ------------------------------------------------------------ table mapping

def users(spark, d) -> DataFrame:
    return read_table(spark, d, "customer").select(
        F.col("c_custkey").alias("email"),
        F.col("c_nationkey").alias("attendance_count"),
        F.lit(-1).cast("int").alias("grade"))


def boards(spark, d) -> DataFrame:
    return read_table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("writer"),
        F.col("o_orderpriority").alias("type"),
        F.floor(F.col("o_totalprice") / 20000).cast("int").alias("like_count"),
        F.col("o_orderdate").alias("create_time"))


def comments(spark, d) -> DataFrame:
    return read_table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("board_id"),
        F.col("l_suppkey").alias("user_email"),
        (F.col("l_returnflag") == "R").alias("is_delete_by_user"),
        (F.col("l_linestatus") == "O").alias("is_delete_by_admin"))


def grades(spark) -> DataFrame:
    return spark.createDataFrame(GRADES, "id int, score int")


# ---------------------------------------------------------------- community

#: P29 per user, as two counts looked up for that user
_POSTS_OF = "(SELECT count(*) FROM orders WHERE o_custkey = c_custkey)"
_BOARDS_OF = """(SELECT count(DISTINCT l_orderkey) FROM lineitem
   WHERE l_suppkey = c_custkey AND l_returnflag <> 'R' AND l_linestatus <> 'O'
     AND l_orderkey IN (SELECT o_orderkey FROM orders))"""
_STATS_SQL = f"""
SELECT c_custkey AS user_email, {_POSTS_OF} AS post_count, {_BOARDS_OF} AS comment_count FROM customer
"""


@register("user_post_statistics", _STATS_SQL)
def q_user_post_statistics(spark, d):
    """D5 E1 D3 C8 E2 D2 E3."""
    return activity.user_post_statistics(users(spark, d), boards(spark, d), comments(spark, d))


#: The grade is read off the largest (threshold, id) not above the score
_SCORED = f"""scored AS (
  SELECT c_custkey AS email, 5 * c_nationkey + 10 * {_POSTS_OF} + 5 * {_BOARDS_OF} AS points FROM customer),
reached AS (
  SELECT email, (SELECT max(g.score * 100 + g.id) FROM {GRADES_SQL} WHERE g.score <= points) AS top FROM scored)"""
_GRADE_SQL = f"""
WITH {_SCORED}
SELECT email, CAST(CASE WHEN top IS NULL THEN -1 ELSE top % 100 END AS INTEGER) AS grade FROM reached
"""


def _graded_users(spark, d, strategy="broadcast"):
    u = users(spark, d)
    stats = activity.user_post_statistics(u, boards(spark, d), comments(spark, d))
    return activity.update_user_grade(u, stats, grades(spark), strategy=strategy)


@register("user_grade", _GRADE_SQL)
def q_user_grade(spark, d):
    """D1 X9 D4 W1 B12 (broadcast threshold join)."""
    return _graded_users(spark, d).select("email", "grade")


@register("user_grade_sweep", _GRADE_SQL)
def q_user_grade_sweep(spark, d):
    """P30 with the threshold join as a distributed sweep."""
    return _graded_users(spark, d, "sweep").select("email", "grade")


@register("grade_max_by", f"""
WITH {_SCORED}
SELECT email, CAST(top % 100 AS INTEGER) AS grade_id FROM reached WHERE top IS NOT NULL
""")
def q_grade_max_by(spark, d):
    """The arg-max form of the grading (graded users only)."""
    u = users(spark, d)
    stats = activity.user_post_statistics(u, boards(spark, d), comments(spark, d))
    scores = activity.total_scores(u, stats)
    return activity.grades_max_by(scores, grades(spark))


def _thresholds(spark, d, strategy):
    """Order dates as thresholds for event times: many orders share a day,
    and no tie column is given."""
    from quartermaster.operators.joins import threshold_lookup
    days = read_table(spark, d, "orders").select(
        (F.col("o_orderdate") + F.expr("make_interval(27)")).alias("day"), "o_orderpriority", "o_orderstatus")
    facts = read_table(spark, d, "events").select("event_id", "ts")
    return threshold_lookup(facts, "ts", days, "day", ["o_orderpriority", "o_orderstatus"], strategy=strategy)


_THRESHOLDS_SQL = """
WITH t AS (SELECT o_orderdate + INTERVAL 27 YEAR AS day, max({'p': o_orderpriority, 's': o_orderstatus}) AS b
           FROM orders GROUP BY 1)
SELECT event_id, ts, b.p AS o_orderpriority, b.s AS o_orderstatus FROM events ASOF LEFT JOIN t ON ts >= day
"""


@register("threshold_times", _THRESHOLDS_SQL)
def q_threshold_times(spark, d):
    """D4 on timestamps with tied thresholds and no tie column."""
    return _thresholds(spark, d, "broadcast")


@register("threshold_times_sweep", _THRESHOLDS_SQL)
def q_threshold_times_sweep(spark, d):
    """The same rows from the distributed sweep."""
    return _thresholds(spark, d, "sweep")


# ------------------------------------------------------------- issue board

def issues(spark, d) -> DataFrame:
    """Existing issue rows: finished orders are issues of their own post;
    pending orders give issues of posts that do not exist (ids shifted by
    1,000,000); open low-priority orders give issues with a NULL post id."""
    o = read_table(spark, d, "orders")
    own = o.filter(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("board_id"),
        F.concat(F.lit("OLD-"), F.col("o_orderpriority")).alias("board_type"))
    orphan = o.filter(F.col("o_orderstatus") == "P").select(
        (F.col("o_orderkey") + 1000000).alias("board_id"),
        F.lit("ORPHAN").alias("board_type"))
    nullkey = o.filter((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "5-LOW")).select(
        F.lit(None).cast("bigint").alias("board_id"), F.lit("NULLKEY").alias("board_type"))
    return own.unionByName(orphan).unionByName(nullkey)


_ISSUES_SQL = """
issues AS (
  SELECT o_orderkey AS board_id, 'OLD-' || o_orderpriority AS board_type FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT o_orderkey + 1000000, 'ORPHAN' FROM orders WHERE o_orderstatus = 'P'
  UNION ALL SELECT CAST(NULL AS BIGINT), 'NULLKEY' FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '5-LOW'),
boards AS (SELECT o_orderkey AS id, o_orderpriority AS type, CAST(floor(o_totalprice / 20000) AS INTEGER) AS like_count FROM orders)"""


@register("issue_delete_in", f"""
WITH {_ISSUES_SQL}
SELECT board_id, board_type FROM issues
WHERE NOT COALESCE(board_id IN (SELECT id FROM boards WHERE like_count < 10), FALSE)
""")
def q_issue_delete_in(spark, d):
    """B9 / D6 (T5): delete issues whose post has fewer than 10 likes; NULL
    keys stay."""
    from quartermaster.operators.deletes import delete_in
    b = boards(spark, d)
    return delete_in(issues(spark, d), b.filter(F.col("like_count") < 10).select("id"),
                     "board_id", "id")


@register("issue_delete_orphans", f"""
WITH {_ISSUES_SQL}
SELECT board_id, board_type FROM issues i
WHERE EXISTS (SELECT 1 FROM boards b WHERE b.id = i.board_id)
""")
def q_issue_delete_orphans(spark, d):
    """B10 / D7 (T5): delete issues without a post; NULL keys go too."""
    from quartermaster.operators.deletes import delete_not_exists
    return delete_not_exists(issues(spark, d), boards(spark, d).select("id"), "board_id", "id")


@register("issue_upsert", f"""
WITH {_ISSUES_SQL},
src AS (SELECT id AS board_id, type AS board_type FROM boards WHERE like_count >= 10)
SELECT COALESCE(i.board_id, s.board_id) AS board_id,
       CASE WHEN s.board_id IS NOT NULL THEN s.board_type ELSE i.board_type END AS board_type
FROM issues i FULL JOIN src s ON i.board_id = s.board_id
""")
def q_issue_upsert(spark, d):
    """B3 + C6: set-based upsert of posts with at least 10 likes."""
    from quartermaster.operators.merge import merge
    src = boards(spark, d).filter(F.col("like_count") >= 10).select(
        F.col("id").alias("board_id"), F.col("type").alias("board_type"))
    return merge(issues(spark, d), src, "board_id", duplicates="error")


@register("issue_board", f"""
WITH {_ISSUES_SQL},
step1 AS (SELECT * FROM issues WHERE NOT COALESCE(board_id IN (SELECT id FROM boards WHERE like_count < 10), FALSE)),
step2 AS (SELECT * FROM step1 i WHERE EXISTS (SELECT 1 FROM boards b WHERE b.id = i.board_id)),
src AS (SELECT id AS board_id, type AS board_type, o_orderdate AS create_time
        FROM boards JOIN orders ON id = o_orderkey WHERE like_count >= 10)
SELECT COALESCE(i.board_id, s.board_id) AS board_id,
       CASE WHEN s.board_id IS NOT NULL THEN s.board_type ELSE i.board_type END AS board_type,
       CASE WHEN s.board_id IS NOT NULL THEN s.create_time ELSE TIMESTAMP '1990-01-01 00:00:00' END AS create_time
FROM step2 i FULL JOIN src s ON i.board_id = s.board_id
""")
def q_issue_board(spark, d):
    """B9 -> B10 -> B3, in this order."""
    from quartermaster.operators.deletes import issue_board
    old = issues(spark, d).withColumn("create_time", F.lit("1990-01-01 00:00:00").cast("timestamp_ntz"))
    return issue_board(old, boards(spark, d))


# ------------------------------------------------------------------ expiry

def bans(spark, d) -> DataFrame:
    """Bans: one per event; error events carry no end time (NULL)."""
    e = read_table(spark, d, "events")
    return e.select("event_id", "user_id",
                    F.when(F.col("event_type") != "error", F.col("ts")).alias("ban_end_time"))


@register("expire_bans", """
SELECT event_id, user_id FROM events
WHERE NOT COALESCE(CASE WHEN event_type <> 'error' THEN ts END < TIMESTAMP '2024-01-15 00:00:00', FALSE)
""")
def q_expire_bans(spark, d):
    """B8 + C7 (T4): delete expired bans; NULL end times stay."""
    from quartermaster.operators.deletes import delete_where, expired
    return delete_where(bans(spark, d), expired("ban_end_time", AS_OF)).select("event_id", "user_id")


def _cascade(spark, d):
    from quartermaster.operators.deletes import cascade_delete
    req = read_table(spark, d, "events").select(
        F.col("user_id").alias("email"), F.col("ts").alias("delete_end_time"), "event_id")
    o = read_table(spark, d, "orders").select(F.col("o_custkey").alias("user_email"), "o_orderkey")
    return cascade_delete(req, "email", "delete_end_time", AS_OF, {"quests": (o, "user_email")})


@register("cascade_delete_children", """
SELECT o_orderkey FROM orders
WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = o_custkey AND ts < TIMESTAMP '2024-01-15 00:00:00')
""")
def q_cascade_children(spark, d):
    """Children of expired accounts removed (one instant)."""
    return _cascade(spark, d)["quests"].select("o_orderkey")


@register("cascade_delete_parent", """
SELECT event_id FROM events WHERE NOT COALESCE(ts < TIMESTAMP '2024-01-15 00:00:00', FALSE)
""")
def q_cascade_parent(spark, d):
    """The expired requests themselves removed last."""
    return _cascade(spark, d)["parent"].select("event_id")


# ------------------------------------------------------------------- merges

def _li_target(spark, d):
    """Target keyed (l_orderkey, l_linenumber): finished orders hold a stale
    line with a note that only the target has."""
    o = read_table(spark, d, "orders").filter(F.col("o_orderstatus") == "F")
    return o.select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_orderkey") % 4 + 1).cast("int").alias("l_linenumber"),
                    F.lit(-1.0).alias("l_quantity"), F.lit(-1.0).alias("l_extendedprice"),
                    F.col("o_orderpriority").alias("note"))


@register("merge_last_wins", """
WITH src AS (
  SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
              ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn
    FROM lineitem) WHERE rn = 1),
tgt AS (SELECT o_orderkey AS l_orderkey, CAST(o_orderkey % 4 + 1 AS INTEGER) AS l_linenumber, -1.0 AS l_quantity,
               -1.0 AS l_extendedprice, o_orderpriority AS note FROM orders WHERE o_orderstatus = 'F')
SELECT COALESCE(t.l_orderkey, s.l_orderkey) AS l_orderkey,
       COALESCE(t.l_linenumber, s.l_linenumber) AS l_linenumber,
       CASE WHEN s.l_orderkey IS NOT NULL THEN s.l_quantity ELSE t.l_quantity END AS l_quantity,
       CASE WHEN s.l_orderkey IS NOT NULL THEN s.l_extendedprice ELSE t.l_extendedprice END AS l_extendedprice,
       t.note AS note
FROM tgt t FULL JOIN src s ON t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber
""")
def q_merge_last_wins(spark, d):
    """B1 + E5: duplicate keys in the source, last by ship date wins."""
    from quartermaster.operators.merge import merge
    src = read_table(spark, d, "lineitem")
    return merge(_li_target(spark, d), src, ["l_orderkey", "l_linenumber"],
                 insert_cols=["l_quantity", "l_extendedprice"],
                 order_cols=["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"])


def _cust_target(spark, d):
    c = read_table(spark, d, "customer")
    return c.filter(F.col("c_nationkey") < 20).select("c_custkey", "c_name", "c_acctbal",
                                                       "c_nationkey", "c_mktsegment")


def _cust_source(spark, d):
    c = read_table(spark, d, "customer")
    return c.filter(F.col("c_nationkey") >= 5).select(
        "c_custkey", F.upper("c_name").alias("c_name"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal") + 1).alias("c_acctbal"),
        (F.col("c_nationkey") + 100).alias("c_nationkey"))


_CUST_SQL = """
tgt AS (SELECT c_custkey, c_name, c_acctbal, c_nationkey, c_mktsegment FROM customer WHERE c_nationkey < 20),
src AS (SELECT c_custkey, upper(c_name) AS c_name,
               CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal + 1 END AS c_acctbal,
               c_nationkey + 100 AS c_nationkey FROM customer WHERE c_nationkey >= 5)"""


@register("merge_partial_columns", f"""
WITH {_CUST_SQL}
SELECT COALESCE(t.c_custkey, s.c_custkey) AS c_custkey,
       CASE WHEN t.c_custkey IS NOT NULL THEN t.c_name ELSE s.c_name END AS c_name,
       CASE WHEN s.c_custkey IS NOT NULL THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
       CASE WHEN s.c_custkey IS NOT NULL THEN s.c_nationkey ELSE t.c_nationkey END AS c_nationkey,
       t.c_mktsegment AS c_mktsegment
FROM tgt t FULL JOIN src s ON t.c_custkey = s.c_custkey
""")
def q_merge_partial_columns(spark, d):
    """B4 + B5 + T8: update a column subset (NULL overwrites), name is
    insert-only, segment is curated (kept, NULL for new rows)."""
    from quartermaster.operators.merge import merge
    return merge(_cust_target(spark, d), _cust_source(spark, d), "c_custkey",
                 insert_cols=["c_name", "c_acctbal", "c_nationkey"],
                 update_cols=["c_acctbal", "c_nationkey"], duplicates="error")


@register("merge_insert_only", f"""
WITH {_CUST_SQL}
SELECT COALESCE(t.c_custkey, s.c_custkey) AS c_custkey,
       CASE WHEN t.c_custkey IS NOT NULL THEN t.c_name ELSE s.c_name END AS c_name,
       CASE WHEN t.c_custkey IS NOT NULL THEN t.c_acctbal ELSE s.c_acctbal END AS c_acctbal,
       CASE WHEN s.c_custkey IS NOT NULL THEN s.c_nationkey ELSE t.c_nationkey END AS c_nationkey,
       t.c_mktsegment AS c_mktsegment
FROM tgt t FULL JOIN src s ON t.c_custkey = s.c_custkey
""")
def q_merge_insert_only(spark, d):
    """B5 (T7): two insert-only columns, one updated column."""
    from quartermaster.operators.merge import merge
    return merge(_cust_target(spark, d), _cust_source(spark, d), "c_custkey",
                 insert_cols=["c_name", "c_acctbal", "c_nationkey"],
                 update_cols=["c_nationkey"], duplicates="error")


@register("merge_composite", """
WITH src AS (
  SELECT o_custkey, o_orderpriority, o_orderkey, o_totalprice FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderpriority
                                 ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1),
tgt AS (SELECT c_custkey AS o_custkey, ['1-URGENT', '2-HIGH', '5-LOW'][c_nationkey % 3 + 1] AS o_orderpriority,
               -1 AS o_orderkey, -1.0 AS o_totalprice FROM customer)
SELECT COALESCE(t.o_custkey, s.o_custkey) AS o_custkey,
       COALESCE(t.o_orderpriority, s.o_orderpriority) AS o_orderpriority,
       CASE WHEN s.o_custkey IS NOT NULL THEN s.o_orderkey ELSE t.o_orderkey END AS o_orderkey,
       CASE WHEN s.o_custkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice
FROM tgt t FULL JOIN src s ON t.o_custkey = s.o_custkey AND t.o_orderpriority = s.o_orderpriority
""")
def q_merge_composite(spark, d):
    """B2: composite key (customer, priority), last order by date wins."""
    from quartermaster.operators.merge import merge
    tgt = read_table(spark, d, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        F.element_at(F.array(F.lit("1-URGENT"), F.lit("2-HIGH"), F.lit("5-LOW")), (F.col("c_nationkey") % 3 + 1).cast("int"))
        .alias("o_orderpriority"),
        F.lit(-1).cast("bigint").alias("o_orderkey"), F.lit(-1.0).alias("o_totalprice"))
    return merge(tgt, read_table(spark, d, "orders"), ["o_custkey", "o_orderpriority"],
                 insert_cols=["o_orderkey", "o_totalprice"],
                 order_cols=["o_orderdate", "o_orderkey"])


@register("two_feeders", """
WITH f1 AS (SELECT p_partkey AS id, p_name AS name_en, p_brand AS short_name, p_type AS image,
                   p_type AS category FROM part),
f2 AS (SELECT p_partkey AS id, upper(p_name) AS name_en, p_brand AS image, 'Quest items' AS category
       FROM part WHERE p_size > 25),
t1 AS (SELECT id, name_en, short_name, image, category, CAST(NULL AS VARCHAR) AS name_kr FROM f1)
SELECT COALESCE(t.id, s.id) AS id,
       CASE WHEN s.id IS NOT NULL THEN s.name_en ELSE t.name_en END AS name_en,
       t.short_name AS short_name,
       CASE WHEN s.id IS NOT NULL THEN s.image ELSE t.image END AS image,
       CASE WHEN s.id IS NOT NULL THEN s.category ELSE t.category END AS category,
       t.name_kr AS name_kr
FROM t1 t FULL JOIN f2 s ON t.id = s.id
""")
def q_two_feeders(spark, d):
    """Two feeds into one table with different column subsets; the
    second feed keeps the first feed's short name."""
    from quartermaster.operators.merge import merge
    p = read_table(spark, d, "part")
    empty = spark.createDataFrame([], "id bigint, name_en string, short_name string, image string, "
                                      "category string, name_kr string")
    f1 = p.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name_en"),
                  F.col("p_brand").alias("short_name"), F.col("p_type").alias("image"),
                  F.col("p_type").alias("category"), F.col("p_partkey").alias("pos"))
    f2 = p.filter(F.col("p_size") > 25).select(
        F.col("p_partkey").alias("id"), F.upper("p_name").alias("name_en"),
        F.col("p_brand").alias("image"), F.lit("Quest items").alias("category"),
        F.col("p_partkey").alias("pos"))
    t1 = merge(empty, f1, "id", insert_cols=["name_en", "short_name", "image", "category"],
               order_cols="pos")
    return merge(t1, f2, "id", insert_cols=["name_en", "image", "category"], order_cols="pos")


@register("duplicate_key_check", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1
""")
def q_duplicate_key_check(spark, d):
    """B3 diagnostics: keys a set-based upsert would reject."""
    from quartermaster.operators.merge import duplicate_keys
    return duplicate_keys(read_table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


# ------------------------------------------------------------- search index

def _index_branches(spark, d):
    from quartermaster.operators.index import IndexBranch, IndexEmit
    r = read_table(spark, d, "region")
    n = read_table(spark, d, "nation")
    c = read_table(spark, d, "customer")
    s = read_table(spark, d, "supplier")
    p = read_table(spark, d, "part")
    o = read_table(spark, d, "orders")
    return [
        IndexBranch(r, [IndexEmit("지역 : ", "r_name", "/region/", "REGION")], "r_regionkey"),
        IndexBranch(n, [IndexEmit("국가 : ", "n_name", "/nation/", "NATION"),
                        IndexEmit("Nation : ", "n_name", "/nation/", "NATION")], "n_nationkey"),
        IndexBranch(c, [IndexEmit("고객 : ", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")),
                                  "/customer/", "CUSTOMER"),
                        IndexEmit("고객 지도 : ", "c_name", "/customer-map/", "CUSTOMER_MAP")],
                    "c_custkey"),
        IndexBranch(s, [IndexEmit("공급자 : ", "s_name", "/supplier", "SUPPLIER", with_id=False)],
                    "s_suppkey"),
        IndexBranch(p, [IndexEmit("부품 : ", "p_name", "/part?id=", "PART")], "p_partkey"),
        IndexBranch(o, [IndexEmit("주문 : ", "o_orderpriority", "/order?id=", "ORDER")], "o_orderkey"),
    ]


@register("search_index", """
WITH u AS (
  SELECT '지역 : ' || r_name AS value, '/region/' || CAST(r_regionkey AS VARCHAR) AS link,
         CAST(r_regionkey AS VARCHAR) AS page_value, 'REGION' AS type, 0 AS branch FROM region
  UNION ALL SELECT '국가 : ' || n_name, '/nation/' || CAST(n_nationkey AS VARCHAR), CAST(n_nationkey AS VARCHAR), 'NATION', 1 FROM nation
  UNION ALL SELECT 'Nation : ' || n_name, '/nation/' || CAST(n_nationkey AS VARCHAR), CAST(n_nationkey AS VARCHAR), 'NATION', 2 FROM nation
  UNION ALL SELECT '고객 : ' || CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name END, '/customer/' || CAST(c_custkey AS VARCHAR),
         CAST(c_custkey AS VARCHAR), 'CUSTOMER', 3 FROM customer
  UNION ALL SELECT '고객 지도 : ' || c_name, '/customer-map/' || CAST(c_custkey AS VARCHAR), CAST(c_custkey AS VARCHAR), 'CUSTOMER_MAP', 4 FROM customer
  UNION ALL SELECT '공급자 : ' || s_name, '/supplier', CAST(s_suppkey AS VARCHAR), 'SUPPLIER', 5 FROM supplier
  UNION ALL SELECT '부품 : ' || p_name, '/part?id=' || CAST(p_partkey AS VARCHAR), CAST(p_partkey AS VARCHAR), 'PART', 6 FROM part
  UNION ALL SELECT '주문 : ' || o_orderpriority, '/order?id=' || CAST(o_orderkey AS VARCHAR), CAST(o_orderkey AS VARCHAR), 'ORDER', 7 FROM orders)
SELECT value, link, page_value, type,
       CAST(ROW_NUMBER() OVER (ORDER BY branch, page_value, value NULLS FIRST, link) AS BIGINT) AS "order"
FROM u
""")
def q_search_index(spark, d):
    """U1-U5 + X1 (T11, T12) + W2 contiguous numbering."""
    from quartermaster.operators.index import search_index
    return search_index(_index_branches(spark, d))


# ------------------------------------------------------------------ routing

def part_items(spark, d) -> DataFrame:
    """Parts as catalogue items: category = p_type, parent = p_brand; the
    attribute bag is '{}' for PROMO parts, NULL for LARGE ones, else a
    one-key object."""
    p = read_table(spark, d, "part")
    props = (F.when(F.col("p_type") == "PROMO", F.lit("{}"))
             .when(F.col("p_type") == "LARGE", F.lit(None).cast("string"))
             .otherwise(F.to_json(F.struct(F.col("p_size").alias("size")))))
    return p.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
                    F.struct(F.col("p_type").alias("name"),
                             F.struct(F.col("p_brand").alias("name")).alias("parent")).alias("category"),
                    props.alias("properties"))


def _part_rules():
    from quartermaster.operators import routing as R
    f = R.Fields()
    return {
        "Gun": R.parent_nonempty(f, "Brand#1"),
        "Gun image": R.parent_empty_name_has(f, "Brand#1", ["red", "hot gear"]),
        "Headphones": R.category_is(f, "SMALL"),
        "Headwear": R.category_except_names(f, "MEDIUM", ["red widget", "blue bolt", "hot gear"]),
        "Provisions": R.categories_nonempty(f, ["ECONOMY", "STANDARD"]),
        "Key": R.parent_nonempty(f, "Brand#2"),
        "Loot": R.parents_or_category_except(f, ["Brand#3", "Brand#4", "Brand#5"], "LARGE",
                                             ["cold ring", "old rod"], "gear"),
        "Face Cover": R.category_is(f, "PROMO"),
        "Ammo": R.category_nonempty(f, "LARGE"),
    }


_PART_ITEMS_SQL = """
p AS (SELECT p_partkey AS id, p_name AS name, p_type AS cat, p_brand AS parent,
             CASE WHEN p_type = 'PROMO' THEN '{}' WHEN p_type = 'LARGE' THEN NULL
                  ELSE '{"size":' || CAST(p_size AS VARCHAR) || '}' END AS props FROM part),
b AS (SELECT *, COALESCE(len(json_keys(props)) > 0, TRUE) AS ne,
                COALESCE(len(json_keys(props)) = 0, FALSE) AS em FROM p)"""


@register("route_counts", f"""
WITH {_PART_ITEMS_SQL}
SELECT 'Gun' AS route, COUNT(*) AS n FROM b WHERE parent = 'Brand#1' AND ne HAVING COUNT(*) > 0
UNION ALL SELECT 'Gun image', COUNT(*) FROM b WHERE parent = 'Brand#1' AND em
  AND (contains(name, 'red') OR contains(name, 'hot gear')) HAVING COUNT(*) > 0
UNION ALL SELECT 'Headphones', COUNT(*) FROM b WHERE cat = 'SMALL' HAVING COUNT(*) > 0
UNION ALL SELECT 'Headwear', COUNT(*) FROM b WHERE cat = 'MEDIUM'
  AND name NOT IN ('red widget', 'blue bolt', 'hot gear') HAVING COUNT(*) > 0
UNION ALL SELECT 'Provisions', COUNT(*) FROM b WHERE cat IN ('ECONOMY', 'STANDARD') AND ne HAVING COUNT(*) > 0
UNION ALL SELECT 'Key', COUNT(*) FROM b WHERE parent = 'Brand#2' AND ne HAVING COUNT(*) > 0
UNION ALL SELECT 'Loot', COUNT(*) FROM b WHERE (parent IN ('Brand#3', 'Brand#4', 'Brand#5') OR cat = 'LARGE')
  AND name NOT IN ('cold ring', 'old rod') AND NOT contains(name, 'gear') HAVING COUNT(*) > 0
UNION ALL SELECT 'Face Cover', COUNT(*) FROM b WHERE cat = 'PROMO' HAVING COUNT(*) > 0
UNION ALL SELECT 'Ammo', COUNT(*) FROM b WHERE cat = 'LARGE' AND ne HAVING COUNT(*) > 0
""")
def q_route_counts(spark, d):
    """C5 a-i: one-pass routing with the nine rule shapes."""
    from quartermaster.operators.routing import route_counts
    return route_counts(part_items(spark, d), _part_rules())


@register("route_rows", f"""
WITH {_PART_ITEMS_SQL}
SELECT id, 'Gun image' AS route FROM b WHERE parent = 'Brand#1' AND em
  AND (contains(name, 'red') OR contains(name, 'hot gear'))
UNION ALL SELECT id, 'Loot' FROM b WHERE (parent IN ('Brand#3', 'Brand#4', 'Brand#5') OR cat = 'LARGE')
  AND name NOT IN ('cold ring', 'old rod') AND NOT contains(name, 'gear')
""")
def q_route_rows(spark, d):
    """C5b + C5g: the routed rows themselves (ids and target)."""
    from quartermaster.operators.routing import route
    rules = {k: v for k, v in _part_rules().items() if k in ("Gun image", "Loot")}
    return route(part_items(spark, d), rules).select("id", "route")


# --------------------------------------------------------- attribute bags

def event_bags(spark, d) -> DataFrame:
    e = read_table(spark, d, "events")
    props = (F.when(F.col("event_type") == "signup", F.lit("{}"))
             .when(F.col("event_type") == "error", F.lit(None).cast("string"))
             .when(F.col("event_type") == "view", F.lit('{"k": null}'))
             .otherwise(F.col("props")))
    return e.select("event_id", props.alias("properties"))


_BAGS_SQL = """
e AS (SELECT event_id, CASE WHEN event_type = 'signup' THEN '{}' WHEN event_type = 'error' THEN NULL
                            WHEN event_type = 'view' THEN '{"k": null}' ELSE props END AS props FROM events)"""


@register("bag_nonempty", f"""
WITH {_BAGS_SQL}
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM e
WHERE COALESCE(len(json_keys(props)) > 0, TRUE)
""")
def q_bag_nonempty(spark, d):
    """A6 + C3 (T1): ``{}`` is empty, ``{"k": null}`` and NULL are not;
    the bag is decoded with its member schema."""
    from quartermaster.functions.predicates import bag_nonempty
    from quartermaster.sources.documents import decode_variant
    b = event_bags(spark, d)
    return b.filter(bag_nonempty("properties")).select(
        "event_id", decode_variant("properties", "k int")["k"].alias("k"))


@register("bag_empty", f"""
WITH {_BAGS_SQL}
SELECT event_id FROM e WHERE COALESCE(len(json_keys(props)) = 0, FALSE)
""")
def q_bag_empty(spark, d):
    """C4: ``properties == {}``."""
    from quartermaster.functions.predicates import bag_empty
    return event_bags(spark, d).filter(bag_empty("properties")).select("event_id")


# ------------------------------------------------------- nested documents

def station_docs(spark, d) -> DataFrame:
    """Station documents built from each order's own columns (two levels,
    one or two item requirements per level, an empty list for finished
    orders, one craft), serialised to JSON text and read back with the
    station schema (A3)."""
    from quartermaster.sources.documents import STATION_SCHEMA
    o = read_table(spark, d, "orders", spread=True)
    sid = F.col("o_orderkey").cast("string")

    def req(level, tag, name, qty, cnt):
        return F.struct(F.concat(sid, F.lit(f"-{level}-{tag}")).alias("id"),
                        F.struct(name.alias("name")).alias("item"),
                        F.lit(qty).alias("quantity"), F.lit(cnt).alias("count"))

    bonuses = F.array(
        F.struct(F.lit("SkillBoost").alias("type"), F.col("o_orderpriority").alias("name"),
                 F.col("o_totalprice").alias("value"),
                 F.when(F.col("o_orderstatus") == "F", F.lit("")).otherwise(F.lit("Strength"))
                 .alias("skillName")),
        F.struct(F.when(F.col("o_orderstatus") == "O", F.lit("SkillBoost")).otherwise(F.lit("Rate"))
                 .alias("type"), F.lit("later").alias("name"),
                 F.col("o_custkey").cast("double").alias("value"),
                 F.lit(None).cast("string").alias("skillName")))
    traders = F.array(F.struct(
        F.concat(sid, F.lit("-t")).alias("id"), F.lit("loyaltyLevel").alias("requirementType"),
        (F.col("o_custkey") % 4).cast("int").alias("value"),
        F.when(F.col("o_orderstatus") != "P", F.struct(
            F.col("o_orderpriority").alias("name"),
            F.concat(F.lit("/trader/"), F.col("o_orderpriority")).alias("imageLink"))).alias("trader"),
        F.lit(">=").alias("compareMethod")))

    bonus_t = "array<struct<type:string,name:string,value:double,skillName:string>>"
    trader_t = ("array<struct<id:string,requirementType:string,value:int,"
                "trader:struct<name:string,imageLink:string>,compareMethod:string>>")

    skill_t = "array<struct<id:string,name:string,level:int,skill:struct<id:string,name:string>>>"
    needs_t = "array<struct<id:string,level:int,station:struct<name:string,imageLink:string>>>"
    skills = F.array(F.struct(
        F.concat(sid, F.lit("-s")).alias("id"), F.lit("unused").alias("name"),
        (F.col("o_custkey") % 5).cast("int").alias("level"),
        F.when(F.col("o_orderstatus") != "P", F.struct(F.lit("k").alias("id"), F.col("o_orderpriority").alias("name")))
        .alias("skill")))
    needs = F.array(*[F.struct(
        F.concat(sid, F.lit(f"-n{i}")).alias("id"), (F.col("o_custkey") % 3 + i).cast("int").alias("level"),
        F.when(F.col("o_orderstatus") != "F", F.struct(
            F.concat(F.lit("station "), (F.col("o_custkey") + i).cast("string")).alias("name"),
            F.lit("/station").alias("imageLink"))).alias("station")) for i in (0, 1)])

    def level(k, reqs):
        b = bonuses if k == 1 else F.array().cast(bonus_t)
        t = traders if k == 2 else F.array().cast(trader_t)
        s = skills if k == 1 else F.array().cast(skill_t)
        n = needs if k == 2 else F.array().cast(needs_t)
        return F.struct(F.concat(sid, F.lit(f"-{k}")).alias("id"), F.lit(k).alias("level"),
                        (F.col("o_custkey") * k).alias("constructionTime"),
                        reqs.alias("itemRequirements"), b.cast(bonus_t).alias("bonuses"),
                        s.cast(skill_t).alias("skillRequirements"), n.cast(needs_t).alias("stationLevelRequirements"),
                        t.cast(trader_t).alias("traderRequirements"))

    lvl2 = F.when(F.col("o_orderstatus") == "F", F.array().cast(
        "array<struct<id:string,item:struct<name:string>,quantity:int,count:int>>")).otherwise(
        F.array(req(2, "a", F.col("o_orderpriority"), 2, 1), req(2, "b", F.col("o_orderstatus"), 2, 2)))
    crafts = F.array(F.struct(
        F.concat(sid, F.lit("-c")).alias("id"),
        F.struct(sid.alias("id")).alias("station"), F.lit(1).alias("level"),
        F.when(F.col("o_orderstatus") == "F", F.array().cast("array<struct<item:struct<name:string>>>"))
        .otherwise(F.array(F.struct(F.struct(F.col("o_orderpriority").alias("name")).alias("item"))))
        .alias("rewardItems")))
    doc = F.struct(F.col("o_orderkey").alias("pos"), sid.alias("id"),
                   F.concat(F.lit("station "), sid).alias("name"),
                   F.array(level(1, F.array(req(1, "a", F.col("o_orderpriority"), 1, 1))),
                           level(2, lvl2)).alias("levels"),
                   crafts.alias("crafts"))
    text = o.select(F.to_json(doc).alias("json"))
    return text.select(F.from_json("json", STATION_SCHEMA).alias("s")).select("s.*")


@register("unnest_levels", """
SELECT CAST(o_orderkey AS VARCHAR) AS station_id, CAST(o_orderkey AS VARCHAR) || '-1' AS level_id,
       1 AS level, CAST(o_custkey AS INTEGER) AS construction_time FROM orders
UNION ALL
SELECT CAST(o_orderkey AS VARCHAR), CAST(o_orderkey AS VARCHAR) || '-2', 2, CAST(o_custkey * 2 AS INTEGER) FROM orders
""")
def q_unnest_levels(spark, d):
    """A3 + N1: station -> level."""
    from quartermaster.operators.nested import unnest
    lv = unnest(station_docs(spark, d), "levels", keep=[F.col("id").alias("station_id")], alias="lv")
    return lv.select("station_id", F.col("lv.id").alias("level_id"), F.col("lv.level").alias("level"),
                     F.col("lv.constructionTime").alias("construction_time"))


@register("unnest_children", """
SELECT CAST(o_orderkey AS VARCHAR) || '-1-a' AS id, CAST(o_orderkey AS VARCHAR) || '-1' AS level_id,
       o_orderpriority AS name_en, 1 AS quantity, 1 AS count FROM orders
UNION ALL SELECT CAST(o_orderkey AS VARCHAR) || '-2-a', CAST(o_orderkey AS VARCHAR) || '-2', o_orderpriority, 2, 1
  FROM orders WHERE o_orderstatus <> 'F'
UNION ALL SELECT CAST(o_orderkey AS VARCHAR) || '-2-b', CAST(o_orderkey AS VARCHAR) || '-2', o_orderstatus, 2, 2
  FROM orders WHERE o_orderstatus <> 'F'
""")
def q_unnest_children(spark, d):
    """Station -> level -> requirement, carrying ``level_id``; empty
    lists yield no rows."""
    from quartermaster.operators.nested import unnest2
    r = unnest2(station_docs(spark, d), "levels", "itemRequirements")
    return r.select("id", "level_id", F.col("item.name").alias("name_en"), "quantity", "count")


@register("collect_child_ids", """
SELECT CAST(o_orderkey AS VARCHAR) AS station_id,
       CAST(o_orderkey AS VARCHAR) || '-1,' || CAST(o_orderkey AS VARCHAR) || '-2' AS level_ids FROM orders
""")
def q_collect_child_ids(spark, d):
    """Child ids in document order, within the document."""
    from quartermaster.operators.nested import child_ids
    s = station_docs(spark, d)
    return s.select(F.col("id").alias("station_id"),
                    F.array_join(child_ids("levels"), ",").alias("level_ids"))


@register("first_child", """
SELECT CAST(o_orderkey AS VARCHAR) || '-c' AS id, CAST(o_orderkey AS VARCHAR) || '-1' AS level_id,
       CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS name_en FROM orders
""")
def q_first_child(spark, d):
    """Craft -> first reward name (NULL for an empty list),
    key text ``station-level``."""
    from quartermaster.functions.scalars import composite_text
    from quartermaster.operators.nested import first_child, unnest
    c = unnest(station_docs(spark, d), "crafts", alias="c")
    return c.select(F.col("c.id").alias("id"),
                    composite_text(F.col("c.station.id"), F.col("c.level")).alias("level_id"),
                    first_child("c.rewardItems").alias("name_en"))


@register("first_per_key", """
SELECT o_custkey, o_orderkey AS first_order FROM (
  SELECT o_custkey, o_orderkey, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders) WHERE rn = 1
""")
def q_first_per_key(spark, d):
    """G2 across rows: first order per customer (partial + final min_by)."""
    from quartermaster.operators.nested import first_per_key
    return first_per_key(read_table(spark, d, "orders"), "o_custkey", "o_orderkey",
                         ["o_orderdate", "o_orderkey"], value_alias="first_order")


@register("last_map_per_key", """
SELECT user_id AS key, event_type AS value FROM (
  SELECT user_id, event_type, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1
""")
def q_last_map_per_key(spark, d):
    """E4 (T17): last assignment wins, by document order."""
    from quartermaster.operators.nested import last_value_per_key
    return last_value_per_key(read_table(spark, d, "events"), "user_id", "event_type",
                              ["ts", "event_id"])


@register("ordered_unnest", """
SELECT CAST(o_orderkey AS VARCHAR) AS station_id, 0 AS outer_pos, 0 AS inner_pos,
       CAST(o_orderkey AS VARCHAR) || '-1-a' AS req_id FROM orders
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 1, 0, CAST(o_orderkey AS VARCHAR) || '-2-a' FROM orders WHERE o_orderstatus <> 'F'
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 1, 1, CAST(o_orderkey AS VARCHAR) || '-2-b' FROM orders WHERE o_orderstatus <> 'F'
""")
def q_ordered_unnest(spark, d):
    """Two-level unnest keeping both positions."""
    from quartermaster.operators.nested import ordered_unnest2
    r = ordered_unnest2(station_docs(spark, d), "levels", "itemRequirements", keep=["id"])
    return r.select(F.col("id").alias("station_id"), "outer_pos", "inner_pos",
                    F.col("inner.id").alias("req_id"))


# ------------------------------------------------------ lookups and labels

def _suffix():
    """Image-name suffixes of three lengths (8, 7, 6 characters)."""
    return (F.when(F.col("p_partkey") % 3 == 0, F.lit(" Default"))
            .when(F.col("p_partkey") % 3 == 1, F.lit(" Urbana")).otherwise(F.lit(" Zenit")))


def _strip_sql(n):
    return f"""s{n} AS (SELECT k, img FROM (
  SELECT left(sn, greatest(length(sn) - {n}, 0)) AS k, img,
         ROW_NUMBER() OVER (PARTITION BY left(sn, greatest(length(sn) - {n}, 0)) ORDER BY pos DESC) AS rn
  FROM cand) WHERE rn = 1)"""


@register("fallback_lookup", f"""
WITH cand AS (
  SELECT p_partkey AS pos, CASE WHEN p_size % 3 > 0 THEN 'img-' || CAST(p_partkey AS VARCHAR) END AS img,
         p_type || CASE WHEN p_partkey % 3 = 0 THEN ' Default' WHEN p_partkey % 3 = 1 THEN ' Urbana' ELSE ' Zenit' END AS sn
  FROM part),
{_strip_sql(8)}, {_strip_sql(7)}, {_strip_sql(6)},
w AS (SELECT p_partkey, p_name, CASE WHEN p_size < 40 THEN p_type ELSE p_name END AS short_name FROM part)
SELECT w.p_partkey,
       CASE WHEN w.p_name = 'red widget' THEN 'override-image' WHEN s8.k IS NOT NULL THEN s8.img
            WHEN s7.k IS NOT NULL THEN s7.img WHEN s6.k IS NOT NULL THEN s6.img
            ELSE 'own-' || CAST(w.p_partkey AS VARCHAR) END AS image
FROM w LEFT JOIN s8 ON w.short_name = s8.k LEFT JOIN s7 ON w.short_name = s7.k
LEFT JOIN s6 ON w.short_name = s6.k
""")
def q_fallback_lookup(spark, d):
    """D9 + X3 (T16): image by suffix-stripped short name, strip lengths in
    priority 8, 7, 6, last-wins within a length; override first, own value
    last; a matching candidate without an image gives NULL."""
    from quartermaster.operators.lookup import lookup_first
    p = read_table(spark, d, "part")
    cand = p.select(F.concat(F.col("p_type"), _suffix()).alias("sn"),
                    F.when(F.col("p_size") % 3 > 0, F.concat(F.lit("img-"), F.col("p_partkey").cast("string"))).alias("img"),
                    F.col("p_partkey").alias("pos"))
    w = p.select("p_partkey", "p_name",
                 F.when(F.col("p_size") < 40, F.col("p_type")).otherwise(F.col("p_name")).alias("short_name"))
    out = lookup_first(w, "short_name", cand, "sn", "img", [8, 7, 6], "image", order="pos",
                       override=F.when(F.col("p_name") == "red widget", F.lit("override-image")),
                       own=F.concat(F.lit("own-"), F.col("p_partkey").cast("string")))
    return out.select("p_partkey", "image")


@register("override_chain", """
WITH km AS (SELECT p_name AS k, arg_max(p_type, p_partkey) AS v FROM part
            WHERE p_type = 'PROMO' AND p_size > 45 GROUP BY p_name)
SELECT p_partkey,
       CASE WHEN p_name = 'red widget' THEN 'A|B' WHEN p_name = 'small ring' THEN 'C'
            WHEN contains(p_name, 'gear') THEN 'GEAR' WHEN contains(p_name, 'bolt') THEN 'BOLT'
            ELSE COALESCE(km.v, 'N/A') END AS codes
FROM part LEFT JOIN km ON p_name = km.k
""")
def q_override_chain(spark, d):
    """D10 + E4 + X4: fixed list > name-contains rules > joined last-wins
    dictionary > default."""
    from quartermaster.operators.lookup import override_chain
    from quartermaster.operators.nested import last_value_per_key
    p = read_table(spark, d, "part")
    km = last_value_per_key(p.filter((F.col("p_type") == "PROMO") & (F.col("p_size") > 45)),
                            "p_name", F.array("p_type"), ["p_partkey"], key_alias="__k", value_alias="__v")
    j = p.join(km, p["p_name"] == km["__k"], "left")
    codes = override_chain("p_name", {"red widget": ["A", "B"], "small ring": ["C"]},
                           [("gear", ["GEAR"]), ("bolt", ["BOLT"])], F.col("__v"), ["N/A"])
    return j.select("p_partkey", F.array_join(codes, "|").alias("codes"))


@register("label_default", """
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'b' WHEN 'MACHINERY' THEN 'm'
                                    WHEN 'FURNITURE' THEN 'f' ELSE '' END AS label FROM customer
""")
def q_label_default(spark, d):
    """L1/L2 shape: dictionary with a literal default."""
    from quartermaster.functions.labels import label_value
    c = read_table(spark, d, "customer")
    return c.select("c_custkey", label_value("c_mktsegment", {"BUILDING": "b", "MACHINERY": "m",
                                                              "FURNITURE": "f"}, default="").alias("label"))


@register("label_passthrough", """
SELECT p_partkey, COALESCE(CASE p_type WHEN 'STANDARD' THEN 'std' WHEN 'ECONOMY' THEN 'eco'
                                       WHEN 'PROMO' THEN 'promo' END, p_type) AS label FROM part
""")
def q_label_passthrough(spark, d):
    """A9 + D11 + L4-L6 shape: parameter table joined (checked broadcast),
    unknown values pass through."""
    from quartermaster.functions.labels import label
    from quartermaster.sources.tables import lookup_from_pairs
    lk = lookup_from_pairs(spark, [("STANDARD", "std"), ("ECONOMY", "eco"), ("PROMO", "promo")],
                           "k string, v string")
    p = read_table(spark, d, "part").select("p_partkey", "p_type")
    return label(p, "p_type", lk, "k", "v", "label").select("p_partkey", "label")


@register("label_null", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'U' WHEN '2-HIGH' THEN 'H' END AS label FROM orders
""")
def q_label_null(spark, d):
    """L9 shape: unknown gives NULL."""
    from quartermaster.functions.labels import label_value
    o = read_table(spark, d, "orders")
    return o.select("o_orderkey", label_value("o_orderpriority", {"1-URGENT": "U", "2-HIGH": "H"},
                                              default=None).alias("label"))


@register("label_override", """
SELECT event_id,
       CASE WHEN v IS NOT NULL THEN COALESCE(CASE event_type WHEN 'click' THEN 1.5 WHEN 'view' THEN 2.5 END, v) END AS v
FROM (SELECT event_id, event_type, CASE WHEN event_type <> 'error' THEN value END AS v FROM events)
""")
def q_label_override(spark, d):
    """Override by name only when the value is present."""
    from quartermaster.functions.labels import override_when_present
    e = read_table(spark, d, "events")
    v = F.when(F.col("event_type") != "error", F.col("value"))
    return e.select("event_id", override_when_present(v, "event_type", {"click": 1.5, "view": 2.5})
                    .cast("double").alias("v"))


_TOKENS = {"red": "R", "blue": "B", "ring": "RING", "bolt": "BOLT", "crimson": "C"}


def _case_sql(mapping, var="x"):
    return "CASE " + var + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


@register("relabel_drop", f"""
SELECT p_partkey, array_to_string(list_filter(list_transform(string_split(p_name, ' '),
       lambda x: {_case_sql(_TOKENS)}), lambda y: y IS NOT NULL), ' ') AS label FROM part
""")
def q_relabel_drop(spark, d):
    """Unknown elements dropped."""
    from quartermaster.functions.labels import relabel_array
    p = read_table(spark, d, "part")
    return p.select("p_partkey", F.array_join(relabel_array(F.split("p_name", " "), _TOKENS, "drop"),
                                              " ").alias("label"))


@register("relabel_default", f"""
SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '),
       lambda x: COALESCE({_case_sql(_TOKENS)}, '?')), ' ') AS label FROM part
""")
def q_relabel_default(spark, d):
    """Unknown elements replaced by a default."""
    from quartermaster.functions.labels import relabel_array
    p = read_table(spark, d, "part")
    return p.select("p_partkey", F.array_join(
        relabel_array(F.split("p_name", " "), _TOKENS, "default", "?"), " ").alias("label"))


@register("relabel_pass", f"""
SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '),
       lambda x: COALESCE({_case_sql(_TOKENS)}, x)), ' ') AS label FROM part
""")
def q_relabel_pass(spark, d):
    """Unknown elements passed through."""
    from quartermaster.functions.labels import relabel_array
    p = read_table(spark, d, "part")
    return p.select("p_partkey", F.array_join(
        relabel_array(F.split("p_name", " "), _TOKENS, "passthrough"), " ").alias("label"))


#: words of a part's name, with 'hot' missing, under a key that repeats
_SPARSE_SQL = "list_transform(string_split(p_name, ' '), lambda x: CASE WHEN x <> 'hot' THEN x END)"


def _relabel_table(spark, d, policy):
    from quartermaster.functions.labels import relabel_array_table
    from quartermaster.sources.tables import lookup_from_pairs
    pairs = [(k, "stale", 0) for k in _TOKENS] + [(k, v, 1) for k, v in _TOKENS.items()]
    lk = lookup_from_pairs(spark, pairs, "k string, v string, pos int")
    p = read_table(spark, d, "part").select("p_size", F.transform(
        F.split("p_name", " "), lambda x: F.when(x != "hot", x)).alias("toks"))
    r = relabel_array_table(p, "toks", lk, "k", "v", "lab", policy=policy, order="pos")
    shown = F.array_join(F.transform("lab", lambda x: F.coalesce(x, F.lit("~"))), " ")
    return r.groupBy("p_size", shown.alias("label")).agg(F.count(F.lit(1)).alias("n"))


@register("relabel_table", f"""
SELECT p_size, array_to_string(list_filter(list_transform({_SPARSE_SQL},
       lambda x: {_case_sql(_TOKENS)}), lambda y: y IS NOT NULL), ' ') AS label, COUNT(*) AS n FROM part GROUP BY ALL
""")
def q_relabel_table(spark, d):
    """I1 with the dictionary as a parameter table with repeated keys (the
    last one by position counts), arrays with NULL elements, rows without a
    unique key."""
    return _relabel_table(spark, d, "drop")


@register("relabel_table_pass", f"""
SELECT p_size, array_to_string(list_transform({_SPARSE_SQL},
       lambda x: COALESCE({_case_sql(_TOKENS)}, x, '~')), ' ') AS label, COUNT(*) AS n FROM part GROUP BY ALL
""")
def q_relabel_table_pass(spark, d):
    """I3 in the table form: unknown and NULL elements stay in place."""
    return _relabel_table(spark, d, "passthrough")


@register("normalise_element", f"""
SELECT p_partkey, array_to_string(list_transform(
         list_transform(string_split(p_name, ' '), lambda x: CASE WHEN x = 'red' THEN 'crimson' ELSE x END),
       lambda x: COALESCE({_case_sql(_TOKENS)}, '?')), ' ') AS label FROM part
""")
def q_normalise_element(spark, d):
    """I4 then I2: rename one element value, then relabel with a default."""
    from quartermaster.functions.labels import normalise_element, relabel_array
    p = read_table(spark, d, "part")
    arr = normalise_element(F.split("p_name", " "), "red", "crimson")
    return p.select("p_partkey", F.array_join(relabel_array(arr, _TOKENS, "default", "?"), " ")
                    .alias("label"))


_SUB_RULES = [("e", "E"), ("o", "O"), ("ol", "OL"), ("zz", "ZZ")]


@register("substring_rules", """
SELECT p_partkey, array_to_string(flatten(list_transform(string_split(p_name, ' '), lambda x:
   list_filter([CASE WHEN contains(x, 'e') THEN 'E' END, CASE WHEN contains(x, 'o') THEN 'O' END,
                CASE WHEN contains(x, 'ol') THEN 'OL' END, CASE WHEN contains(x, 'zz') THEN 'ZZ' END],
               lambda y: y IS NOT NULL))), ',') AS modes FROM part
""")
def q_substring_rules(spark, d):
    """Every element emits every matching rule's label, in order."""
    from quartermaster.functions.labels import substring_rules
    p = read_table(spark, d, "part")
    return p.select("p_partkey", F.array_join(substring_rules(F.split("p_name", " "), _SUB_RULES), ",")
                    .alias("modes"))


@register("recategorise", """
SELECT p_partkey, CASE WHEN p_type IN ('PROMO', 'LARGE') THEN 'Special'
                       WHEN p_name IN ('red widget', 'blue bolt') THEN 'Jewelry'
                       WHEN p_brand = 'Brand#1' THEN 'Branded' ELSE p_type END AS category FROM part
""")
def q_recategorise(spark, d):
    """Ordered rule chain, first match wins."""
    from quartermaster.functions.labels import first_match
    p = read_table(spark, d, "part")
    cat = first_match([(F.col("p_type").isin("PROMO", "LARGE"), "Special"),
                       (F.col("p_name").isin("red widget", "blue bolt"), "Jewelry"),
                       (F.col("p_brand") == "Brand#1", "Branded")], F.col("p_type"))
    return p.select("p_partkey", cat.alias("category"))


@register("bucket", """
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN d IS NULL THEN NULL WHEN d < 0.02 THEN 'Low' WHEN d < 0.04 THEN 'Medium' ELSE 'High' END AS b
FROM (SELECT *, CASE WHEN l_returnflag <> 'N' THEN l_discount END AS d FROM lineitem)
""")
def q_bucket(spark, d):
    """X8 (T3): half-open thresholds, NULL stays NULL."""
    from quartermaster.functions.labels import bucket
    li = read_table(spark, d, "lineitem")
    v = F.when(F.col("l_returnflag") != "N", F.col("l_discount"))
    return li.select("l_orderkey", "l_linenumber", "l_partkey",
                     bucket(v, [0.02, 0.04], ["Low", "Medium", "High"]).alias("b"))


@register("json_encode", """
SELECT o_orderkey, 4 AS n_keys, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS price,
       o_orderpriority AS prio FROM orders
""")
def q_json_encode(spark, d):
    """X11 (T13): JSON text keeps null fields; compared after parsing."""
    from quartermaster.functions.scalars import json_text
    o = read_table(spark, d, "orders", spread=True)
    j = json_text(F.struct("o_orderkey", "o_orderpriority",
                           F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("price"),
                           F.lit(None).cast("string").alias("note")))
    t = o.select("o_orderkey", j.alias("j"))
    return t.select("o_orderkey", F.size(F.json_object_keys("j")).alias("n_keys"),
                    F.get_json_object("j", "$.price").cast("double").alias("price"),
                    F.get_json_object("j", "$.o_orderpriority").alias("prio"))


@register("falsy_null", """
SELECT p_partkey, NULLIF(CASE WHEN p_type = 'PROMO' THEN '' ELSE p_brand END, '') AS v FROM part
""")
def q_falsy_null(spark, d):
    """X10 (T15): empty text becomes NULL."""
    from quartermaster.functions.scalars import falsy_to_null
    p = read_table(spark, d, "part")
    return p.select("p_partkey", falsy_to_null(
        F.when(F.col("p_type") == "PROMO", F.lit("")).otherwise(F.col("p_brand"))).alias("v"))


@register("composite_text", """
SELECT c_custkey,
       CAST(CASE WHEN c_mktsegment <> 'BUILDING' THEN c_nationkey END AS VARCHAR) || '-' || CAST(c_custkey AS VARCHAR) AS k,
       COALESCE(CAST(CASE WHEN c_mktsegment <> 'BUILDING' THEN c_nationkey END AS VARCHAR), 'None') || '-' || CAST(c_custkey AS VARCHAR) AS k_none
FROM customer
""")
def q_composite_text(spark, d):
    """X2 (T14): NULL part gives a NULL key, or the 'None' text variant."""
    from quartermaster.functions.scalars import composite_text
    c = read_table(spark, d, "customer")
    nk = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_nationkey"))
    return c.select("c_custkey", composite_text(nk, "c_custkey").alias("k"),
                    composite_text(nk, "c_custkey", null_text="None").alias("k_none"))


@register("conditional_group", """
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN l_returnflag = 'A' THEN l_quantity END AS q,
       CASE WHEN l_returnflag = 'A' THEN l_discount END AS disc FROM lineitem
""")
def q_conditional_group(spark, d):
    """A column group filled only when a field is present."""
    from quartermaster.operators.routing import when_present
    li = read_table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey",
                     *when_present(F.col("l_returnflag") == "A",
                                   {"q": F.col("l_quantity"), "disc": F.col("l_discount")}))


# ------------------------------------------------------------------ effects

_SKILL_OF_PRIORITY = {"1-URGENT": "Health", "2-HIGH": "Strength", "3-MEDIUM": "Memory",
                      "4-NOT SPECIFIED": "Juggling"}
_TYPE_OF_STATUS = {"F": "Pain", "O": "Energy recovery", "P": "Mystery"}


def order_effects(spark, d) -> DataFrame:
    """Two effects per order built from its own columns: a skill effect
    whose sign follows the price, and a typed effect of opposite sign."""
    from quartermaster.functions.effects import EFFECT_DDL
    from quartermaster.functions.labels import lookup
    o = read_table(spark, d, "orders", spread=True)
    v = F.col("o_totalprice") / 10000 - 25
    e1 = F.struct(F.lit(0).alias("delay"), v.alias("value"), F.lit("Skill").alias("type"),
                  lookup("o_orderpriority", _SKILL_OF_PRIORITY).alias("skillName"),
                  F.lit(0).alias("duration"), F.lit(1.0).alias("chance"),
                  F.lit(None).cast("string").alias("krSkill"))
    e2 = F.struct(F.lit(1).alias("delay"), (-v).alias("value"),
                  lookup("o_orderstatus", _TYPE_OF_STATUS).alias("type"),
                  F.lit(None).cast("string").alias("skillName"), F.lit(10).alias("duration"),
                  F.lit(0.5).alias("chance"), F.lit(None).cast("string").alias("krSkill"))
    return o.select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_custkey",
                    F.array(e1, e2).cast(f"array<{EFFECT_DDL}>").alias("effects"))


def _kr_case(mapping, var):
    return "CASE " + var + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


def _effects_sql():
    from quartermaster.functions import vocab as V
    skill = _kr_case(_SKILL_OF_PRIORITY, "o_orderpriority")
    typ = _kr_case(_TYPE_OF_STATUS, "o_orderstatus")
    return f"""
SELECT o_orderkey, 0 AS pos, {_kr_case(V.MED_SKILL_KR, skill)} AS krSkill FROM orders
UNION ALL
SELECT o_orderkey, 1, {_kr_case(V.MED_TYPE_KR, typ)} FROM orders"""


@register("annotate_effects", _effects_sql())
def q_annotate_effects(spark, d):
    """Skill label for known skills, else type label, else NULL."""
    from quartermaster.functions import vocab as V
    from quartermaster.functions.effects import annotate
    e = order_effects(spark, d)
    a = e.select("o_orderkey", F.posexplode(annotate("effects", V.MED_SKILL_KR, V.MED_TYPE_KR))
                 .alias("pos", "e"))
    return a.select("o_orderkey", "pos", F.col("e.krSkill").alias("krSkill"))


@register("append_effect", """
SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 3 ELSE 2 END AS n_effects,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'painkillerDuration' WHEN '2-HIGH' THEN 'Skill'
            ELSE CASE o_orderstatus WHEN 'F' THEN 'Pain' WHEN 'O' THEN 'Energy recovery' WHEN 'P' THEN 'Mystery' END
       END AS last_type,
       CASE o_orderpriority WHEN '1-URGENT' THEN 120 WHEN '2-HIGH' THEN 210 ELSE 10 END AS last_duration
FROM orders
""")
def q_append_effect(spark, d):
    """Append the effect registered for a name."""
    from quartermaster.functions.effects import append_by_name, effect
    table = {"1-URGENT": effect(delay=0, value=0.0, type="painkillerDuration", duration=120, chance=1.0),
             "2-HIGH": effect(delay=1, value=1.0, type="Skill", skillName="Painkiller", duration=210,
                              krSkill="진통제")}
    e = order_effects(spark, d).select("o_orderkey",
                                       append_by_name("effects", "o_orderpriority", table).alias("a"))
    last = F.element_at("a", -1)
    return e.select("o_orderkey", F.size("a").alias("n_effects"), last["type"].alias("last_type"),
                    last["duration"].alias("last_duration"))


def _reclassify_sql():
    from quartermaster.functions import vocab as V
    types = ", ".join(f"'{t}'" for _, t, _ in V.RECLASSIFIED_EFFECTS)
    values = ", ".join(f"{float(v)}" for _, _, v in V.RECLASSIFIED_EFFECTS)
    durations = ", ".join(str(x) for x, _, _ in V.RECLASSIFIED_EFFECTS)
    typ = "CASE o_orderstatus WHEN 'F' THEN 'Pain' WHEN 'O' THEN 'Energy recovery' WHEN 'P' THEN 'Mystery' END"
    low = "o_orderpriority = '5-LOW'"
    return f"""
SELECT o_orderkey, CASE WHEN {low} THEN 'Stimulant' ELSE o_orderstatus END AS category,
       CASE WHEN {low} THEN NULL ELSE o_custkey END AS uses,
       array_to_string(CASE WHEN {low} THEN [{types}] ELSE ['Skill', {typ}] END, '|') AS types,
       list_sum(CASE WHEN {low} THEN [{values}]
                ELSE [o_totalprice / 10000 - 25, -(o_totalprice / 10000 - 25)] END) AS value_sum,
       CAST(list_sum(CASE WHEN {low} THEN [{durations}] ELSE [0, 10] END) AS BIGINT) AS duration_sum
FROM orders"""


@register("reclassify", _reclassify_sql())
def q_reclassify(spark, d):
    """I8: one product reclassified - category changed, fields removed, a
    constant effect list installed."""
    from quartermaster.functions.effects import reclassified_effects, reclassify
    cols = reclassify(F.col("o_orderpriority") == "5-LOW",
                      {"category": F.lit("Stimulant"), "uses": F.lit(None).cast("bigint"),
                       "effects": reclassified_effects()},
                      {"o_orderkey": F.col("o_orderkey"), "category": F.col("o_orderstatus"),
                       "uses": F.col("o_custkey"), "effects": F.col("effects")})
    r = order_effects(spark, d).select(*cols)
    add = lambda a, b: a + b
    return r.select("o_orderkey", "category", "uses", F.array_join("effects.type", "|").alias("types"),
                    F.aggregate("effects.value", F.lit(0.0), add).alias("value_sum"),
                    F.aggregate("effects.duration", F.lit(0), add).cast("bigint").alias("duration_sum"))


def event_effects(spark, d) -> DataFrame:
    e = read_table(spark, d, "events")
    typ = (F.when(F.col("event_type") == "click", "Energy recovery")
           .when(F.col("event_type") == "error", "Pain")
           .when(F.col("event_type") == "view", "Body temperature")
           .when(F.col("event_type") == "purchase", "Skill")
           .otherwise("painkillerDuration"))
    eff = F.struct(F.lit(0).alias("delay"), (F.col("value") - 100).alias("value"), typ.alias("type"),
                   F.when(F.col("event_type") == "purchase", F.lit("Health")).alias("skillName"),
                   F.floor(F.col("value") - 100).cast("int").alias("duration"),
                   F.lit(1.0).alias("chance"), F.lit(None).cast("string").alias("krSkill"))
    return e.select("event_id", F.array(eff).alias("effects"))


_EVENT_EFFECT_SQL = """
ev AS (SELECT event_id, value - 100 AS v, CAST(floor(value - 100) AS INTEGER) AS dur,
  CASE event_type WHEN 'click' THEN 'Energy recovery' WHEN 'error' THEN 'Pain' WHEN 'view' THEN 'Body temperature'
                  WHEN 'purchase' THEN 'Skill' ELSE 'painkillerDuration' END AS t FROM events)"""


@register("split_positive", f"""
WITH {_EVENT_EFFECT_SQL}
SELECT event_id FROM ev WHERE t IN ('Antidote', 'Stops and prevents bleedings')
  OR (t = 'Body temperature' AND v < 0) OR (t = 'Energy recovery' AND v > 0)
  OR (t = 'painkillerDuration' AND dur > 0) OR (t = 'Skill' AND v > 0)
""")
def q_split_positive(spark, d):
    """Buffs by the signed rule table."""
    from quartermaster.functions.effects import split_effects
    e = event_effects(spark, d)
    return e.filter(F.size(split_effects("effects", "buff")) > 0).select("event_id")


@register("split_negative", f"""
WITH {_EVENT_EFFECT_SQL}
SELECT event_id FROM ev WHERE t IN ('Hands tremor', 'Pain', 'Tunnel effect')
  OR (t = 'Body temperature' AND v > 0) OR (t = 'Energy recovery' AND v < 0)
  OR (t = 'painkillerDuration' AND dur < 0) OR (t = 'Skill' AND v < 0)
""")
def q_split_negative(spark, d):
    """Debuffs by the signed rule table (value 0 in neither)."""
    from quartermaster.functions.effects import split_effects
    e = event_effects(spark, d)
    return e.filter(F.size(split_effects("effects", "debuff")) > 0).select("event_id")


# ---------------------------------------------------------- report windows

@register("prev_month_window", """
SELECT o_orderkey FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-02-01 00:00:00' AND o_orderdate < TIMESTAMP '1997-03-01 00:00:00'
""")
def q_prev_month_window(spark, d):
    """The calendar month before the run date."""
    from quartermaster.functions.windows import reporting_window
    o = read_table(spark, d, "orders")
    return reporting_window(o, "o_orderdate", _dt.date(1997, 3, 15), "prev_month").select("o_orderkey")


@register("interval_window", """
SELECT event_id FROM events
WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-12 00:00:00'
""")
def q_interval_window(spark, d):
    """Run interval start .. end - 1 day."""
    from quartermaster.functions.windows import reporting_window
    e = read_table(spark, d, "events")
    return reporting_window(e, "ts", _dt.date(2024, 1, 12), "interval",
                            start=_dt.date(2024, 1, 5)).select("event_id")


@register("zoned_window", """
SELECT event_id FROM events
WHERE timezone('Asia/Seoul', timezone('UTC', ts)) >= TIMESTAMP '2024-01-05 00:00:00'
  AND timezone('Asia/Seoul', timezone('UTC', ts)) < TIMESTAMP '2024-01-12 00:00:00'
""")
def q_zoned_window(spark, d):
    """X16 + X18: run interval in local days; the bounds move, not the
    column."""
    from quartermaster.functions.windows import reporting_window
    e = read_table(spark, d, "events")
    return reporting_window(e, "ts", _dt.date(2024, 1, 12), "interval", start=_dt.date(2024, 1, 5),
                            zone="Asia/Seoul").select("event_id")


@register("trailing_window", """
SELECT event_id FROM events
WHERE ts >= TIMESTAMP '2024-01-11 00:00:00' AND ts < TIMESTAMP '2024-01-17 00:00:00'
""")
def q_trailing_window(spark, d):
    """End - 19 .. end - 14 days."""
    from quartermaster.functions.windows import reporting_window
    e = read_table(spark, d, "events")
    return reporting_window(e, "ts", _dt.date(2024, 1, 30), "trailing").select("event_id")


@register("local_day_counts", """
SELECT CAST(CAST(ts + INTERVAL 9 HOUR AS DATE) AS VARCHAR) AS day, COUNT(*) AS n FROM events GROUP BY 1
""")
def q_local_day_counts(spark, d):
    """Events per local calendar day in Asia/Seoul (UTC wall clock in
    the table)."""
    from quartermaster.functions.scalars import local_date
    e = read_table(spark, d, "events")
    return (e.groupBy(local_date("ts", "Asia/Seoul").cast("string").alias("day"))
            .agg(F.count(F.lit(1)).alias("n")))


# --------------------------------------------------------------- snapshots

_SNAP_DAYS = 10


def _stamped_suppliers(spark, d):
    """``supplier`` snapshotted on ten consecutive days up to the run date."""
    from quartermaster.operators.snapshot import stamp
    n = read_table(spark, d, "supplier").select("s_suppkey")
    out = None
    for k in range(_SNAP_DAYS):
        s = stamp(n, AS_OF - _dt.timedelta(days=k))
        out = s if out is None else out.unionByName(s)
    return out


@register("snapshot_retention", """
SELECT CAST(DATE '2024-01-15' - INTERVAL (k) DAY AS DATE)::VARCHAR AS snapshot_date, s_suppkey
FROM supplier, range(0, 10) AS r(k)
WHERE k <= 3
""")
def q_snapshot_retention(spark, d):
    """B13 + B14 (T23): dated snapshots, retention of ``keep_days`` = 3."""
    from quartermaster.operators.snapshot import retain
    return retain(_stamped_suppliers(spark, d), 3, AS_OF).select("snapshot_date", "s_suppkey")


@register("snapshot_expired", """
SELECT DISTINCT CAST(DATE '2024-01-15' - INTERVAL (k) DAY AS DATE)::VARCHAR AS snapshot_date
FROM supplier, range(0, 10) AS r(k) WHERE k > 3
""")
def q_snapshot_expired(spark, d):
    """The snapshot dates retention removes."""
    from quartermaster.operators.snapshot import expired_snapshots
    return expired_snapshots(_stamped_suppliers(spark, d), 3, AS_OF)


# ------------------------------------------- item jobs on a part catalogue

#: p_type -> (category, parent) of the catalogue built from ``part``
_PART_CATEGORY = {"STANDARD": ("Knife", "Melee"), "ECONOMY": ("Ammo", "Ammo"),
                  "MEDIUM": ("Headwear", "Equipment"), "SMALL": ("Headphones", "Equipment"),
                  "LARGE": ("Tools", "Barter item"), "PROMO": ("Armor", "Equipment")}


def _helmets():
    """Three names with a fixed ricochet chance."""
    from quartermaster.functions import vocab as V
    return list(V.RICOCHET_OVERRIDE)[:3]


_HELMET_SQL = "[" + ", ".join(f"'{n}'" for n in _helmets()) + "][p_partkey % 3 + 1]"


def part_catalogue(spark, d, raw: bool = False) -> DataFrame:
    """Item documents built from ``part``: the category follows p_type, the
    attribute bag is the JSON of the member schema filled from the part's
    own columns (headphones and loot get ``{}``). Everything the item jobs
    do runs on it unchanged."""
    from quartermaster.sources.documents import ITEM_SCHEMA
    p = read_table(spark, d, "part", spread=True)
    t = F.col("p_type")
    cat = F.lit(None).cast("string")
    par = F.lit(None).cast("string")
    for k, (c, pa) in _PART_CATEGORY.items():
        cat = F.when(t == k, F.lit(c)).otherwise(cat)
        par = F.when(t == k, F.lit(pa)).otherwise(par)
    cat = F.when((t == "LARGE") & (F.col("p_size") > 45), F.lit("Compass")).otherwise(cat)
    word = F.initcap(F.split("p_name", " ").getItem(1))
    helmets = F.array(*map(F.lit, _helmets()))
    props = (F.when(t == "STANDARD", F.to_json(F.struct(
                F.col("p_size").alias("slashDamage"), (F.col("p_size") * 2).alias("stabDamage"),
                (F.col("p_retailprice") / 1000).alias("hitRadius"))))
             .when(t == "ECONOMY", F.to_json(F.struct(
                 F.col("p_size").alias("damage"), (F.col("p_size") + 10).alias("penetrationPower"),
                 (F.col("p_retailprice") / 10000).alias("accuracyModifier"))))
             .when(t == "MEDIUM", F.to_json(F.struct(
                 (F.col("p_size") % 6).alias("class"),
                 F.when(F.col("p_size") % 2 == 0, F.array(F.lit("Head, Neck"), F.lit("Head, Ears")))
                  .otherwise(F.array(F.lit("Head, Face"), F.concat(F.lit("Head, "), word))).alias("headZones"),
                 (F.col("p_size") / 100).alias("ricochetY"))))
             .when(t == "PROMO", F.to_json(F.struct(
                 (F.col("p_size") % 6).alias("class"),
                 F.array(F.lit("Thorax"), F.concat(F.lit("Stomach, "), word)).alias("zones"))))
             .otherwise(F.lit("{}")))
    doc = F.struct(F.col("p_partkey").alias("pos"),
                   F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("id"),
                   F.when((t == "MEDIUM") & (F.col("p_size") % 4 == 0),
                          F.element_at(helmets, (F.col("p_partkey") % 3 + 1).cast("int")))
                   .otherwise(F.concat_ws(" ", "p_name", "p_brand")).alias("name"),
                   (F.col("p_retailprice") / 100).alias("weight"),
                   F.col("p_brand").alias("shortName"),
                   F.concat(F.lit("/img/"), F.col("p_partkey").cast("string")).alias("image512pxLink"),
                   F.struct(cat.alias("name"), F.struct(par.alias("name")).alias("parent")).alias("category"),
                   props.alias("properties"))
    text = p.select(F.to_json(doc).alias("json"))
    if raw:
        return text
    return text.select(F.from_json("json", ITEM_SCHEMA).alias("d")).select("d.*")


def _part_item_sources(spark, d, table):
    from quartermaster.plans import items as I
    empty_maps = spark.createDataFrame([], "pos bigint, name string, locks array<struct<key:struct<name:string>>>")
    return I.item_sources(part_catalogue(spark, d), empty_maps, AS_OF, only=[table])


_PART_DOC_SQL = f"""
pd AS (SELECT 'p' || CAST(p_partkey AS VARCHAR) AS id,
              CASE WHEN p_type = 'MEDIUM' AND p_size % 4 = 0 THEN {_HELMET_SQL} ELSE p_name || ' ' || p_brand END AS name,
              p_brand AS short_name, '/img/' || CAST(p_partkey AS VARCHAR) AS image, p_type, p_size,
              p_retailprice, p_retailprice / 100 AS weight, p_name FROM part)"""


@register("catalogue_knife", f"""
WITH {_PART_DOC_SQL}
SELECT id, name, short_name, image, 'Knife' AS category, p_size AS slash_damage, p_size * 2 AS stab_damage,
       p_retailprice / 1000 AS hit_radius, TIMESTAMP '2024-01-15 00:00:00' AS update_time FROM pd WHERE p_type = 'STANDARD'
""")
def q_catalogue_knife(spark, d):
    """P2 on the part catalogue (A1, A6, C5i, C1)."""
    return _part_item_sources(spark, d, "knife")["knife"].drop("pos")


@register("catalogue_ammo", f"""
WITH {_PART_DOC_SQL}
SELECT id, name, short_name, p_size AS damage, p_size + 10 AS penetration_power,
       CAST(NULL AS INTEGER) AS armor_damage, p_retailprice / 10000 AS accuracy_modifier,
       CAST(NULL AS DOUBLE) AS recoil_modifier, CAST(NULL AS DOUBLE) AS light_bleed_modifier,
       CAST(NULL AS DOUBLE) AS heavy_bleed_modifier, image, TIMESTAMP '2024-01-15 00:00:00' AS update_time
FROM pd WHERE p_type = 'ECONOMY'
""")
def q_catalogue_ammo(spark, d):
    """P13 on the part catalogue."""
    return _part_item_sources(spark, d, "ammo")["ammo"].drop("pos")


def _zones_kr_sql(expr, mapping, default):
    case = "CASE z " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"
    return f"array_to_string(list_transform({expr}, lambda z: COALESCE({case}, '{default}')), '|')"


def _headwear_sql():
    from quartermaster.functions import vocab as V
    zones = ("CASE WHEN p_size % 2 = 0 THEN ['Head, Back Neck', 'Head, Ears'] "
             "ELSE ['Head, Face', 'Head, ' || upper(left(split_part(p_name, ' ', 2), 1)) "
             "|| lower(substr(split_part(p_name, ' ', 2), 2))] END")
    fixed = V.RICOCHET_OVERRIDE[_helmets()[0]]
    return f"""
WITH {_PART_DOC_SQL}, h AS (SELECT *, {zones} AS zones, CASE WHEN p_size % 4 = 0 THEN CAST({fixed} AS DOUBLE) ELSE p_size / 100 END AS r
                            FROM pd WHERE p_type = 'MEDIUM')
SELECT id, name, short_name, weight, image, TIMESTAMP '2024-01-15 00:00:00' AS update_time, p_size % 6 AS class_value, array_to_string(zones, '|') AS areas_en,
       {_zones_kr_sql('zones', V.HEAD_ZONES_KR, V.HEAD_ZONE_UNKNOWN_KR)} AS areas_kr,
       r AS ricochet_chance,
       CASE WHEN r < 0.2 THEN 'Low' WHEN r < 0.4 THEN 'Medium' ELSE 'High' END AS ricochet_str_en,
       CASE WHEN r < 0.2 THEN '낮음' WHEN r < 0.4 THEN '중간' ELSE '높음' END AS ricochet_str_kr
FROM h"""


@register("catalogue_headwear", _headwear_sql())
def q_catalogue_headwear(spark, d):
    """P5 on the part catalogue: I4 + I2 zones, X8 buckets in two languages."""
    h = _part_item_sources(spark, d, "headwear")["headwear"]
    return h.select("id", "name", "short_name", "weight", "image", "update_time", "class_value",
                    F.array_join("areas_en", "|").alias("areas_en"),
                    F.array_join("areas_kr", "|").alias("areas_kr"), "ricochet_chance",
                    "ricochet_str_en", "ricochet_str_kr")


def _armor_sql():
    from quartermaster.functions import vocab as V
    case = "CASE z " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in V.ARMOR_ZONES_KR.items()) + " END"
    return f"""
WITH {_PART_DOC_SQL},
a AS (SELECT *, ['Thorax', 'Stomach, ' || upper(left(split_part(p_name, ' ', 2), 1))
                 || lower(substr(split_part(p_name, ' ', 2), 2))] AS zones FROM pd WHERE p_type = 'PROMO')
SELECT id, name, short_name, weight, image, TIMESTAMP '2024-01-15 00:00:00' AS update_time,
       p_size % 6 AS class_value, array_to_string(zones, '|') AS areas_en,
       array_to_string(list_filter(list_transform(zones, lambda z: {case}), lambda y: y IS NOT NULL), '|') AS areas_kr
FROM a"""


@register("catalogue_armor", _armor_sql())
def q_catalogue_armor(spark, d):
    """P6 on the part catalogue: I1 drops unknown zones."""
    a = _part_item_sources(spark, d, "armor_vest")["armor_vest"].drop("pos")
    return a.withColumns({c: F.array_join(c, "|") for c in ("areas_en", "areas_kr")})


@register("catalogue_loot", f"""
WITH {_PART_DOC_SQL}
SELECT id, name AS name_en, short_name, image,
       CASE WHEN p_size > 45 THEN 'Special equipment' ELSE 'Tools' END AS category, TIMESTAMP '2024-01-15 00:00:00' AS update_time
FROM pd WHERE p_type = 'LARGE' AND NOT contains(name, 'Locked')
""")
def q_catalogue_loot(spark, d):
    """P14 on the part catalogue: C5g routing, X7 recategorisation."""
    return _part_item_sources(spark, d, "loot")["loot"].drop("pos")


@register("catalogue_headset", f"""
WITH {_PART_DOC_SQL}
SELECT id, name, short_name, image, TIMESTAMP '2024-01-15 00:00:00' AS update_time FROM pd WHERE p_type = 'SMALL'
""")
def q_catalogue_headset(spark, d):
    """P4 on the part catalogue (no bag test)."""
    return _part_item_sources(spark, d, "headset")["headset"].drop("pos")


@register("catalogue_ammo_upsert", f"""
WITH {_PART_DOC_SQL},
src AS (SELECT id, name, short_name, p_size AS damage FROM pd WHERE p_type = 'ECONOMY'),
tgt AS (SELECT 'p' || CAST(p_partkey AS VARCHAR) AS id, 'old' AS name, 'OLD-' || p_brand AS short_name,
               'Curated' AS category, -1 AS damage FROM part WHERE p_size <= 25)
SELECT COALESCE(t.id, s.id) AS id,
       CASE WHEN s.id IS NOT NULL THEN s.name ELSE t.name END AS name,
       CASE WHEN t.id IS NOT NULL THEN t.short_name ELSE s.short_name END AS short_name,
       t.category AS category,
       CASE WHEN s.id IS NOT NULL THEN s.damage ELSE t.damage END AS damage
FROM tgt t FULL JOIN src s ON t.id = s.id
""")
def q_catalogue_ammo_upsert(spark, d):
    """P13 + B1/B4/B5 (T6, T7): ammo upserted into a table with curated
    columns; the short name is written for new rows only."""
    from quartermaster.plans.items import TARGETS
    p = read_table(spark, d, "part").filter(F.col("p_size") <= 25)
    tgt = p.select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("id"),
                   F.lit("old").alias("name"), F.concat(F.lit("OLD-"), F.col("p_brand")).alias("short_name"),
                   F.lit("Curated").alias("category"), F.lit(-1).alias("damage"))
    src = _part_item_sources(spark, d, "ammo")["ammo"]
    t = TARGETS["ammo"]
    ins = [c for c in t.insert_cols if c in ("name", "short_name", "damage")]
    upd = [c for c in t.update_cols if c in ins]
    from quartermaster.operators.merge import merge
    return merge(tgt, src, "id", insert_cols=ins, update_cols=upd, order_cols="pos")


# ------------------------------------- station and quest jobs on orders

def _station_sources(spark, d, table):
    from quartermaster.plans import stations as S
    return S.station_sources(station_docs(spark, d), AS_OF, only=[table])[table]


@register("stations_master", """
SELECT CAST(o_orderkey AS VARCHAR) AS id, 'station ' || CAST(o_orderkey AS VARCHAR) AS name_en,
       CAST(NULL AS VARCHAR) AS image, CAST(o_orderkey AS VARCHAR) || '-1|' || CAST(o_orderkey AS VARCHAR) || '-2' AS level_ids, TIMESTAMP '2024-01-15 00:00:00' AS update_time
FROM orders
""")
def q_stations_master(spark, d):
    """Station rows with their level ids."""
    m = _station_sources(spark, d, "hideout_master")
    return m.drop("pos").withColumn("level_ids", F.array_join("level_ids", "|"))


@register("stations_bonus", """
SELECT CAST(o_orderkey AS VARCHAR) || '-1' AS level_id, 'SkillBoost' AS type,
       CASE WHEN o_orderstatus = 'O' THEN 'later' ELSE o_orderpriority END AS name_en,
       CASE WHEN o_orderstatus = 'O' THEN CAST(o_custkey AS DOUBLE) ELSE o_totalprice END AS value,
       CASE WHEN o_orderstatus IN ('O', 'F') THEN NULL ELSE 'Strength' END AS skill_name_en
FROM orders
UNION ALL
SELECT CAST(o_orderkey AS VARCHAR) || '-1', 'Rate', 'later', CAST(o_custkey AS DOUBLE), NULL
FROM orders WHERE o_orderstatus <> 'O'
""")
def q_stations_bonus(spark, d):
    """Bonuses keyed (level_id, type), a repeated type in one level is
    last-wins (B2 + E5), an empty skill name is NULL (X10)."""
    from quartermaster.plans import stations as S
    from quartermaster.operators.merge import merge
    src = S.target_rows(station_docs(spark, d), "hideout_bonus")
    empty = spark.createDataFrame([], "level_id string, type string, name_en string, value double, "
                                      "skill_name_en string")
    return merge(empty, src, ["level_id", "type"], insert_cols=["name_en", "value", "skill_name_en"],
                 order_cols="pos")


@register("stations_trader", """
SELECT CAST(o_orderkey AS VARCHAR) || '-t' AS id, CAST(o_orderkey AS VARCHAR) || '-2' AS level_id,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS name_en,
       CAST(o_custkey % 4 AS INTEGER) AS value, 'loyaltyLevel' AS require_type, '>=' AS compare,
       CASE WHEN o_orderstatus <> 'P' THEN '/trader/' || o_orderpriority END AS image, TIMESTAMP '2024-01-15 00:00:00' AS update_time
FROM orders
""")
def q_stations_trader(spark, d):
    """Trader requirements with a NULL trader."""
    return _station_sources(spark, d, "hideout_trader_require").drop("pos")


@register("stations_crafts", """
SELECT CAST(o_orderkey AS VARCHAR) || '-c' AS id, CAST(o_orderkey AS VARCHAR) || '-1' AS level_id,
       1 AS level, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS name_en, TIMESTAMP '2024-01-15 00:00:00' AS update_time
FROM orders
""")
def q_stations_crafts(spark, d):
    """P25: craft rows (X2 key text, I12 first reward)."""
    return _station_sources(spark, d, "hideout_crafts").drop("pos")


def quest_docs(spark, d) -> DataFrame:
    """Quest documents from orders: the trader is the priority (empty text
    for finished orders), one task requirement per order pointing at the
    customer, one or two objectives."""
    from quartermaster.sources.documents import QUEST_SCHEMA
    o = read_table(spark, d, "orders", spread=True)
    sid = F.col("o_orderkey").cast("string")
    obj = lambda k, typ: F.struct(F.concat(sid, F.lit(f"-o{k}")).alias("id"), F.lit(typ).alias("type"),
                                  F.lit(None).cast("struct<id:string,name:string,shortName:string,"
                                                   "description:string>").alias("questItem"),
                                  F.lit(k).alias("count"))
    doc = F.struct(
        F.col("o_orderkey").alias("pos"), sid.alias("id"),
        F.concat(F.lit("quest "), sid).alias("name"),
        F.struct(F.when(F.col("o_orderstatus") == "F", F.lit("")).otherwise(F.col("o_orderpriority"))
                 .alias("name")).alias("trader"),
        F.array(F.struct(F.struct(F.col("o_custkey").cast("string").alias("id"),
                                  F.col("o_orderpriority").alias("name")).alias("task"))).alias("taskRequirements"),
        F.when(F.col("o_orderstatus") == "O", F.array(obj(1, "shoot"), obj(2, "visit")))
        .otherwise(F.array(obj(1, "shoot"))).alias("objectives"))
    text = o.select(F.to_json(doc).alias("json"))
    return text.select(F.from_json("json", QUEST_SCHEMA).alias("q")).select("q.*")


@register("quests_loaded", """
SELECT CAST(o_orderkey AS VARCHAR) AS id, 'quest ' || CAST(o_orderkey AS VARCHAR) AS name,
       CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS npc_name,
       CAST(o_custkey AS VARCHAR) AS first_task,
       CASE WHEN o_orderstatus = 'O' THEN 2 ELSE 1 END AS n_objectives
FROM orders
""")
def q_quests_loaded(spark, d):
    """P26 (A4, X10, X11): quest rows with JSON lists, read back as JSON."""
    from quartermaster.plans.quests import quest_rows
    q = quest_rows(quest_docs(spark, d))
    return q.select("id", "name", "npc_name",
                    F.get_json_object("task_requirements", "$[0].task.id").alias("first_task"),
                    F.json_array_length("objectives").alias("n_objectives"))


def _known_weapons():
    """Names with a fixed short name or a fixed image."""
    from quartermaster.functions import vocab as V
    return [*V.WEAPON_SHORT_NAME, *V.WEAPON_IMAGE_OVERRIDE]


def part_armory(spark, d) -> DataFrame:
    """Weapon documents from ``part``: parts of size up to 10 are image-only
    entries (empty bag, name containing 'Default', short name = brand plus a
    suffix of 8, 7 or 6 characters); the others are weapons whose short name
    is the brand (a fifth of them under a name with a fixed short name or
    image), with fire modes built from the part name."""
    from quartermaster.sources.documents import ITEM_SCHEMA
    p = read_table(spark, d, "part", spread=True)
    img = F.col("p_size") <= 10
    known = _known_weapons()
    names = F.array(*map(F.lit, known))
    word = F.initcap(F.split("p_name", " ").getItem(0))
    modes = F.when(F.col("p_size") > 40, F.array(F.lit("Single fire"), F.concat(word, F.lit(" Burst Fire")),
                                                  F.lit("Semi-auto")))\
        .otherwise(F.array(F.lit("Single fire"), F.concat(word, F.lit(" Burst Fire"))))
    props = F.when(img, F.lit("{}")).otherwise(F.to_json(F.struct(
        F.col("p_type").alias("caliber"), modes.alias("fireModes"),
        (F.col("p_size") * 10).alias("fireRate"))))
    doc = F.struct(
        F.col("p_partkey").alias("pos"),
        F.concat(F.lit("w"), F.col("p_partkey").cast("string")).alias("id"),
        F.when(img, F.concat_ws(" ", "p_name", F.lit("Default")))
        .when(F.col("p_partkey") % 5 == 0, F.element_at(names, (F.col("p_size") % len(known) + 1).cast("int")))
        .otherwise(F.col("p_name")).alias("name"),
        F.lit(3.0).alias("weight"),
        F.when(img, F.concat(F.col("p_brand"), _suffix())).otherwise(F.col("p_brand")).alias("shortName"),
        F.concat(F.lit("/img/w"), F.col("p_partkey").cast("string")).alias("image512pxLink"),
        F.struct(F.when(F.col("p_type") == "SMALL", F.lit("Revolver")).otherwise(F.lit("Assault rifle"))
                 .alias("name"), F.struct(F.lit("Weapon").alias("name")).alias("parent")).alias("category"),
        props.alias("properties"))
    return p.select(F.to_json(doc).alias("j")).select(F.from_json("j", ITEM_SCHEMA).alias("d")).select("d.*")


def _armory_strip_sql(n):
    return f"""s{n} AS (SELECT k, img FROM (
  SELECT left(sn, greatest(length(sn) - {n}, 0)) AS k, img,
         ROW_NUMBER() OVER (PARTITION BY left(sn, greatest(length(sn) - {n}, 0)) ORDER BY pos DESC) AS rn
  FROM cand) WHERE rn = 1)"""


def _weapon_sql():
    from quartermaster.functions import vocab as V
    known = ", ".join(f"'{n}'" for n in _known_weapons())
    given = lambda m, x: f"CASE {x} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in m.items()) + " END"
    names = lambda v: ", ".join(f"'{x}'" for x in v)
    word = "upper(left(split_part(p_name, ' ', 1), 1)) || lower(substr(split_part(p_name, ' ', 1), 2))"
    return f"""
WITH cand AS (
  SELECT p_partkey AS pos, '/img/w' || CAST(p_partkey AS VARCHAR) AS img,
         p_brand || CASE WHEN p_partkey % 3 = 0 THEN ' Default' WHEN p_partkey % 3 = 1 THEN ' Urbana' ELSE ' Zenit' END AS sn
  FROM part WHERE p_size <= 10),
{_armory_strip_sql(8)}, {_armory_strip_sql(7)}, {_armory_strip_sql(6)},
n AS (SELECT *, CASE WHEN p_partkey % 5 = 0 THEN [{known}][p_size % {len(_known_weapons())} + 1] ELSE p_name END AS name,
             {word} || ' Burst Fire' AS burst FROM part WHERE p_size > 10),
w AS (SELECT *, COALESCE({given(V.WEAPON_SHORT_NAME, 'name')}, p_brand) AS short FROM n)
SELECT 'w' || CAST(w.p_partkey AS VARCHAR) AS id, w.name, w.short AS short_name,
       CASE WHEN {given(V.WEAPON_IMAGE_OVERRIDE, 'w.name')} IS NOT NULL THEN {given(V.WEAPON_IMAGE_OVERRIDE, 'w.name')}
            WHEN s8.k IS NOT NULL THEN s8.img WHEN s7.k IS NOT NULL THEN s7.img WHEN s6.k IS NOT NULL THEN s6.img
            ELSE '/img/w' || CAST(w.p_partkey AS VARCHAR) END AS image,
       CASE WHEN w.short IN ({names(V.WEAPON_SPECIAL)}) THEN 'Special weapons'
            WHEN w.short IN ({names(V.WEAPON_GRENADE)}) THEN 'Grenade launcher'
            WHEN w.short = '{V.WEAPON_SHOTGUN}' THEN 'Shotgun' WHEN w.p_type = 'SMALL' THEN 'Handgun'
            WHEN w.short IN ({names(V.WEAPON_CARBINE)}) THEN 'Assault carbine'
            ELSE 'Assault rifle' END AS category,
       'Single fire|' || burst || CASE WHEN w.p_size > 40 THEN '|Semi-auto' ELSE '' END AS modes_en,
       CASE WHEN w.p_size > 40 THEN '단발|점사|반자동' ELSE '단발|점사' END AS modes_kr,
       w.p_size * 10 AS fire_rate, w.p_type AS carliber, CAST(NULL AS VARCHAR) AS default_ammo,
       CAST(NULL AS INTEGER) AS ergonomics, CAST(NULL AS INTEGER) AS recoil_vertical,
       CAST(NULL AS INTEGER) AS recoil_horizontal, TIMESTAMP '2024-01-15 00:00:00' AS update_time
FROM w LEFT JOIN s8 ON w.p_brand = s8.k LEFT JOIN s7 ON w.p_brand = s7.k LEFT JOIN s6 ON w.p_brand = s6.k"""


@register("catalogue_weapon", _weapon_sql())
def q_catalogue_weapon(spark, d):
    """P1 on a part armory: C5a/C5b routing, D9 image by suffix strip 8 > 7 >
    6 (last-wins within a length), X6 recategorisation, I5 fire modes."""
    from quartermaster.plans import items as I
    maps = spark.createDataFrame([], "pos bigint, name string, locks array<struct<key:struct<name:string>>>")
    w = I.item_sources(part_armory(spark, d), maps, AS_OF, only=["weapon"])["weapon"]
    return w.select("id", "name", "short_name", "image", "category", F.array_join("modes_en", "|").alias("modes_en"),
                    F.array_join("modes_kr", "|").alias("modes_kr"), "fire_rate", "carliber", "default_ammo",
                    "ergonomics", "recoil_vertical", "recoil_horizontal", "update_time")


def event_pharmacy(spark, d) -> DataFrame:
    """Medical documents from ``events``: errors are the reclassified
    product, views an injector that gets a painkiller appended, clicks a
    painkiller with a duration override and cures, purchases and sign-ups
    carry one signed skill / duration effect."""
    from quartermaster.sources.documents import ITEM_SCHEMA
    e = read_table(spark, d, "events", spread=True)
    et = F.col("event_type")
    name = (F.when(et == "error", F.lit("Morphine injector"))
            .when(et == "view", F.lit("Adrenaline injector"))
            .when(et == "click", F.lit("Analgin painkillers"))
            .otherwise(F.concat(F.lit("med "), F.col("event_id").cast("string"))))
    v = F.col("value") - 100
    eff = F.struct(F.lit(0).alias("delay"), v.alias("value"),
                   F.when(et == "view", F.lit("Body temperature")).when(et == "purchase", F.lit("Skill"))
                   .otherwise(F.lit("painkillerDuration")).alias("type"),
                   F.when(et == "purchase", F.lit("Health")).alias("skillName"),
                   F.floor(v).cast("int").alias("duration"), F.lit(1.0).alias("chance"))
    props = (F.when(et == "click", F.to_json(F.struct(
                F.array(F.lit("Pain"), F.lit("Odd")).alias("cures"), F.lit(2).alias("uses"),
                F.floor("value").cast("int").alias("painkillerDuration"))))
             .when(et == "error", F.to_json(F.struct(F.array(F.lit("Pain")).alias("cures"),
                                                     F.lit(1).alias("uses"), F.lit(300).alias("painkillerDuration"))))
             .otherwise(F.to_json(F.struct(F.array(eff).alias("stimEffects")))))
    doc = F.struct(F.col("event_id").cast("bigint").alias("pos"),
                   F.concat(F.lit("m"), F.col("event_id").cast("string")).alias("id"),
                   name.alias("name"), F.lit(0.1).alias("weight"), et.alias("shortName"),
                   F.lit("/img/m").alias("image512pxLink"),
                   F.struct(F.lit("Drug").alias("name"), F.struct(F.lit("Meds").alias("name")).alias("parent"))
                   .alias("category"), props.alias("properties"))
    return e.select(F.to_json(doc).alias("j")).select(F.from_json("j", ITEM_SCHEMA).alias("d")).select("d.*")


def _effect_content(col):
    """The effects of a JSON list as text: type, label, duration and the
    names of the fields of each, and the sum of the values."""
    e = F.from_json(col, "array<struct<type:string,krSkill:string,duration:int,value:double>>")
    raw = F.from_json(col, "array<string>")
    return [F.array_join(F.transform(e, lambda x: F.concat_ws(":", x["type"], F.coalesce(x["krSkill"], F.lit("-")),
                                                              x["duration"].cast("string"))), "|").alias(f"{col}_effects"),
            F.array_join(F.transform(raw, lambda x: F.array_join(F.array_sort(F.json_object_keys(x)), ",")), "|").alias(f"{col}_fields"),
            F.aggregate(e, F.lit(0.0), lambda a, x: a + x["value"]).alias(f"{col}_value")]


def _medical_sql():
    from quartermaster.functions import vocab as V
    kr = lambda t: V.MED_TYPE_KR[t]
    full = "chance,delay,duration,krSkill,skillName,type,value"
    one = (f"CASE event_type WHEN 'view' THEN 'Body temperature:{kr('Body temperature')}:' "
           f"WHEN 'purchase' THEN 'Skill:{V.MED_SKILL_KR['Health']}:' ELSE 'painkillerDuration:{kr('painkillerDuration')}:' END "
           "|| CAST(CAST(floor(value - 100) AS INTEGER) AS VARCHAR)")
    extra = f"'painkillerDuration:{kr('painkillerDuration')}:{dict(V.INJECTOR_PAINKILLER)['Adrenaline injector']}'"
    fixed = {side: "|".join(f"{t}:{kr(t)}:{x}" for x, t, v in V.RECLASSIFIED_EFFECTS if (v >= 0) == (side == "buff"))
             for side in ("buff", "debuff")}
    total = {side: sum(v for _, _, v in V.RECLASSIFIED_EFFECTS if (v >= 0) == (side == "buff")) for side in ("buff", "debuff")}
    count = {side: sum(1 for _, _, v in V.RECLASSIFIED_EFFECTS if (v >= 0) == (side == "buff")) for side in ("buff", "debuff")}
    out = []
    for side, sign in (("buff", ">"), ("debuff", "<")):
        turned = "<" if sign == ">" else ">"
        own = (f"(CASE event_type WHEN 'view' THEN value - 100 {turned} 0 WHEN 'purchase' THEN value - 100 {sign} 0 "
               f"ELSE floor(value - 100) {sign} 0 END)")
        injector = side == "buff"
        some = f"[CASE WHEN {own} THEN {one} END{', CASE WHEN event_type = ' + chr(39) + 'view' + chr(39) + ' THEN ' + extra + ' END' if injector else ''}]"
        n = f"(CASE WHEN {own} THEN 1 ELSE 0 END{' + CASE WHEN event_type = ' + chr(39) + 'view' + chr(39) + ' THEN 1 ELSE 0 END' if injector else ''})"
        out += [f"""CASE event_type WHEN 'error' THEN '{fixed[side]}' WHEN 'click' THEN NULL
         ELSE array_to_string(list_filter({some}, lambda x: x IS NOT NULL), '|') END AS {side}_effects""",
                f"""CASE event_type WHEN 'error' THEN array_to_string(list_resize(['{full}'], {count[side]}, '{full}'), '|')
         WHEN 'click' THEN NULL
         ELSE array_to_string(list_resize(CAST([] AS VARCHAR[]), {n}, '{full}'), '|') END AS {side}_fields""",
                f"""CASE event_type WHEN 'error' THEN CAST({total[side]} AS DOUBLE) WHEN 'click' THEN NULL
         ELSE CASE WHEN {own} THEN value - 100 ELSE CAST(0 AS DOUBLE) END END AS {side}_value"""]
    return f"""
SELECT 'm' || CAST(event_id AS VARCHAR) AS id,
       CASE WHEN event_type = 'error' THEN 'Stimulant' ELSE 'Drug' END AS category,
       CASE WHEN event_type = 'click' THEN 'Pain|Odd' END AS cures_en,
       CASE WHEN event_type = 'click' THEN '{V.CURES_KR["Pain"]}' END AS cures_kr,
       CASE WHEN event_type = 'click' THEN 95 END AS painkiller_duration,
       CASE WHEN event_type = 'click' THEN 2 END AS uses, TIMESTAMP '2024-01-15 00:00:00' AS update_time,
       {(","+chr(10)+"       ").join(out)}
FROM events"""


@register("catalogue_medical", _medical_sql())
def q_catalogue_medical(spark, d):
    """P12 on an event pharmacy: I8 reclassification, I7 injector
    painkiller, I6 labels, I9 / I10 split, I1 cures, L11 override."""
    from quartermaster.plans import items as I
    maps = spark.createDataFrame([], "pos bigint, name string, locks array<struct<key:struct<name:string>>>")
    m = I.item_sources(event_pharmacy(spark, d), maps, AS_OF, only=["medical"])["medical"]
    return m.select("id", "category", F.array_join("cures_en", "|").alias("cures_en"),
                    F.array_join("cures_kr", "|").alias("cures_kr"), "painkiller_duration", "uses", "update_time",
                    *_effect_content("buff"), *_effect_content("debuff"))


def _map_names():
    """Every map of the vocabulary, and one that is not in it."""
    from quartermaster.functions import vocab as V
    return [*V.MAP_CODES, "Nowhere"]


def part_maps(spark, d) -> DataFrame:
    """Map documents from ``part``: one map per part, named by its size
    (the known names and one unknown), with one lock whose key is named after the
    brand - so each key name appears on many maps and the last one wins."""
    from quartermaster.sources.documents import MAP_SCHEMA
    p = read_table(spark, d, "part", spread=True)
    names = F.array(*[F.lit(n) for n in _map_names()])
    doc = F.struct(F.col("p_partkey").alias("pos"),
                   F.element_at(names, (F.col("p_size") % len(_map_names()) + 1).cast("int")).alias("name"),
                   F.array(F.struct(F.struct(F.concat(F.lit("key "), F.col("p_brand")).alias("name"))
                                    .alias("key"))).alias("locks"))
    return p.select(F.to_json(doc).alias("j")).select(F.from_json("j", MAP_SCHEMA).alias("m")).select("m.*")


def customer_keys(spark, d) -> DataFrame:
    """Key items from ``customer``: named after one of 30 brands (five of
    them on no map), some carrying a fixed-list name or a name-contains
    rule."""
    from quartermaster.sources.documents import ITEM_SCHEMA
    c = read_table(spark, d, "customer", spread=True)
    brand = F.concat(F.lit("key Brand#"), (F.col("c_custkey") % 30 + 1).cast("string"))
    name = (F.when(F.col("c_mktsegment") == "BUILDING", F.lit("Gas station safe key"))
            .when(F.col("c_mktsegment") == "MACHINERY", F.concat(brand, F.lit(" Health Resort")))
            .otherwise(brand))
    doc = F.struct(F.col("c_custkey").alias("pos"),
                   F.concat(F.lit("k"), F.col("c_custkey").cast("string")).alias("id"), name.alias("name"),
                   F.lit(0.01).alias("weight"), F.lit("key").alias("shortName"),
                   F.lit("/img/k").alias("image512pxLink"),
                   F.struct(F.lit("Mechanical Key").alias("name"),
                            F.struct(F.lit("Key").alias("name")).alias("parent")).alias("category"),
                   F.to_json(F.struct(F.col("c_nationkey").alias("uses"))).alias("properties"))
    return c.select(F.to_json(doc).alias("j")).select(F.from_json("j", ITEM_SCHEMA).alias("d")).select("d.*")


def _keys_sql():
    from quartermaster.functions import vocab as V
    code = "CASE map " + " ".join(f"WHEN '{k}' THEN '{v[0]}'" for k, v in V.MAP_CODES.items()) + " ELSE 'N/A' END"
    en = "CASE c " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in V.MAP_CODE_EN.items()) + " ELSE c END"
    kr = "CASE c " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in V.MAP_CODE_KR.items()) + " ELSE c END"
    names = ", ".join(f"'{n}'" for n in _map_names())
    return f"""
WITH maps AS (SELECT p_partkey AS pos, [{names}][p_size % {len(_map_names())} + 1] AS map,
                     'key ' || p_brand AS key FROM part),
km AS (SELECT key, arg_max(map, pos) AS map FROM maps GROUP BY key),
keys AS (SELECT c_custkey, c_nationkey,
                CASE WHEN c_mktsegment = 'BUILDING' THEN 'Gas station safe key'
                     WHEN c_mktsegment = 'MACHINERY' THEN 'key Brand#' || CAST(c_custkey % 30 + 1 AS VARCHAR) || ' Health Resort'
                     ELSE 'key Brand#' || CAST(c_custkey % 30 + 1 AS VARCHAR) END AS name FROM customer),
coded AS (SELECT c_custkey, c_nationkey, name,
                 CASE WHEN name = 'Gas station safe key' THEN 'SHORELINE'
                      WHEN contains(name, 'Health Resort') THEN 'SHORELINE'
                      WHEN km.map IS NULL THEN 'N/A'
                      ELSE (SELECT {code} FROM (SELECT km.map AS map)) END AS c
          FROM keys LEFT JOIN km ON keys.name = km.key)
SELECT 'k' || CAST(c_custkey AS VARCHAR) AS id, name, c_nationkey AS uses, c AS map_value,
       {en} AS use_map_en, {kr} AS use_map_kr, TIMESTAMP '2024-01-15 00:00:00' AS update_time FROM coded"""


@register("catalogue_keys", _keys_sql())
def q_catalogue_keys(spark, d):
    """A2 maps -> locks, N3 + E4 last map per key name (T17), L10 map
    codes, D10 override chain, I3 English names (unknown codes pass)."""
    from quartermaster.plans import items as I
    k = I.item_sources(customer_keys(spark, d), part_maps(spark, d), AS_OF, only=["key"])["key"]
    return k.select("id", "name", "uses", F.array_join("map_value", "|").alias("map_value"),
                    F.array_join("use_map_en", "|").alias("use_map_en"),
                    F.array_join("use_map_kr", "|").alias("use_map_kr"), "update_time")


@register("catalogue_narrow", f"""
WITH {_PART_DOC_SQL}
SELECT id, name, CASE p_type WHEN 'STANDARD' THEN 'Knife' WHEN 'ECONOMY' THEN 'Ammo' WHEN 'MEDIUM' THEN 'Headwear'
  WHEN 'SMALL' THEN 'Headphones' WHEN 'PROMO' THEN 'Armor'
  ELSE CASE WHEN p_size > 45 THEN 'Compass' ELSE 'Tools' END END AS category
FROM pd
""")
def q_catalogue_narrow(spark, d):
    """The same documents read with a narrow schema (fields not in it
    are skipped by the parser)."""
    from quartermaster.sources.documents import narrow
    narrow_schema = "id string, name string, category struct<name:string>"
    docs = part_catalogue(spark, d, raw=True).select(F.from_json("json", narrow_schema).alias("d")).select("d.*")
    return narrow(docs, ["id", "name", F.col("category.name").alias("category")])


def event_pantry(spark, d) -> DataFrame:
    """Food and drink documents from ``events``: clicks are the vodka that
    gets a painkiller appended; every item has one effect whose type / skill
    follows the event type."""
    from quartermaster.sources.documents import ITEM_SCHEMA
    e = read_table(spark, d, "events", spread=True)
    et = F.col("event_type")
    eff = F.struct(F.lit(0).alias("delay"), (F.col("value") - 100).alias("value"),
                   F.when(et == "purchase", F.lit("Skill")).when(et == "view", F.lit("Hands tremor"))
                   .when(et == "signup", F.lit("Skill")).otherwise(F.lit("Energy recovery")).alias("type"),
                   F.when(et == "purchase", F.lit("Metabolism")).when(et == "signup", F.lit("Recoil Control"))
                   .alias("skillName"),
                   F.lit(60).alias("duration"))
    doc = F.struct(F.col("event_id").cast("bigint").alias("pos"),
                   F.concat(F.lit("f"), F.col("event_id").cast("string")).alias("id"),
                   F.when(et == "click", F.lit("Bottle of Tarkovskaya vodka"))
                   .otherwise(F.concat(F.lit("food "), F.col("event_id").cast("string"))).alias("name"),
                   F.lit(0.5).alias("weight"), et.alias("shortName"), F.lit("/img/f").alias("image512pxLink"),
                   F.struct(F.when(et == "click", F.lit("Drink")).otherwise(F.lit("Food")).alias("name"),
                            F.struct(F.lit("Food and drink").alias("name")).alias("parent")).alias("category"),
                   F.to_json(F.struct(F.floor("value").cast("int").alias("energy"),
                                      (F.col("event_id") % 9).cast("int").alias("hydration"),
                                      F.array(eff).alias("stimEffects"))).alias("properties"))
    return e.select(F.to_json(doc).alias("j")).select(F.from_json("j", ITEM_SCHEMA).alias("d")).select("d.*")


@register("catalogue_provisions", """
SELECT 'f' || CAST(event_id AS VARCHAR) AS id,
       CASE WHEN event_type = 'click' THEN 'Drink' ELSE 'Food' END AS category,
       CAST(floor(value) AS INTEGER) AS energy, CAST(event_id % 9 AS INTEGER) AS hydration,
       CASE WHEN event_type = 'click' THEN 2 ELSE 1 END AS n_effects,
       CASE WHEN event_type = 'signup' THEN 'delay,duration,skillName,type,value'
            WHEN event_type = 'click' THEN 'delay,duration,krSkill,skillName,type,value|delay,duration,krSkill,skillName,type,value'
            ELSE 'delay,duration,krSkill,skillName,type,value' END AS fields,
       CASE event_type WHEN 'purchase' THEN '신진대사' WHEN 'view' THEN '손 떨림'
                       WHEN 'signup' THEN NULL ELSE '에너지 회복' END AS first_label,
       CASE WHEN event_type = 'click' THEN '진통제'
            ELSE CASE event_type WHEN 'purchase' THEN '신진대사' WHEN 'view' THEN '손 떨림'
                                 WHEN 'signup' THEN NULL ELSE '에너지 회복' END END AS last_label
FROM events
""")
def q_catalogue_provisions(spark, d):
    """I6 with the food vocabulary (Recoil Control is not in it), then
    I7 drink painkiller with its own label, then JSON (X11)."""
    from quartermaster.plans import items as I
    maps = spark.createDataFrame([], "pos bigint, name string, locks array<struct<key:struct<name:string>>>")
    pv = I.item_sources(event_pantry(spark, d), maps, AS_OF, only=["provisions"])["provisions"]
    return pv.select("id", "category", "energy", "hydration",
                     F.json_array_length("stim_effects").alias("n_effects"), _effect_content("stim_effects")[1].alias("fields"),
                     F.get_json_object("stim_effects", "$[0].krSkill").alias("first_label"),
                     F.element_at(F.from_json("stim_effects", "array<struct<krSkill:string>>"), -1)
                     ["krSkill"].alias("last_label"))


@register("update_from_join", """
WITH s AS (SELECT o_custkey, CAST(COUNT(*) AS DOUBLE) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey)
SELECT c_custkey, CASE WHEN s.o_custkey IS NOT NULL THEN s.n ELSE c_acctbal END AS c_acctbal
FROM customer LEFT JOIN s ON c_custkey = s.o_custkey
""")
def q_update_from_join(spark, d):
    """``UPDATE t SET c = s.x FROM s WHERE t.k = s.k`` - unmatched
    target rows unchanged; the source is an aggregate (one row per key)."""
    from quartermaster.operators.merge import update_from
    c = read_table(spark, d, "customer").select("c_custkey", "c_acctbal")
    s = (read_table(spark, d, "orders").filter(F.col("o_orderstatus") == "F")
         .groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).cast("double").alias("n")))
    return update_from(c, s, "c_custkey", {"c_acctbal": "n"})
