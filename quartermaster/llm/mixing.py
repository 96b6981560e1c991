"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in a fixed shuffled order (MD5 of
the id), read up to three times over. A document's virtual finish time is
the number of its source's words up to its end, divided by the source's
target; all queues merge in the order of finish times, and the mix ends
where its words would pass the total budget. Whole documents are taken.

A source may hold a third of all rows: running sums are taken inside
4,096 hash buckets of a source (or equal slices of virtual time) and carried
over by a table with one row per bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quartermaster.llm.common import free_name, materialize, read, row_key
from quartermaster.operators.index import contiguous_number

WEIGHTS = (5, 2, 1)
REPEATS = 3
WORD = r"[^\x20\x09-\x0D]+"
#: hex digits of the shuffle hash that name a bucket; slices of virtual time
_HEX, _SLICES = 3, 4096

ORACLE = r"""
WITH d AS (SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS u,
                  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS s, row_number() OVER (ORDER BY source NULLS LAST) AS rn FROM d GROUP BY source),
w AS (SELECT *, CASE (rn - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, (sum(s) OVER ())::BIGINT AS t FROM s),
r AS (SELECT *, 3 * s::DOUBLE / w AS ratio,
             coalesce(sum(3 * s) OVER (ORDER BY 3 * s::DOUBLE / w, rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS c,
             (sum(w) OVER (ORDER BY 3 * s::DOUBLE / w, rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS v FROM w),
k AS (SELECT t - c AS num, v AS den FROM r WHERE (t - c)::DOUBLE / v <= ratio ORDER BY ratio, rn LIMIT 1),
g AS (SELECT source, s, rn, t, CASE WHEN (w * num)::DOUBLE / den > 3 * s THEN (3 * s)::DOUBLE
                                    ELSE (w * num)::DOUBLE / den END AS target FROM w, k),
q AS (SELECT d.doc_id, d.u, d.size, g.s, g.rn, g.t, g.target,
             (sum(d.size) OVER (PARTITION BY g.rn ORDER BY d.u, d.doc_id, d.size ROWS UNBOUNDED PRECEDING))::BIGINT AS cum
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
i AS (SELECT q.*, e, (cum + e * s)::DOUBLE / target AS v FROM q, (VALUES (0), (1), (2)) AS x(e) WHERE cum - size + e * s < target),
o AS (SELECT *, sum(size) OVER (ORDER BY v, rn, u, doc_id, e ROWS UNBOUNDED PRECEDING) AS total FROM i),
n AS (SELECT rn, u, doc_id, cum, count(*) AS copies FROM o WHERE total <= t GROUP BY ALL)
SELECT q.doc_id, q.size, q.s AS source_size, q.target, (q.size * coalesce(n.copies, 0))::BIGINT AS taken
FROM q LEFT JOIN n ON q.rn = n.rn AND q.u = n.u AND q.doc_id = n.doc_id AND q.cum = n.cum
"""


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``(source, source_size, rn, target)`` for a table ``(source,
    source_size)`` with one row per source: sources by code point, NULL last,
    weigh ``weights`` in turn and share the sum of all sizes; a target above
    ``repeats`` times its source's size stops there, and what is over is
    shared again by weight until none is above.

    Only sums go to the driver, once for each time that another source stops.
    """
    null_last = [F.col("source").isNull().cast("int"), F.col("source")]
    s = materialize(contiguous_number(sources, null_last, "rn"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("rn") - 1, F.lit(len(weights))) + 1).cast("int"))
    s = s.withColumn("w", weight.cast("long")).withColumn("cap", repeats * F.col("source_size"))
    total, num, den = s.agg(F.sum("source_size"), F.sum("source_size"), F.sum("w")).first()
    share = F.lit(0.0)
    while total:
        share = (F.col("w") * F.lit(num)).cast("double") / F.lit(den)
        over = share > F.col("cap")
        c, left = s.agg(F.sum(F.when(over, F.col("cap")).otherwise(0)), F.sum(F.when(over, 0).otherwise(F.col("w")))).first()
        if (total - c, left) == (num, den):
            break
        num, den = total - c, left
    return s.select("source", "source_size", "rn",
                    F.when(share > F.col("cap"), F.col("cap").cast("double")).otherwise(share).alias("target"))


def _running(df: DataFrame, group: list[str], bucket: Column, order: list, out: str) -> DataFrame:
    """Running sum of ``size`` within ``group`` (all rows when empty) in the
    order of bucket and ``order``."""
    df = df.withColumn("__b", bucket)
    sums = df.groupBy(*group, "__b").agg(F.sum("size").alias("__n"))
    before = Window.partitionBy(*group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offset = sums.select(*group, "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    inside = Window.partitionBy(*group, "__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn(out, F.sum("size").over(inside))
    return df.join(offset, [*group, "__b"]).withColumn(out, F.col(out) + F.col("__off")).drop("__b", "__off")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``(doc_id, key, size, source_size, target, copies)`` for every row of
    ``docs``: its words, its source's words and target, and how many times the
    mix takes it (0 to ``repeats``); ``key`` is the row's key.

    NULL and empty texts have size 0; NULL is a source of its own, the last;
    rows without doc_id shuffle to one place, in the order of their sizes;
    repeated rows are rows of their own; a table without words has targets 0
    and takes nothing; an empty table gives an empty result.
    """
    size = F.regexp_count(F.coalesce(docs["text"], F.lit("")), F.lit(WORD)).cast("long")
    d = materialize(docs.select(docs["doc_id"].alias("doc_id"), row_key(docs).alias("key"), docs["source"].alias("source"),
                                size.alias("size"), F.md5(F.coalesce(docs["doc_id"].cast("string"), F.lit(""))).alias("u")))
    t = materialize(targets(d.groupBy("source").agg(F.sum("size").alias("source_size")), weights, repeats))
    total = t.agg(F.sum("source_size")).first()[0] or 0
    d = d.join(t, d["source"].eqNullSafe(t["source"])).drop("source")
    d = materialize(_running(d, ["rn"], F.substring("u", 1, _HEX), ["u", "doc_id", "size"], "cum"))

    s, cum, target = F.col("source_size"), F.col("cum"), F.col("target")
    place = lambda e: F.struct(((cum + e * s).cast("double") / target).alias("v"), F.col("rn").alias("rn"), F.col("u").alias("u"),
                               F.col("doc_id").alias("doc_id"), e.cast("int").alias("e"))
    starts = lambda e: cum - F.col("size") + e * s < target
    items = (d.select("size", "rn", "u", "doc_id", "cum", "source_size", "target",
                      F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("e"))
             .filter(starts(F.col("e"))).select("size", place(F.col("e")).alias("at")))
    # all but one document a source finish before virtual time 1
    piece = F.least(F.floor(F.col("at.v") * _SLICES), F.lit(2 * _SLICES)).cast("int")
    merged = _running(items, [], piece, ["at"], "total")
    last = materialize(merged.filter(F.col("total") <= total).agg(F.max("at").alias("last")))  # one row
    taken = sum((F.when(starts(F.lit(e)) & (place(F.lit(e)) <= F.col("last")), 1).otherwise(0) for e in range(repeats)), F.lit(0))
    return (d.crossJoin(F.broadcast(last))  # one row: the end of the mix
            .select("doc_id", "key", "size", "source_size", "target", taken.alias("copies")))


def take(docs: DataFrame) -> DataFrame:
    """The mix itself: every row of ``docs`` (all columns) as many times as
    the mix takes it. Exactly repeated rows each come as often as the one
    taken most."""
    key, ident, copies, copy = (free_name(docs, n) for n in ("__key", "__id", "__copies", "__copy"))
    taken = (mix(docs).groupBy(F.col("key").alias(key), F.col("doc_id").alias(ident))
             .agg(F.max("copies").alias(copies)).filter(F.col(copies) > 0))
    out = docs.join(taken, (row_key(docs) == taken[key]) & docs["doc_id"].eqNullSafe(taken[ident]))
    return (out.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies))))
            .select(*(F.col(f"`{c}`") for c in docs.columns)))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
