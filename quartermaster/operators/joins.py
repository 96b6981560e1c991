"""The backward threshold join (D4 + W1 / E6) in two strategies.

Which one runs is the caller's explicit choice; both give the same rows.
Ordinary lookups in this package are plain equi-joins: Spark broadcasts a
side from its measured size at run time, and no job counts anything while a
query is being built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quartermaster.session import materialize

#: Most rows a threshold table may have under ``strategy="broadcast"``; a
#: larger one fails the job (use ``strategy="sweep"``).
BROADCAST_THRESHOLDS = 10_000


def threshold_lookup(facts: DataFrame, value_col: str, thresholds: DataFrame,
                     threshold_col: str, payload: Sequence[str],
                     tie_cols: Sequence[str] = (), prefix: str = "",
                     strategy: str = "broadcast") -> DataFrame:
    """D4 + W1/E6: attach to every fact the threshold row with the largest
    ``threshold_col <= value_col``. Ties on the threshold go to the largest
    ``tie_cols``, then to the largest payload, so the result does not depend
    on the strategy or on row order. Facts without such a row (value NULL or
    below the lowest threshold) get NULL payload; every fact row is kept
    exactly once.

    Equivalent to ``JOIN ... ON value >= threshold`` followed by
    ``ROW_NUMBER() OVER (PARTITION BY fact ORDER BY threshold DESC) = 1``,
    without materialising the fact x threshold pairs.

    * ``broadcast``: for a parameter table of at most
      :data:`BROADCAST_THRESHOLDS` distinct thresholds (more fail the job at
      run time). Intervals ``[t_i, t_{i+1})`` are computed on that table, and
      one broadcast left join matches each fact to at most one interval - no
      shuffle of the facts.
    * ``sweep``: any size, any orderable type (:func:`_threshold_sweep`).
    """
    if strategy not in ("broadcast", "sweep"):
        raise ValueError("strategy must be 'broadcast' or 'sweep'")
    payload, ties = list(payload), list(tie_cols)
    thr = (thresholds.select(F.col(threshold_col).alias("__t"), F.struct(*payload).alias("__p"),
                             F.struct(*ties, F.struct(*payload).alias("__all")).alias("__r"))
           .filter(F.col("__t").isNotNull())
           .groupBy("__t").agg(F.max_by("__p", "__r").alias("__p")))
    if strategy == "sweep":
        j = _threshold_sweep(facts, value_col, thr)
    else:
        w = Window.orderBy("__t")  # a bounded parameter table: one partition is fine
        checked = F.when(F.count(F.lit(1)).over(Window.partitionBy()) > BROADCAST_THRESHOLDS, F.raise_error(F.lit(
            f"more than {BROADCAST_THRESHOLDS} thresholds: use strategy='sweep'"))).otherwise(F.col("__t"))
        intervals = thr.select(checked.alias("__t"), F.lead("__t").over(w).alias("__next"), "__p")
        cond = (F.col(value_col) >= F.col("__t")) & \
            (F.col("__next").isNull() | (F.col(value_col) < F.col("__next")))
        j = facts.join(F.broadcast(intervals), cond, "left")
    return j.select(*facts.columns, *[F.col("__p")[c].alias(prefix + c) for c in payload])


def _threshold_sweep(facts: DataFrame, value_col: str, thr: DataFrame) -> DataFrame:
    """Distributed backward as-of lookup.

    1. reduce the facts to their distinct values (partial aggregation absorbs
       a hot value) and union them with the thresholds;
    2. range-partition the union by value and checkpoint it, so that later
       passes see the same partitions;
    3. running maximum inside each partition, and the maximum of all earlier
       partitions from a table with one row per partition;
    4. equi-join the facts back on the value: the value -> payload side is
       unique, so a hot value on the fact side is split by AQE.
    """
    # the distinct values and the final join both read the facts: the plan
    # that produces them (a multi-join aggregate, typically) runs one time
    facts = materialize(facts)
    value = F.col(value_col)
    best: Column = F.struct(F.col("__t"), F.col("__p"))
    kind = thr.select(best.alias("__s")).schema["__s"].dataType
    vals = (facts.select(value.alias("__t")).filter(F.col("__t").isNotNull()).distinct()
            .select("__t", F.lit(1).alias("__kind"), F.lit(None).cast(kind).alias("__s")))
    n = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(thr.select("__t", F.lit(0).alias("__kind"), best.alias("__s")).unionByName(vals)
                         .repartitionByRange(n, "__t", "__kind")
                         .withColumn("__b", F.spark_partition_id()))
    w = (Window.partitionBy("__b").orderBy("__t", "__kind")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    wc = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    # thresholds only grow with the partition: the last one seen is the largest
    last = F.max_by("__s", "__t")
    carry = (ranged.filter("__kind = 0").groupBy("__b").agg(last.alias("__m"))
             .unionByName(ranged.select("__b").distinct().withColumn("__m", F.lit(None).cast(kind)))
             .groupBy("__b").agg(F.first("__m", ignorenulls=True).alias("__m"))
             .select("__b", F.last("__m", ignorenulls=True).over(wc).alias("__carry")))
    mapping = (ranged.withColumn("__own", F.last("__s", ignorenulls=True).over(w)).filter("__kind = 1")
               .join(F.broadcast(carry), "__b")  # one row per partition
               .select(F.col("__t").alias("__v"), F.coalesce("__own", "__carry")["__p"].alias("__p")))
    return facts.join(mapping, facts[value_col] == mapping["__v"], "left")
