"""Search index (U1-U5), contiguous global numbering (W2) and versioned
table publication (B7, and the all-or-nothing publish used by B11)."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quartermaster.functions.scalars import prefixed_text
from quartermaster.session import materialize

_IDX_BITS = 33  # monotonically_increasing_id = partition << 33 | row index


@dataclass
class IndexEmit:
    """One output row shape: ``prefix || name`` as value, ``path || id`` (or
    the bare ``path`` when ``with_id`` is False, U5) as link."""
    prefix: str
    name_col: object  # column name or Column
    path: str
    type: str
    with_id: bool = True


@dataclass
class IndexBranch:
    """A source table and the rows it contributes to the index. Several
    emits read the table once and give one row each (U2: the same table in
    two languages; U3: under two paths)."""
    table: DataFrame
    emits: list[IndexEmit]
    id_col: str = "id"


def build_index(branches: list[IndexBranch]) -> DataFrame:
    """``(value, link, page_value, type, branch)`` - the union of all
    branches, no de-duplication. ``value`` is NULL when the name is NULL
    (T11); ids of every table are text (T12). ``branch`` is the position in
    the union, kept for ordering."""
    parts = []
    b = 0
    for br in branches:
        rows = []
        for e in br.emits:
            pid = F.col(br.id_col).cast("string")
            link = prefixed_text(e.path, pid) if e.with_id else F.lit(e.path)
            rows.append(F.struct(
                prefixed_text(e.prefix, e.name_col).alias("value"),
                link.alias("link"),
                pid.alias("page_value"),
                F.lit(e.type).alias("type"),
                F.lit(b).alias("branch")))
            b += 1
        if len(rows) == 1:
            parts.append(br.table.select(rows[0].alias("r")).select("r.*"))
        else:
            parts.append(br.table.select(F.inline(F.array(*rows))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def contiguous_number(df: DataFrame, order_cols: list, out: str = "order",
                      partitions: int | None = None) -> DataFrame:
    """``row_number()`` over the whole table by ``order_cols``, numbered
    1..n without gaps, without a single-partition window.

    1. range-partition by the order and sort each partition; tag rows with
       ``monotonically_increasing_id`` (partition id and row index);
    2. checkpoint, so both passes see the same rows in the same partitions
       (range bounds are sampled per job) and lost executors re-read instead
       of re-partitioning;
    3. count rows per partition (one row per partition), prefix-sum those
       counts on a table of ``partitions`` rows and broadcast it;
    4. number = offset of the partition + row index + 1.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = list(df.columns)
    # last range key: the row's position in its input split. Rows equal on
    # the order (a third of the table could be one repeated value) then still
    # spread over several range partitions instead of landing in one task;
    # their relative order is immaterial (they are indistinguishable).
    keys = list(order_cols) + ["__tie"]
    ranged = (df.withColumn("__tie", F.monotonically_increasing_id())
              .repartitionByRange(n, *keys)
              .sortWithinPartitions(*keys)
              .withColumn("__mid", F.monotonically_increasing_id()))
    ranged = materialize(ranged)
    ranged = ranged.select(*cols,
                           F.shiftright("__mid", _IDX_BITS).alias("__pid"),
                           F.col("__mid").bitwiseAND((1 << _IDX_BITS) - 1).alias("__idx"))
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    return (ranged.join(F.broadcast(offsets), "__pid")
            .select(*cols, (F.col("__off") + F.col("__idx") + 1).cast("bigint").alias(out)))


def search_index(branches: list[IndexBranch]) -> DataFrame:
    """P32 body: ``(value, link, page_value, type, order)`` numbered by
    (branch, page_value, value, link)."""
    idx = build_index(branches)
    numbered = contiguous_number(idx, ["branch", "page_value", "value", "link"])
    return numbered.select("value", "link", "page_value", "type", "order")


# ---------------------------------------------------------------- publication

def _versions_path(root: str) -> str:
    return f"{root.rstrip('/')}/_versions"


def publish_all(tables: dict[str, DataFrame], root: str, version: str | None = None) -> dict[str, str]:
    """Write each table to a new version folder, then commit all
    of them with a single append to the version log. Readers never see a
    half-written or empty table, and a failure before the log append
    publishes nothing. Publishing a ``version`` that the log already holds
    does nothing (a retried run), and what an unfinished attempt at it left
    behind is written over."""
    if not tables:
        return {}
    spark = next(iter(tables.values())).sparkSession
    if version is not None:
        done = _committed(spark, root, version)
        if set(tables) <= set(done):
            return {name: done[name] for name in tables}
    version = version or _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S%fZ")
    paths = {}
    for name, df in tables.items():
        path = f"{root.rstrip('/')}/{name}/v={version}"
        df.write.mode("overwrite").parquet(path)
        paths[name] = path
    committed = _dt.datetime.now(_dt.timezone.utc)
    log = spark.createDataFrame([(n, version, p, committed) for n, p in paths.items()],
                                "name string, version string, path string, committed_at timestamp")
    log.coalesce(1).write.mode("append").parquet(_versions_path(root))
    return paths


def _committed(spark: SparkSession, root: str, version: str) -> dict[str, str]:
    """The tables that the log holds for ``version`` (a few small rows)."""
    try:
        log = spark.read.parquet(_versions_path(root))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return {r["name"]: r["path"] for r in log.filter(F.col("version") == version).collect()}


def replace_table(df: DataFrame, root: str, name: str, version: str | None = None) -> str:
    """Truncate-and-reload as a version switch (never overwrite the path
    being read)."""
    return publish_all({name: df}, root, version)[name]


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The latest committed version of ``name`` (one small row read from the
    version log)."""
    log = spark.read.parquet(_versions_path(root)).filter(F.col("name") == name)
    # latest commit wins, whatever the version labels look like
    row = log.orderBy(F.col("committed_at").desc(), F.col("version").desc()).select("path").first()
    if row is None:
        raise FileNotFoundError(f"no published version of {name} under {root}")
    return spark.read.parquet(row["path"])
