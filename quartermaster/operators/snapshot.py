"""Dated snapshots with verification and retention."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermaster.functions.scalars import date_stamp

SNAP_COL = "snapshot_date"


def _date(as_of) -> _dt.date:
    if isinstance(as_of, _dt.datetime):
        return as_of.date()
    if isinstance(as_of, _dt.date):
        return as_of
    return _dt.date.fromisoformat(str(as_of)[:10])


def stamp(df: DataFrame, as_of) -> DataFrame:
    """Tag rows with the zero-padded ISO date of the run."""
    return df.withColumn(SNAP_COL, date_stamp(as_of))


def snapshot(tables: dict[str, DataFrame], root: str, as_of) -> dict[str, str]:
    """Write each table under ``root/<name>/snapshot_date=<date>``.
    Dynamic partition overwrite replaces only today's partition, so a rerun
    of the same day is idempotent and older snapshots are untouched."""
    paths = {}
    for name, df in tables.items():
        path = f"{root.rstrip('/')}/{name}"
        (stamp(df, as_of).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy(SNAP_COL).parquet(path))
        paths[name] = path
    return paths


def read_snapshot(spark: SparkSession, root: str, name: str, as_of) -> DataFrame:
    """One day's snapshot; the equality on the partition column prunes the
    scan to that folder."""
    return (spark.read.parquet(f"{root.rstrip('/')}/{name}")
            .filter(F.col(SNAP_COL) == F.lit(_date(as_of).isoformat()).cast("date")))


def table_digest(df: DataFrame) -> tuple[int, int, int]:
    """An order-free digest of a table's rows: their number and the sums of
    two 64-bit hashes of each (exact decimals, so the order of partitions and
    of columns does not matter). A changed, moved, added or lost value changes
    it, unless two unlikely 64-bit sums agree by chance. One pass, partially
    aggregated; three numbers reach the driver."""
    def part(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            return F.to_json(c, {"ignoreNullFields": "false"})  # a hash of nested values would skip their NULLs
        return c
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    missing = F.concat(F.lit("n"), *[F.when(F.col(f"`{f.name}`").isNull(), "1").otherwise("0") for f in fields])
    values = [part(f) for f in fields]
    total = lambda h: F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0))
    row = df.agg(F.count(F.lit(1)), total(F.xxhash64(missing, *values)), total(F.xxhash64(F.lit("second"), *values, missing))).first()
    return int(row[0]), int(row[1]), int(row[2])


def verify_snapshot(spark: SparkSession, root: str, name: str, source: DataFrame, as_of) -> bool:
    """B14 gate: the new snapshot holds the rows of its source, by
    :func:`table_digest`. Old snapshots may only be dropped when this holds."""
    return table_digest(read_snapshot(spark, root, name, as_of).drop(SNAP_COL)) == table_digest(source)


def retain(df: DataFrame, keep_days: int, as_of, col: str = SNAP_COL) -> DataFrame:
    """B14 (T23): snapshots no older than ``keep_days`` full days before
    ``as_of`` (``as_of - date <= keep_days``). A literal range on the
    partition column, so the scan is pruned."""
    first = _date(as_of) - _dt.timedelta(days=keep_days)
    return df.filter(F.col(col).cast("date") >= F.lit(first.isoformat()).cast("date"))


def apply_retention(spark: SparkSession, root: str, name: str, keep_days: int, as_of) -> list[str]:
    """Remove the partition folders of ``name`` that :func:`retain`
    would not read, and return their dates. Only to be called once
    :func:`verify_snapshot` holds for the run's own snapshot. The dates are a
    handful of folder names; no data passes through the driver."""
    path = f"{root.rstrip('/')}/{name}"
    gone = sorted(str(r[0]) for r in expired_snapshots(spark.read.parquet(path), keep_days, as_of).collect())
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for date in gone:
        folder = hadoop.Path(f"{path}/{SNAP_COL}={date}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return gone


def expired_snapshots(df: DataFrame, keep_days: int, as_of, col: str = SNAP_COL) -> DataFrame:
    """The snapshot dates that retention would remove."""
    first = _date(as_of) - _dt.timedelta(days=keep_days)
    return (df.filter(F.col(col).cast("date") < F.lit(first.isoformat()).cast("date"))
            .select(col).distinct())
