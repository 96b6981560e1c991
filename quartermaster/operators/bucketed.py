"""Large keyed tables kept as Parquet by key bucket, with a manifest.

Layout of a table under its folder::

    data/v=<version>/key_bucket=<b>/...   rows of one bucket, never changed
    _manifest/                            one small file per commit

A commit names the folder of every bucket of its version; a version shares
the folders of the buckets it did not touch with the one before. Data is
written first and the manifest last, by one append of one file: a run that
dies before it leaves folders that no manifest names, and the next run starts
from the version before as if nothing had happened. Readers open the folders
of one version, so they see neither half a run nor a change while they read.

One writer at a time. :func:`remove_unused` deletes what no kept version
names; run it after a commit, by the writer.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermaster.operators.merge import _as_list, last_per_key, merge
from quartermaster.session import materialize

BUCKET_COL = "key_bucket"
_MANIFEST = ("version bigint, bucket int, folder string, buckets int, key array<string>, "
             "schema string, committed_at timestamp")


@dataclass(frozen=True)
class Version:
    """What one commit holds: the folder of each bucket that has rows."""
    number: int
    folders: dict[int, str]
    buckets: int
    key: list[str]
    schema: str


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """Stable bucket of a key: ``pmod(xxhash64(key...), buckets)``."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def _log(spark: SparkSession, path: str) -> DataFrame | None:
    """All commits; None when there is no table yet. Any other trouble in
    reading them is an error."""
    try:
        return spark.read.schema(_MANIFEST).parquet(f"{path.rstrip('/')}/_manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def current_version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The latest version (or the one asked for), read from its commit: at
    most one small row per bucket. None when nothing has been committed."""
    log = _log(spark, path)
    if log is None:
        return None
    if number is None:
        number = log.agg(F.max("version")).first()[0]
    rows = log.filter(F.col("version") == number).collect() if number is not None else []
    if not rows:
        if number is None:
            return None
        raise ValueError(f"{path} has no version {number}")
    return Version(number, {r["bucket"]: r["folder"] for r in rows if r["bucket"] >= 0}, rows[0]["buckets"],
                   list(rows[0]["key"]), rows[0]["schema"])


def _commit(spark: SparkSession, path: str, version: Version) -> None:
    """Make ``version`` the latest one: a single file is appended."""
    at = _dt.datetime.now(_dt.timezone.utc)
    head = (version.number, -1, None, version.buckets, version.key, version.schema, at)
    rows = [head] + [(version.number, b, f, version.buckets, version.key, version.schema, at)
                     for b, f in sorted(version.folders.items())]
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/_manifest")


def _read(spark: SparkSession, path: str, version: Version, buckets: Sequence[int] | None = None) -> DataFrame:
    folders = [f"{path.rstrip('/')}/{f}" for b, f in sorted(version.folders.items()) if buckets is None or b in set(buckets)]
    if not folders:
        return spark.createDataFrame([], version.schema)
    return spark.read.schema(version.schema).parquet(*folders)


def read_bucketed(spark: SparkSession, path: str, number: int | None = None, keys: DataFrame | None = None) -> DataFrame:
    """The table at its latest version (or version ``number``). With ``keys``,
    a table of key values, only the buckets that hold them are opened."""
    version = current_version(spark, path, number)
    if version is None:
        raise FileNotFoundError(f"no table at {path}")
    if keys is None:
        return _read(spark, path, version)
    wanted = [r[0] for r in keys.select(key_bucket(version.key, version.buckets)).distinct().collect()]
    return _read(spark, path, version, wanted)


def merge_into_path(source: DataFrame, path: str, key: str | Sequence[str],
                    insert_cols: Sequence[str], update_cols: Sequence[str] | None = None,
                    order_cols: str | Sequence[str | Column] | None = None,
                    duplicates: str = "last", buckets: int = 64,
                    target_schema: str | None = None) -> list[int]:
    """B1 for a large target: only the buckets that the source touches are
    read, merged and written anew, and the run becomes visible by one commit.

    The number of buckets and the key are part of the table and must be the
    same ever after: others would look for a key in another folder, so a
    mismatch fails. Choose the number so that a bucket is a few hundred
    megabytes.

    1. the source is reduced and checkpointed once; the buckets it touches
       (at most ``buckets`` small integers) reach the driver;
    2. only their folders are read;
    3. :func:`merge` on that slice, dealt out by bucket so that each folder is
       written by one task, into folders of a new version;
    4. the commit names these and, for all other buckets, the folders of the
       version before.

    Only a missing table starts empty (with ``target_schema``). A run that
    died is simply run again. Returns the touched buckets.
    """
    spark = source.sparkSession
    keys = _as_list(key)
    before = current_version(spark, path)
    if before is None:
        if target_schema is None:
            raise ValueError(f"no table at {path}: a first run needs target_schema")
        before = Version(0, {}, buckets, keys, target_schema)
    elif before.buckets != buckets:
        raise ValueError(f"{path} has {before.buckets} buckets, not {buckets}")
    elif before.key != keys:
        raise ValueError(f"{path} is keyed by {before.key}, not {keys}")
    src = source
    if duplicates == "last":
        if order_cols is None:
            raise ValueError("duplicates='last' needs order_cols")
        src = last_per_key(source, keys, order_cols, insert_cols)
    src = materialize(src.select(*keys, *insert_cols))
    touched = sorted(r[0] for r in src.select(key_bucket(keys, buckets)).distinct().collect())
    merged = merge(_read(spark, path, before, touched), src, keys, insert_cols=insert_cols,
                   update_cols=update_cols if update_cols is not None else insert_cols, duplicates="error")
    number = before.number + 1
    folder = f"data/v={number}-{uuid.uuid4().hex[:12]}"
    if touched:
        (merged.withColumn(BUCKET_COL, key_bucket(keys, buckets)).repartition(BUCKET_COL)
         .write.partitionBy(BUCKET_COL).parquet(f"{path.rstrip('/')}/{folder}"))
    new = {b: f"{folder}/{BUCKET_COL}={b}" for b in touched}
    _commit(spark, path, Version(number, before.folders | new, buckets, keys, before.schema))
    return touched


def remove_unused(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete the bucket folders that none of the last ``keep`` versions
    names: those of older versions and of runs that died. Returns them (folder
    names, at most one per bucket and run; no data passes the driver)."""
    log = _log(spark, path)
    if log is None:
        return []
    last = log.agg(F.max("version")).first()[0]
    used = {r[0] for r in log.filter((F.col("version") > last - keep) & (F.col("bucket") >= 0)).select("folder").distinct().collect()}
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(f"{path.rstrip('/')}/data")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = []
    for run in (fs.listStatus(root) if fs.exists(root) else []):
        names = [f.getPath().getName() for f in fs.listStatus(run.getPath())]
        parts = [n for n in names if n.startswith(f"{BUCKET_COL}=")]
        unused = [n for n in parts if f"data/{run.getPath().getName()}/{n}" not in used]
        gone += [f"data/{run.getPath().getName()}/{n}" for n in unused]
        if len(unused) == len(parts):
            fs.delete(run.getPath(), True)
        else:
            for n in unused:
                fs.delete(hadoop.Path(run.getPath(), n), True)
    return sorted(gone)
