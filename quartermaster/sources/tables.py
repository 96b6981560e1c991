"""Relational tables landed as Parquet; A9: parameter (lookup) tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Tables the driver provides under ``sf_dir`` (one Parquet file each).
PROVIDED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
            "events", "documents", "embeddings", "pages", "benchmark", "labels",
            "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str, partitions: int | None = None) -> DataFrame:
    """One landed table. Parquet keeps filter push-down, column and
    nested-column pruning; nothing is inferred. ``partitions`` deals the rows
    out round-robin (for CPU-heavy work per row on a table that was written
    as a few large row groups)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.repartition(partitions) if partitions else df


def read_lookup(spark: SparkSession, path: str, schema: str, fmt: str = "csv") -> DataFrame:
    """A label dictionary kept as data (CSV with header, or Parquet).
    The schema is explicit; these tables are small by nature and are
    broadcast by Spark from their measured size."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        return reader.option("header", "true").option("mode", "FAILFAST").csv(path)
    return reader.format(fmt).load(path)


def lookup_from_pairs(spark: SparkSession, pairs, schema: str) -> DataFrame:
    """A small fixed dictionary (fixed values stated in code) as a DataFrame."""
    return spark.createDataFrame(list(pairs), schema)
