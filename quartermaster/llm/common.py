"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermaster.session import ensure_checkpoint_dir, materialize
from quartermaster.workers import map_batches

__all__ = ["read", "ids_and_texts", "row_key", "materialize", "stage", "byte_chunks", "binary_column", "map_batches",
           "free_name"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the provided tables."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ids_and_texts(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` and nothing else (whatever other columns the table
    has, and whatever their names); a NULL text is the empty text."""
    return docs.select(docs["doc_id"].alias("doc_id"),
                       F.coalesce(docs["text"], F.lit("")).alias("text"))


def row_key(docs: DataFrame):
    """A key of a document row that also tells rows apart which share a
    ``doc_id`` (or have none) but differ in text. Exactly repeated rows share
    it, and so share every result."""
    return F.xxhash64(docs["doc_id"], docs["text"])


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: cuts the lineage like ``checkpoint()``, but compressed and columnar.
    For the wider tables that several later steps read."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as make it the name of no
    column of ``docs`` (names differ by more than case)."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def binary_column(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A string column of a batch as UTF-8 bytes (NULL: empty)."""
    col = batch.column(batch.schema.get_field_index(name))
    kind = pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()
    return [b or b"" for b in col.cast(kind).to_pylist()]


def byte_chunks(texts: list[bytes], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges ``[a, b)`` of ``texts`` holding about ``most`` bytes each
    (one row at least), so that arrays over a batch stay small."""
    a, size = 0, 0
    for b, t in enumerate(texts):
        if size and size + len(t) > most:
            yield a, b
            a, size = b, 0
        size += len(t)
    if a < len(texts):
        yield a, len(texts)


def long_array(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64, copy=False), pa.int64())
