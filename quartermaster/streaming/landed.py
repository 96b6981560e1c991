"""Micro-batch driving of the keyed merge for documents landing over time.

The catalogue has no streaming operator: every job recomputes from full
inputs on a schedule. Where documents land as files, the same merge (B1)
can be driven incrementally: Structured Streaming tracks which files were
processed (checkpoint in the shared folder), and ``foreachBatch`` applies
:func:`merge` to the current table version and publishes a new one.
``availableNow`` processes what has landed and stops, like a scheduled run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermaster.operators.bucketed import merge_into_path
from quartermaster.operators.index import publish_all, read_published
from quartermaster.operators.merge import merge


def merge_landed(spark: SparkSession, landing: str, schema: str, root: str, table: str,
                 key: str | list[str], insert_cols: list[str], build: Callable[[DataFrame], DataFrame],
                 checkpoint: str, update_cols: list[str] | None = None,
                 order_col: str = "pos", buckets: int | None = None,
                 target_schema: str | None = None) -> None:
    """Merge every newly landed JSON-lines file under ``landing`` into the
    published ``table`` (inside a batch the last row wins by the time and
    name of its file, then by ``order_col``; batches apply in arrival order;
    a batch that is retried after it was published changes nothing). ``build`` turns documents into source rows
    (one of the ``*_rows`` functions). With ``buckets`` the table is kept as
    Parquet partitioned by key bucket and each batch rewrites only the
    buckets it touches (:func:`merge_into_path`); otherwise every batch
    publishes a new version of the whole table."""

    # one total order for a batch of several files: a later file replaces an earlier one
    order = F.struct(F.col("_metadata.file_modification_time").alias("at"),
                     F.col("_metadata.file_name").alias("file"), F.col(order_col).alias("pos"))

    def apply(batch: DataFrame, batch_id: int) -> None:
        src = build(batch.withColumn(order_col, order))
        if buckets:
            # large target: rewrite only the key buckets this batch touches
            merge_into_path(src, f"{root.rstrip('/')}/{table}", key, insert_cols,
                            update_cols=update_cols, order_cols=order_col, buckets=buckets,
                            target_schema=target_schema)
            return
        new = merge(read_published(spark, root, table), src, key, insert_cols=insert_cols,
                    update_cols=update_cols, order_cols=order_col)
        publish_all({table: new}, root, version=f"b{batch_id:012d}")

    q = (spark.readStream.schema(schema).option("mode", "FAILFAST").json(landing)
         .select("*", "_metadata")
         .writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
