"""Session helpers: building a local session for tests and resolving the
shared checkpoint folder of whatever session we are handed."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Settings every job in this package assumes. AQE re-plans joins and
#: partition counts at run time and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove reliable-checkpoint files once their DataFrame is garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "quartermaster") -> SparkSession:
    """A local session for tests and the benchmark (never used on a cluster:
    there the caller hands us its own session)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = (builder
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("QM_DRIVER_MEMORY", "8g")))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder of this session.

    On a cluster it is the shared folder that ``spark.checkpoint.dir`` names;
    without one this raises, because a folder of one machine is not seen by
    the others. Only where everything runs on one machine (a ``local[n]``
    master, as in tests) a fresh local folder is set when none is named.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            configured = tempfile.mkdtemp(prefix="qm-ckpt-")
        sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder.

    Used where two passes over the same data must see *identical*
    partitions (range partitioning samples its bounds per job), and where a
    lost executor must not force a recompute that could re-partition rows.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
