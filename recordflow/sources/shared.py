"""Folders that the driver and all executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir; only a session in one JVM may go without the setting."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by the cluster")
        at = _local.setdefault("dir", "file://" + tempfile.mkdtemp(prefix="recordflow-"))
    return f"{at}/{name}-{uuid.uuid4().hex}"


def use_checkpoints(spark: SparkSession) -> None:
    """Checkpoints go to the shared folder; a folder that the cluster has set stays."""
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark, "checkpoints"))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a compressed table in the shared folder: cuts the lineage, as a checkpoint does, in fewer bytes."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def freed(spark: SparkSession) -> None:
    """Has the files of shuffles deleted that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Bytes of an Arrow batch, the bound that the text operators set too.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches that hold whole texts by their bytes, whatever the number of rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
