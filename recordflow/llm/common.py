"""What the training-data operators share: table access, shared scratch tables, span formatting."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Words are maximal runs of anything but space and U+0009..U+000D.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"

_local: dict[str, str] = {}
_written: dict[str, SparkSession] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; only a session in one JVM may go without the setting."""
    if at := spark.conf.get("spark.checkpoint.dir", None):
        return at
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by the cluster")
    return _local.setdefault("dir", "file://" + tempfile.mkdtemp(prefix="recordflow-"))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/recordflow/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written[path] = spark
    again = spark.read.schema(df.schema).parquet(path)
    again._scratch = path
    return again


def forget(df: DataFrame) -> None:
    """Deletes the scratch table that ``written`` returned as ``df``; nothing may read it any more."""
    path = df._scratch
    spark = _written.pop(path)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def drop_written() -> None:
    """Deletes the scratch tables of this process; results that read them must have been consumed."""
    for path, spark in list(_written.items()):
        _written.pop(path)
        try:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # the session has ended before the process; its folder goes with the job
            return


atexit.register(drop_written)


#: Bytes of an Arrow batch; one bound for all operators, so no plan depends on what is built after it.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches that hold whole texts by their bytes, whatever the number of rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def joined_spans(spans: list[tuple[str, int, int]], kinds: tuple[str, ...]) -> str:
    """``kind:start:end`` by start, then kind as listed, then end."""
    rank = {k: i for i, k in enumerate(kinds)}
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], rank[x[0]], x[2])))
