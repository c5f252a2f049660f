"""Shard bundles and versioned state on any store that Spark can write.

A bundle is a directory of records with a manifest written last: count, digest, contract version.  The digest is a
sum and an exclusive or of row hashes, so that it needs no order and no single task.  State generations are committed by
creating a marker exclusively: the one writer that creates it wins, any other gets a conflict.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CONTRACT = "1"


class Conflict(RuntimeError):
    """Another writer has committed this generation."""


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def digest(df: DataFrame) -> tuple[int, str]:
    """(rows, digest) of a relation, whatever its order."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    n, x, s = df.agg(F.count("*"), F.bit_xor(h), F.sum(h.cast("decimal(38,0)"))).first()
    return n, f"{x}:{s}"


def write_bundle(df: DataFrame, root: str, run_id: str, shard_id: str, status: str = "OK") -> dict:
    """Writes records, then the manifest; an existing bundle is an error."""
    at = f"{root}/run_id={run_id}/shard_id={shard_id}"
    df.write.mode("errorifexists").parquet(f"{at}/records")
    n, d = digest(df.sparkSession.read.parquet(f"{at}/records"))
    manifest = {"contract": CONTRACT, "run_id": run_id, "shard_id": shard_id, "status": status, "rows": n, "digest": d}
    create(df.sparkSession, f"{at}/manifest.json", json.dumps(manifest, sort_keys=True))
    return manifest


def create(spark: SparkSession, path: str, content: str) -> None:
    """Creates a file that must not exist; the store decides between writers that try at once."""
    p, fs = _fs(spark, path)
    try:
        out = fs.create(p, False)
    except Exception as e:
        if "already exists" in str(e) or "FileAlreadyExists" in str(e):
            raise Conflict(path) from e
        raise
    out.write(bytearray(content.encode()))
    out.close()


def manifests(spark: SparkSession, root: str) -> DataFrame:
    schema = "contract string, run_id string, shard_id string, status string, rows long, digest string"
    return spark.read.schema(schema).json(f"{root}/run_id=*/shard_id=*/manifest.json")


def fan_in(spark: SparkSession, root: str, run_id: str) -> tuple[DataFrame | None, str]:
    """Records of all accepted shards of a run with their shard, and OK, PARTIAL or ERROR."""
    found = [r.asDict() for r in manifests(spark, root).where(F.col("run_id") == run_id).collect()]  # one row a shard
    good = sorted(m["shard_id"] for m in found if m["contract"] == CONTRACT and m["status"] != "ERROR" and verified(spark, root, m))
    if not good:
        return None, "ERROR"
    parts = [spark.read.parquet(f"{root}/run_id={run_id}/shard_id={s}/records").withColumn("shard_id", F.lit(s)) for s in good]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out, "OK" if len(good) == len(found) else "PARTIAL"


def verified(spark: SparkSession, root: str, manifest: dict) -> bool:
    at = f"{root}/run_id={manifest['run_id']}/shard_id={manifest['shard_id']}/records"
    return digest(spark.read.parquet(at)) == (manifest["rows"], manifest["digest"])


def latest(spark: SparkSession, root: str) -> int:
    """The highest committed generation, 0 if there is none."""
    p, fs = _fs(spark, root)
    if not fs.exists(p):
        return 0
    names = [x.getPath().getName() for x in fs.listStatus(p)]
    return max((int(n.removeprefix("committed-")) for n in names if n.startswith("committed-")), default=0)


def load_state(spark: SparkSession, root: str) -> DataFrame | None:
    n = latest(spark, root)
    return spark.read.parquet(f"{root}/generation={n}/{_data(spark, root, n)}") if n else None


def _data(spark: SparkSession, root: str, n: int) -> str:
    return spark.read.text(f"{root}/committed-{n}").first()[0]


def publish_state(df: DataFrame, root: str, based_on: int) -> int:
    """Commits ``df`` as the generation after ``based_on``; a stale writer gets a conflict and changes nothing."""
    import uuid

    n, name = based_on + 1, uuid.uuid4().hex
    df.write.parquet(f"{root}/generation={n}/{name}")
    create(df.sparkSession, f"{root}/committed-{n}", name)
    return n


def publish_report(df: DataFrame, root: str) -> int:
    """As ``publish_state``, but the payload is read back and compared before the pointer names it."""
    import uuid

    spark, name = df.sparkSession, uuid.uuid4().hex
    n = latest(spark, root) + 1
    at = f"{root}/generation={n}/{name}"
    df.write.parquet(at)
    if digest(spark.read.parquet(at)) != digest(df):
        raise ValueError(f"the payload of generation {n} reads back differently")
    create(spark, f"{root}/committed-{n}", name)
    return n


def restore(spark: SparkSession, root: str, generation: int) -> int:
    """Makes an old generation the newest one."""
    old = spark.read.parquet(f"{root}/generation={generation}/{_data(spark, root, generation)}")
    return publish_state(old, root, latest(spark, root))
