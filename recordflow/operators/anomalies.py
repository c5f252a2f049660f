"""Structural anomalies of a run: shards, source results, and the log of source lifecycles, one row a (code, shard, source)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sampling import balance

# Codes and their severity.
SEVERITY = {
    "MISSING_SHARD_ARTIFACT": "ERROR", "UNEXPECTED_SHARD_ARTIFACT": "WARNING", "SOURCE_ERROR": "ERROR", "MALFORMED_LIFECYCLE_EVENT": "WARNING",
    "ORPHAN_SOURCE_DONE": "WARNING", "LIFECYCLE_SOURCE_ERROR": "ERROR", "INCOMPLETE_SOURCE_LIFECYCLE": "ERROR",
}
EVENT = "event string, source_id string, report_key string"


def found(log: DataFrame, expected: DataFrame, actual: DataFrame, results: DataFrame) -> DataFrame:
    """(code, severity, shard_id, source_id, n) from a log (shard_id, line_no, line) of JSON lines, expected and actual shards
    (shard_id), and results (shard_id, source_id, status); ``n`` counts what one row stands for.

    Starts and ends of a source and report are balanced in the order of lines, and never below nothing: an end without a start
    is an orphan, a start that is left over is incomplete.
    """
    none = F.lit("")
    only = lambda a, b, code: a.join(b, "shard_id", "left_anti").select(F.lit(code).alias("code"), "shard_id", none.alias("source_id"))
    parsed = log.where(F.trim("line") != "").withColumn("e", F.from_json("line", EVENT, {"mode": "PERMISSIVE"}))
    whole = F.try_parse_json("line").isNotNull()
    bad = parsed.where(~whole).select(F.lit("MALFORMED_LIFECYCLE_EVENT").alias("code"), "shard_id", none.alias("source_id"))
    e = parsed.where(whole).select("shard_id", "line_no", F.col("e.event").alias("event"), F.coalesce("e.source_id", none).alias("source_id"), F.coalesce("e.report_key", "e.source_id", none).alias("report_key"))
    failed = e.where("event = 'source_error'").select(F.lit("LIFECYCLE_SOURCE_ERROR").alias("code"), "shard_id", "source_id")
    turns = e.where("event IN ('source_start', 'source_done')").withColumn("key", F.struct("shard_id", "source_id", "report_key"))
    b = balance(turns, "key", ["line_no"], F.when(F.col("event") == "source_start", 1).otherwise(-1))
    each = lambda code, n: b.where(F.col(n) > 0).select(F.lit(code).alias("code"), "key.shard_id", "key.source_id", F.col(n).alias("n"))
    errors = results.where(F.upper("status") == "ERROR").select(F.lit("SOURCE_ERROR").alias("code"), "shard_id", "source_id")
    rows = only(expected, actual, "MISSING_SHARD_ARTIFACT").unionByName(only(actual, expected, "UNEXPECTED_SHARD_ARTIFACT")).unionByName(errors).unionByName(bad).unionByName(failed)
    rows = rows.withColumn("n", F.lit(1).cast("long")).unionByName(each("ORPHAN_SOURCE_DONE", "orphan_done")).unionByName(each("INCOMPLETE_SOURCE_LIFECYCLE", "incomplete"))
    severity = F.lit(None).cast("string")
    for code, s in SEVERITY.items():
        severity = F.when(F.col("code") == code, s).otherwise(severity)
    return rows.groupBy("code", "shard_id", "source_id").agg(F.sum("n").alias("n")).select("code", severity.alias("severity"), "shard_id", "source_id", "n")
