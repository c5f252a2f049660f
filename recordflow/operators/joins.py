"""Lookups, routing and merges as equi joins with explicit completeness checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unambiguous(aliases: DataFrame, alias: str, owner: str) -> DataFrame:
    """(alias, owner) for aliases that one owner holds; the owners are counted before anything is joined."""
    one = aliases.groupBy(alias).agg(F.min(owner).alias(owner), F.max(owner).alias("__last"))
    return one.where(F.col(owner) == F.col("__last")).drop("__last")


def conflicts(aliases: DataFrame, alias: str, owner: str) -> DataFrame:
    """Aliases with several owners, and how many."""
    return aliases.groupBy(alias).agg(F.count_distinct(owner).alias("owners")).where("owners > 1")


def resolve(records: DataFrame, record: str, alias: str, index: DataFrame, owner: str) -> DataFrame:
    """(record, owner, owners) by any alias: null if none matches; a record of two owners is reported by its count."""
    hit = records.select(record, alias).join(index, alias, "left")
    return hit.groupBy(record).agg(F.min(owner).alias(owner), F.count_distinct(owner).alias("owners"))


def routes(candidates: DataFrame, key: str, main: DataFrame, rescue: DataFrame) -> DataFrame:
    """(key, route): MAIN, RESCUE for those that are not main, MISSING for ids that are no candidate."""
    have = candidates.select(key).distinct()
    first = main.select(key).distinct()
    second = rescue.select(key).distinct().join(first, key, "left_anti")
    named = first.withColumn("route", F.lit("MAIN")).unionByName(second.withColumn("route", F.lit("RESCUE")))
    here = have.withColumn("__here", F.lit(True))
    return named.join(here, key, "left").select(
        key, F.when(F.col("__here"), F.col("route")).otherwise("MISSING").alias("route")
    )


def last_of(rows: DataFrame, key: str, order: Column, *columns: str) -> DataFrame:
    """The last row of each key, by a partial aggregate: no sort, no window."""
    last = F.max_by(F.struct(*columns), order)
    return rows.groupBy(key).agg(last.alias("__x")).select(key, *[F.col(f"__x.{c}") for c in columns])


def left_with(left: DataFrame, right: DataFrame, key: str, missing: dict) -> DataFrame:
    """Left join with defaults for what is missing."""
    out = left.join(right, key, "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in missing.items()})


def merge_first(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """All of the first, and those of the second whose key the first lacks."""
    return first.unionByName(second.join(first.select(key), key, "left_anti"))


def differences(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """(key, side): what is expected and missing, and what is there unexpectedly."""
    e, a = expected.select(key).distinct(), actual.select(key).distinct()
    missing = e.join(a, key, "left_anti").withColumn("side", F.lit("MISSING"))
    return missing.unionByName(a.join(e, key, "left_anti").withColumn("side", F.lit("UNEXPECTED")))


def complete(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join that fails if a row of the left has no partner."""
    out = left.join(right.withColumn("__hit", F.lit(True)), key, "left")
    ok = F.assert_true(F.col("__hit").isNotNull(), F.concat(F.lit("no partner for "), F.col(key).cast("string")))
    return out.withColumn("__ok", ok).where("__ok IS NULL").drop("__hit", "__ok")
