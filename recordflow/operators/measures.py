"""Aggregates: rollups, scores, percentiles, inventories and digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def top(df: DataFrame, key: str, order: str, size: int) -> DataFrame:
    """The most frequent values; ties in order of first appearance."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"), F.min(order).alias("first_seen"))
    place = F.row_number().over(W.orderBy(F.desc("n"), "first_seen"))
    best = counts.orderBy(F.desc("n"), "first_seen").limit(size)  # cut before the window sees one partition
    return best.withColumn("place", place)


def confusion(df: DataFrame, expected: str, predicted: str) -> DataFrame:
    return df.groupBy(expected, predicted).agg(F.count("*").alias("n"))


def scores(df: DataFrame, expected: Column, predicted: Column) -> DataFrame:
    """Accuracy, precision and recall of a boolean; without predictions precision is 1 if nothing was expected."""
    hit, n_p, n_e = F.count_if(expected & predicted), F.count_if(predicted), F.count_if(expected)
    return df.agg(
        F.count("*").alias("n"),
        F.round(F.count_if(expected == predicted) / F.count("*"), 6).alias("accuracy"),
        F.round(F.when(n_p > 0, F.try_divide(hit, n_p)).otherwise(F.when(n_e == 0, 1.0).otherwise(0.0)), 6).alias("precision"),
        F.round(F.when(n_e > 0, F.try_divide(hit, n_e)).otherwise(1.0), 6).alias("recall"),
    )


def nearest_rank(df: DataFrame, group: str, value: str, shares: list[float]) -> DataFrame:
    """The value at index round((n - 1) * p), half to even, of each group: (group, p, value).

    Values are counted first, so a group needs as many rows as it has different values.
    """
    counts = df.groupBy(group, value).agg(F.count("*").alias("k"))
    upto = F.sum("k").over(W.partitionBy(group).orderBy(value).rowsBetween(W.unboundedPreceding, 0))
    ranked = counts.withColumn("hi", upto).withColumn("lo", F.col("hi") - F.col("k"))
    ranked = ranked.withColumn("n", F.sum("k").over(W.partitionBy(group)))
    ps = ranked.withColumn("p", F.explode(F.array(*[F.lit(p) for p in shares])))
    at = F.bround((F.col("n") - 1) * F.col("p"))
    return ps.where((at >= F.col("lo")) & (at < F.col("hi"))).select(group, "p", F.col(value).alias("value"))


def id_digest(df: DataFrame, key: str) -> DataFrame:
    """An order-independent digest of a set of ids: the sum and the exclusive or of their hashes, and their count."""
    h = F.xxhash64(F.col(key).cast("string"))
    return df.agg(F.count("*").alias("n"), F.bit_xor(h).alias("xor"), F.sum(h.cast("decimal(38,0)")).alias("sum"))


def sorted_digest(df: DataFrame, group: str, key: str) -> DataFrame:
    """SHA-256 of the sorted ids of each group, joined by line breaks; groups bounded by the caller."""
    ids = F.array_join(F.array_sort(F.collect_list(F.col(key).cast("string"))), "\n")
    return df.groupBy(group).agg(F.sha2(ids, 256).alias("digest"))


def prefix_inventory(df: DataFrame, path: Column, size: Column, size_name: str = "bytes") -> DataFrame:
    """Objects and bytes by the first and by the first two segments of a path."""
    parts = F.split(path, "/")
    one = df.select(F.get(parts, F.lit(0)).alias("p1"), F.get(parts, F.lit(1)).alias("p2"), size.alias("__s"))
    out = one.groupingSets([["p1"], ["p1", "p2"]], "p1", "p2").agg(
        F.count("*").alias("objects"), F.sum("__s").alias(size_name), F.grouping("p2").alias("level")
    )
    return out.select("p1", "p2", "objects", size_name, (2 - F.col("level")).cast("int").alias("level"))


def overlap_histogram(df: DataFrame, item: str, holder: str) -> DataFrame:
    """How many items have one, two, ... holders."""
    return df.groupBy(item).agg(F.count_distinct(holder).alias("holders")).groupBy("holders").agg(F.count("*").alias("items"))
