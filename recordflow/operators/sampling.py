"""Deterministic samples, first occurrences, retention and calendars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def stable_rank(seed: str, bucket: str, key: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(seed), F.lit(bucket), key.cast("string")), 256)


def round_robin(df: DataFrame, key: str, stratum: str, size: int, seed: str, bucket: str) -> DataFrame:
    """Takes turns through the strata, each in stable order, until ``size`` rows are taken.

    At most ``size`` rows of a stratum can be taken, so each partition cuts its strata before the final order.
    """
    ranked = df.withColumn("__rank", stable_rank(seed, bucket, F.col(key)))
    turn = F.row_number().over(W.partitionBy(stratum).orderBy("__rank", key))
    turns = ranked.withColumn("__turn", turn).where(F.col("__turn") <= size)
    return turns.orderBy("__turn", stable_rank(seed, bucket, F.col(stratum)), key).limit(size).drop("__rank", "__turn")


def buckets(df: DataFrame, key: str, stratum: str, positive: Column, priority: Column, size: int, seed: str) -> DataFrame:
    """(key, bucket): all positives, then priority rows, then rows of any kind; each bucket excludes the earlier ones."""
    positives = df.where(positive)
    taken = positives.select(key).withColumn("bucket", F.lit("POSITIVE"))
    rest = df.join(taken.select(key), key, "left_anti")
    first = round_robin(rest.where(priority), key, stratum, size // 2, seed, "priority")
    taken = taken.unionByName(first.select(key).withColumn("bucket", F.lit("PRIORITY")))
    rest = df.join(taken.select(key), key, "left_anti")
    blind = round_robin(rest, key, stratum, size - size // 2, seed, "blind")
    return taken.unionByName(blind.select(key).withColumn("bucket", F.lit("BLIND")))


# What counts as positive, reviewable and negative, and the buckets in their order.
POSITIVE, REVIEWABLE, NEGATIVE = ("STRONG_APPLY", "APPLY"), ("REVIEW",), ("LOW_PRIORITY", "SKIP")
BUCKETS = ("ALL_POSITIVE", "REVIEW_MORE_STRATIFIED", "E01_REVIEW_FILL", "NEGATIVE_TARGETED", "NEGATIVE_BLIND_EXPLORATION", "NEGATIVE_BACKFILL")


def shadow_sample(jobs: DataFrame, seed: str, reviews: int, negatives: int, targeted: float = 0.5) -> DataFrame:
    """(job_id, bucket): all positives, reviews, and negatives, half of them targeted; what a bucket cannot fill goes on.

    ``jobs`` has job_id, stratum (country and source, joined by a bar), recommendation, and the booleans review_more, good_detail and
    is_targeted.  Every bucket takes turns through the strata of the rows that no bucket before it has; its size is at most
    its target, so the rows that a bucket excludes are few.
    """
    left, out = jobs, jobs.where(F.col("recommendation").isin(*POSITIVE)).select("job_id", F.lit(BUCKETS[0]).alias("bucket"))
    left = left.where(~F.coalesce(F.col("recommendation").isin(*POSITIVE), F.lit(False)))

    def take(bucket: str, pool: Column, size: int) -> int:
        nonlocal left, out
        if size <= 0:
            return 0
        got = [r["job_id"] for r in round_robin(left.where(pool).select("job_id", "stratum"), "job_id", "stratum", size, seed, bucket).collect()]  # at most size
        chosen = jobs.sparkSession.createDataFrame([(x,) for x in got], jobs.select("job_id").schema)
        out = out.unionByName(chosen.withColumn("bucket", F.lit(bucket)))
        left = left.join(F.broadcast(chosen), "job_id", "left_anti")
        return len(got)

    n = take(BUCKETS[1], F.col("review_more"), reviews)
    take(BUCKETS[2], F.col("recommendation").isin(*REVIEWABLE), reviews - n)
    negative = F.col("recommendation").isin(*NEGATIVE) & F.col("good_detail")
    aim = round(negatives * targeted)  # half to even
    n = take(BUCKETS[3], negative & F.col("is_targeted"), aim)
    n += take(BUCKETS[4], negative, negatives - aim)
    take(BUCKETS[5], negative, negatives - n)
    return out


def sample_summary(sample: DataFrame, jobs: DataFrame) -> DataFrame:
    """(dimension, value, n): sampled rows by bucket and by recommendation."""
    met = sample.join(jobs.select("job_id", "recommendation"), "job_id")
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in ("bucket", "recommendation")])
    return met.select(F.explode(pairs).alias("x")).select("x.*").groupBy("dimension", "value").agg(F.count("*").alias("n"))


def first_occurrence(df: DataFrame, key: str, order: str, *columns: str) -> DataFrame:
    """The first row of each key, by a partial aggregate."""
    first = F.min_by(F.struct(order, *columns), F.col(order))
    return df.groupBy(key).agg(first.alias("__x")).select(key, *[F.col(f"__x.{c}") for c in (order, *columns)])


def audit(df: DataFrame, key: str, run: str, size: int) -> DataFrame:
    """A keyed random sample of ``size``."""
    rank = F.sha2(F.concat(F.lit(run), F.lit("\u0000"), F.col(key).cast("string")), 256)
    return df.withColumn("audit_rank", rank).orderBy("audit_rank", key).limit(size)


def retention(df: DataFrame, family: str, order: list[Column], keep: int, too_old: Column) -> DataFrame:
    """Adds ``action``: KEEP for the latest of a family and for rows of unknown age, DELETE for old ones."""
    place = F.row_number().over(W.partitionBy(family).orderBy(*order))
    action = F.when(place <= keep, "KEEP").when(F.coalesce(too_old, F.lit(False)), "DELETE").otherwise("KEEP")
    return df.withColumn("place", place).withColumn("action", action)


def latest_per_day(df: DataFrame, family: str, day: Column, order: Column, *columns: str) -> DataFrame:
    last = F.max_by(F.struct(*columns), order)
    out = df.groupBy(family, day.alias("day")).agg(last.alias("__x"))
    return out.select(family, "day", *[F.col(f"__x.{c}") for c in columns])


def missing_days(df: DataFrame, family: str, day: Column) -> DataFrame:
    """Days between the first and the last of a family that it lacks."""
    days = df.select(family, day.alias("day")).distinct()
    span = days.groupBy(family).agg(F.min("day").alias("a"), F.max("day").alias("b"))
    every = span.select(family, F.explode(F.sequence("a", "b")).alias("day"))
    return every.join(days, [family, "day"], "left_anti")


def balance(events: DataFrame, key: str, order: list[str], step: Column) -> DataFrame:
    """Per key: open starts and orphan ends of a counter that never falls below zero."""
    so_far = F.sum("__d").over(W.partitionBy(key).orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    run = events.withColumn("__d", step).withColumn("__s", so_far)
    orphans = F.greatest(F.lit(0).cast("long"), -F.min("__s"))
    return run.groupBy(key).agg(orphans.alias("orphan_done"), (F.sum("__d") + orphans).alias("incomplete"))
