"""Entity state over generations: one batch step, a replay of all generations, and what changes mean.

An entity is NEW when first seen, REOPENED when it was closed and is open again, MATERIALLY_CHANGED when compared fields
differ, and else SEEN.  Fields that come from the detail are compared and stored only while the detail is
resolved; the last resolved value stays otherwise, so that a lost detail is no change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

EMPTY_STATE = (
    "id long, first_generation date, last_generation date, times_seen long, lifecycle string, resolved boolean,"
    " value double, detail string, event string, reasons array<string>"
)


def changed(old: Column, new: Column) -> Column:
    """Both missing is no change."""
    return ~F.coalesce(old.cast("string"), F.lit("")).eqNullSafe(F.coalesce(new.cast("string"), F.lit("")))


def reasons(pairs: dict[str, tuple[Column, Column]]) -> Column:
    """Names of the pairs (old, new) that differ."""
    return F.array_compact(F.array(*[F.when(changed(a, b), F.lit(n)) for n, (a, b) in pairs.items()]))


def event(known: Column, was: Column, now: Column, why: Column) -> Column:
    return (
        F.when(~known, "NEW")
        .when((was == "CLOSED") & (now == "OPEN"), "REOPENED")
        .when(F.size(why) > 0, "MATERIALLY_CHANGED")
        .otherwise("SEEN")
    )


def reopened(event_: Column, why: Column) -> Column:
    """The reasons, with the lifecycle first where an entity is open again."""
    return F.when(event_ == "REOPENED", F.concat(F.array(F.lit("lifecycle")), why)).otherwise(why)


def quality_event(was: Column, now: Column) -> Column:
    return F.when(~was & now, "DETAIL_RESOLVED").when(was & ~now, "DETAIL_UNRESOLVED")


def step(state: DataFrame, batch: DataFrame) -> DataFrame:
    """The state after one generation.

    ``batch`` holds one row an id: id, generation, lifecycle, resolved, value, detail.  Entities that are not in the
    batch stay as they are.  The larger side of the full join is the state; both are dealt by id once.
    """
    s = state.select(*[F.col(c).alias(f"s_{c}") for c in state.columns])
    met = batch.join(s, F.col("id") == F.col("s_id"), "full")
    here, known = F.col("id").isNotNull(), F.col("s_id").isNotNull()
    value = F.when(F.col("resolved"), F.col("value")).when(known, F.col("s_value")).otherwise(F.col("value"))
    why = F.when(
        known & here,
        F.array_compact(
            F.array(
                F.when(F.col("resolved") & changed(F.col("s_value"), F.col("value")), "value"),
                F.when(F.col("resolved") & F.col("s_detail").isNotNull() & changed(F.col("s_detail"), F.col("detail")), "detail"),
            )
        ),
    ).otherwise(F.array().cast("array<string>"))
    e = event(known, F.col("s_lifecycle"), F.col("lifecycle"), why)
    pick = lambda now, old: F.when(here, now).otherwise(F.col(f"s_{old}"))
    return met.select(
        F.coalesce("id", "s_id").alias("id"),
        F.coalesce("s_first_generation", "generation").alias("first_generation"),
        pick(F.col("generation"), "last_generation").alias("last_generation"),
        (F.coalesce("s_times_seen", F.lit(0).cast("long")) + here.cast("long")).alias("times_seen"),
        pick(F.col("lifecycle"), "lifecycle").alias("lifecycle"),
        pick(F.col("resolved"), "resolved").alias("resolved"),
        pick(value, "value").alias("value"),
        F.when(here & F.col("resolved"), F.col("detail")).otherwise(F.col("s_detail")).alias("detail"),
        pick(e, "event").alias("event"),
        pick(reopened(e, why), "reasons").alias("reasons"),
    )


def replay(batches: DataFrame) -> DataFrame:
    """All steps at once, for stable ids: one row an id and generation, with event, reasons and stored value.

    The stored value is the last resolved one so far, or else the first one; what it is compared with is the value
    stored before.
    """
    order = W.partitionBy("id").orderBy("generation")
    upto = order.rowsBetween(W.unboundedPreceding, 0)
    any_yet = F.max("resolved").over(upto)
    last = F.last(F.when(F.col("resolved"), F.struct("value")), True).over(upto).getField("value")
    run = batches.withColumn("stored", F.when(any_yet, last).otherwise(F.first("value").over(upto)))
    run = run.withColumn("stored_detail", F.last(F.when(F.col("resolved"), F.col("detail")), True).over(upto))
    run = run.withColumns(
        {
            "was": F.lag("lifecycle").over(order),
            "old": F.lag("stored").over(order),
            "old_detail": F.lag("stored_detail").over(order),
            "was_resolved": F.lag("resolved").over(order),
            "times_seen": F.row_number().over(order).cast("long"),
        }
    )
    known = F.col("times_seen") > 1
    why = F.when(
        known,
        F.array_compact(
            F.array(
                F.when(F.col("resolved") & changed(F.col("old"), F.col("stored")), "value"),
                F.when(F.col("resolved") & F.col("old_detail").isNotNull() & changed(F.col("old_detail"), F.col("detail")), "detail"),
            )
        ),
    ).otherwise(F.array().cast("array<string>"))
    run = run.withColumn("reasons", why)
    e = event(known, F.col("was"), F.col("lifecycle"), F.col("reasons"))
    return run.select(
        "id",
        "generation",
        "times_seen",
        "lifecycle",
        F.col("stored").alias("value"),
        "detail",
        e.alias("event"),
        quality_event(F.col("was_resolved"), F.col("resolved")).alias("quality_event"),
        reopened(e, F.col("reasons")).alias("reasons"),
    )


def baseline(events: DataFrame, first: Column) -> DataFrame:
    """Reports the NEW events of the first generation as what was there before."""
    return events.withColumn("event", F.when((F.col("event") == "NEW") & first, "BASELINE_EXISTING").otherwise(F.col("event")))


def anomalies(log: DataFrame) -> DataFrame:
    """(user_id, code, n) from an event log: orphan ends, open starts, errors without a start."""
    from .sampling import balance

    step_ = F.when(F.col("event_type") == "signup", 1).when(F.col("event_type") == "purchase", -1).otherwise(0)
    b = balance(log, "user_id", ["ts", "event_id"], step_)
    errors = log.where("event_type = 'error'").groupBy("user_id").agg(F.count("*").alias("n"))
    return (
        b.where("orphan_done > 0").select("user_id", F.lit("ORPHAN_DONE").alias("code"), F.col("orphan_done").alias("n"))
        .unionByName(b.where("incomplete > 0").select("user_id", F.lit("INCOMPLETE_START").alias("code"), F.col("incomplete").alias("n")))
        .unionByName(errors.select("user_id", F.lit("SOURCE_ERROR").alias("code"), "n"))
    )
