"""Decisions while listings are collected: whose country holds, which pages are new, which attempt counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def country(listed: Column, detail: Column, untrusted: Column, by_card: Column, targets: list[str]) -> Column:
    """Struct (country, validation); null where the record does not belong to any target.

    The detail page decides when it names a country.  Without it the listing's country holds, unless its partition
    is not trusted.
    """
    asked = F.coalesce(listed, F.when(detail.isin(targets), detail))
    validation = (
        F.when(detail.isNotNull() & (detail != asked), "DETAIL_MISMATCH")
        .when(detail.isNotNull(), "DETAIL_MATCH")
        .when(F.coalesce(untrusted, F.lit(False)), "UNTRUSTED_IDENTICAL_RESULT_SET")
        .when(by_card, "LISTING_CARD_VALIDATED")
        .otherwise("FILTER_URL_VALIDATED")
    )
    held = F.when(detail.isNotNull(), detail).when(~F.coalesce(untrusted, F.lit(False)), asked)
    return F.when(asked.isNotNull(), F.struct(held.alias("country"), validation.alias("validation")))


def page_kinds(rows: DataFrame, listing: str, page: str, item: str) -> DataFrame:
    """One row a page: how many of its items are new, and FIRST, NEW, RESET (the first page again, from the third on) or REPEATED.

    Sets of items are never gathered: a page equals the first one when all its items were first seen there and
    it has as many.
    """
    each = rows.select(F.col(listing).alias("listing"), F.col(page).alias("page"), F.col(item).alias("item")).distinct()
    each = each.withColumn("seen", F.min("page").over(W.partitionBy("listing", "item")))
    pages = each.groupBy("listing", "page").agg(
        F.count("*").alias("items"),
        F.count_if(F.col("seen") == F.col("page")).alias("new_items"),
        F.min("seen").alias("low"),
        F.max("seen").alias("high"),
    )
    within = W.partitionBy("listing").orderBy("page")
    pages = pages.withColumn("place", F.row_number().over(within)).withColumn(
        "start", F.first(F.struct("page", "items")).over(within)
    )
    same = (F.col("low") == F.col("start.page")) & (F.col("high") == F.col("start.page")) & (F.col("items") == F.col("start.items"))
    kind = (
        F.when(F.col("place") == 1, "FIRST")
        .when(F.col("new_items") > 0, "NEW")
        .when((F.col("place") >= 3) & same, "RESET")
        .otherwise("REPEATED")
    )
    return pages.select("listing", "page", "items", "new_items", kind.alias("kind"))


def across_listings(rows: DataFrame, tenant: str, item: str, order: list[str], payload: list[str]) -> DataFrame:
    """One row an item of a tenant, from the first listing that has it."""
    first = F.min(F.struct(*order, *[c for c in payload if c not in order])).alias("x")
    return rows.groupBy(tenant, item).agg(first).select(tenant, item, *[F.col(f"x.{c}") for c in payload])


def table_rows(html: Column, least: int) -> Column:
    """Cells of all table rows with ``least`` data cells or more; header rows have none."""
    cells = lambda r: F.transform(
        F.regexp_extract_all(r, F.lit(r"(?is)<td\b[^>]*>(.*?)</td>"), F.lit(1)),
        lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, r"(?s)<[^>]*>", " "), r"\s+", " ")),
    )
    found = F.transform(F.regexp_extract_all(html, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1)), cells)
    return F.filter(found, lambda r: F.size(r) >= least)


def settled_attempts(tries: DataFrame, item: str, foreign: Column, order: str, outcome: Column) -> DataFrame:
    """One row an item: the outcome of the first attempt that succeeds, same-site attempts first, else of the last one.

    BLOCKED and FETCH_FAILED are failures, any other outcome is a success.
    """
    each = tries.select(F.col(item).alias("item"), F.struct(foreign.alias("foreign"), F.col(order).alias("place"), outcome.alias("outcome")).alias("x"))
    good = ~F.col("x.outcome").isin("BLOCKED", "FETCH_FAILED")
    met = each.groupBy("item").agg(F.min(F.when(good, F.col("x"))).alias("good"), F.max("x").alias("last"), F.count("*").alias("tries"))
    return met.select(F.col("item").alias(item), F.coalesce("good.outcome", "last.outcome").alias("outcome"), "tries")


def aliases(canonical: Column, source: Column, source_id: Column, urls: list[Column], record: Column) -> Column:
    """Distinct structs (rank, alias), strongest first; missing parts give no alias."""
    named = [
        (0, F.when(canonical != "", F.concat(F.lit("canonical:"), F.lower(canonical)))),
        (1, F.when((source != "") & (source_id != ""), F.concat(F.lit("source_id:"), source, F.lit(":"), F.lower(source_id)))),
        *[(2, F.when(u != "", F.concat(F.lit("url:"), u))) for u in urls],
        (3, F.when((source != "") & (record != ""), F.concat(F.lit("source_record:"), source, F.lit(":"), F.lower(record)))),
    ]
    ranked = [F.when(a.isNotNull(), F.struct(F.lit(r).alias("rank"), a.alias("alias"))) for r, a in named]
    return F.array_distinct(F.array_compact(F.array(*ranked)))


def counts_by(rows: DataFrame, dimensions: list[str], most: int) -> DataFrame:
    """The ``most`` frequent values of every dimension, from one pass over the rows.

    Every task keeps its own ``most`` before values of one dimension meet, so that their number does not matter.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dimensions]))
    counted = rows.select(pairs.alias("x")).select("x.*").groupBy("dimension", "value").agg(F.count("*").alias("n"))
    place = F.row_number().over(W.partitionBy("dimension").orderBy(F.desc("n"), "value"))
    return counted.withColumn("place", place).where(F.col("place") <= most)


def flattened(rows: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """One row a metric that has a value."""
    doubles = [F.col(m).cast("double").alias(m) for m in metrics]
    return rows.select(*keys, *doubles).unpivot(keys, metrics, "metric", "value").where("value IS NOT NULL")


def run_changes(rows: DataFrame, entity: str, order: list[str], field: str) -> DataFrame:
    """Every observation with the one before it of its entity: NEW, SAME or CHANGED."""
    w = W.partitionBy(entity).orderBy(*order)
    before, place = F.lag(field).over(w), F.row_number().over(w)
    kind = F.when(place == 1, "NEW").when(before.eqNullSafe(F.col(field)), "SAME").otherwise("CHANGED")
    return rows.withColumn("previous", before).withColumn("change", kind)
