"""Validation: rows that break a contract, and gates over whole relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def present(column: str) -> Column:
    return F.when(F.col(column).isNull(), f"{column}: missing")


def one_of(column: str, values: list) -> Column:
    return F.when(~F.col(column).isin(values), f"{column}: not allowed")


def within(column: str, low: float | None, high: float | None) -> Column:
    """A violation below ``low`` or above ``high``; null passes."""
    out = F.lit(None).cast("string")
    if low is not None:
        out = F.coalesce(out, F.when(F.col(column) < low, f"{column}: below {low}"))
    if high is not None:
        out = F.coalesce(out, F.when(F.col(column) > high, f"{column}: above {high}"))
    return out


def violations(df: DataFrame, key: str, contract: list[Column]) -> DataFrame:
    """(key, violation), one row each, in a single pass."""
    found = F.array_compact(F.array(*contract))
    return df.select(key, F.explode(found).alias("violation"))


def gates(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """(name, passed) of aggregate conditions, in a single pass."""
    one = df.agg(*[c.alias(n) for n, c in conditions.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("passed")) for n in conditions])
    return one.select(F.inline(rows))
