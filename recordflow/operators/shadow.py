"""Comparison of a second opinion with the decision of record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Highest confidence by quality of the evidence.
CAPS = {"FULL": 100, "PARTIAL": 80, "TITLE": 55, "NONE": 30}


def rank(value: Column, ranks: dict[str, int]) -> Column:
    out = F.lit(None).cast("int")
    for k, v in ranks.items():
        out = F.when(value == k, v).otherwise(out)
    return out


def rank_distance(ours: Column, theirs: Column, ranks: dict[str, int]) -> Column:
    return rank(theirs, ranks) - rank(ours, ranks)


def direction(distance: Column) -> Column:
    return F.when(distance == 0, "SAME").when(distance > 0, "UP").otherwise("DOWN")


def tags(distance: Column) -> Column:
    return F.array_compact(F.array(F.when(distance != 0, "DISAGREE"), F.when(F.abs(distance) >= 2, "MAJOR")))


def agreement(distance: Column) -> Column:
    return F.when(F.abs(distance) >= 2, "MAJOR").when(distance != 0, "MINOR").otherwise("AGREE")


def capped(confidence: Column, quality: Column) -> Column:
    out = F.lit(CAPS["NONE"])
    for k, v in CAPS.items():
        out = F.when(quality == k, v).otherwise(out)
    return F.least(confidence, out)
