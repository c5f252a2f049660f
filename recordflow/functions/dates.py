"""Dates from display text, as the source's calendar day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Day-first formats, tried in order.
FORMATS = ("d MMMM yyyy", "d MMM yyyy", "MMMM d yyyy", "MMM d yyyy", "d/M/yyyy", "d.M.yyyy", "d-M-yyyy", "yyyy/M/d")


def day_iso(text: Column, seen: Column) -> Column:
    """ISO day of a display date, or null; relative words count from the day of ``seen``."""
    bare = F.regexp_replace(F.trim(text), r"(?i)^(?:posted|published|closing date|deadline|closes)(?: on)?:?\s*", "")
    low = F.lower(bare)
    plain = F.regexp_replace(F.regexp_replace(bare, r"(\d)(?:st|nd|rd|th)\b", "$1"), r",", "")
    ago = F.regexp_extract(low, r"^(\d{1,4})\+? days? ago$", 1).try_cast("int")
    day = F.to_date(seen)
    parsed = F.coalesce(*[F.to_date(F.try_to_timestamp(plain, F.lit(f))) for f in FORMATS])
    iso = F.regexp_extract(bare, r"^(\d{4}-\d{2}-\d{2})", 1).try_cast("date")
    found = (
        F.when(low == "today", day)
        .when(low == "yesterday", F.date_sub(day, 1))
        .when(ago.isNotNull(), F.date_sub(day, ago))
        .otherwise(F.coalesce(iso, parsed))
    )
    return F.date_format(found, "yyyy-MM-dd")


def instant(text: Column) -> Column:
    """ISO time to a UTC timestamp; a missing zone is UTC."""
    return F.try_to_timestamp(F.regexp_replace(F.trim(text), "[zZ]$", "+00:00"))


def deadline_label(deadline: Column, today: Column) -> Column:
    """How a deadline is shown: past, today, this week, later or none."""
    days = F.datediff(deadline, today)
    return (
        F.when(deadline.isNull(), "none")
        .when(days < 0, "past")
        .when(days == 0, "today")
        .when(days <= 7, "week")
        .otherwise("later")
    )
