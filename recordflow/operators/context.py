"""Cleaning of long contexts: lines, repeated blocks, sections, and cuts that keep every section."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recordflow.functions.text import squeeze


def cleaned(text: Column, least: int = 24) -> Column:
    """Squeezed non-empty lines; a long line that was there before is dropped."""
    lines = F.filter(F.transform(F.split(text, "\n"), squeeze), lambda x: x != "")
    # short lines are made distinct by their place, so that array_distinct keeps them all
    marked = F.transform(lines, lambda x, i: F.struct(x.alias("x"), F.when(F.length(x) < least, i).alias("i")))
    return F.array_join(F.transform(F.array_distinct(marked), lambda m: m["x"]), "\n")


def sections(docs: DataFrame, key: str, text: str, longest_heading: int) -> DataFrame:
    """One row a line: key, pos, line, whether it is a heading, and the section it stands in."""
    lines = docs.select(key, F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    head = F.when(F.length("line").between(1, longest_heading), F.col("line"))
    within = W.partitionBy(key).orderBy("pos")
    return lines.withColumn("head", head).withColumn("section", F.coalesce(F.last("head", True).over(within), F.lit("")))


def section_sizes(docs: DataFrame, key: str, text: str, longest_heading: int) -> DataFrame:
    body = F.col("head").isNull() & (F.col("line") != "")
    return sections(docs, key, text, longest_heading).groupBy(key, "section").agg(F.count_if(body).alias("n_lines"))


def truncated(docs: DataFrame, key: str, text: str, longest_heading: int, most: int) -> DataFrame:
    """Texts of at most ``most`` characters a section, with the head and the tail of each section kept."""
    lines = sections(docs, key, text, longest_heading)
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n")
    parts = lines.groupBy(key, "section").agg(F.min("pos").alias("pos"), body.alias("body"))
    half = most // 2
    short = F.when(F.length("body") <= most, F.col("body")).otherwise(
        F.concat(F.substring("body", 1, half), F.lit("\n...\n"), F.right("body", F.lit(half)))
    )
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", short.alias("t")))), lambda x: x["t"]), "\n")
    return parts.groupBy(key).agg(whole.alias("body"))
