"""The driver's tables as operator inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


COUNTRY = {"en": "GB", "de": "DE", "fr": "FR", "es": "ES"}


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as observations: source key and id, order, title, country, body and its status."""
    d = table(spark, sf_dir, "documents")
    title = F.trim(F.regexp_extract("text", r"^([^.\n]*)", 1))
    country = F.coalesce(*[F.when(F.col("lang") == k, v) for k, v in COUNTRY.items()])
    return d.select(
        F.col("source").alias("source_key"),
        F.col("doc_id").alias("source_job_id"),
        F.col("doc_id").alias("obs_ord"),
        title.alias("title"),
        country.alias("country"),
        F.col("text").alias("body"),
        F.when(F.col("n_chars") >= 200, "FULL").when(F.col("n_chars") > 0, "PARTIAL").otherwise("UNAVAILABLE").alias("detail_status"),
    )


#: The same view for DuckDB.
OBS_SQL = """obs AS (SELECT source AS source_key, doc_id AS source_job_id, doc_id AS obs_ord,
  trim(regexp_extract(text, '^([^.\\n]*)', 1)) AS title,
  CASE lang WHEN 'en' THEN 'GB' WHEN 'de' THEN 'DE' WHEN 'fr' THEN 'FR' WHEN 'es' THEN 'ES' END AS country,
  text AS body,
  CASE WHEN n_chars >= 200 THEN 'FULL' WHEN n_chars > 0 THEN 'PARTIAL' ELSE 'UNAVAILABLE' END AS detail_status
  FROM documents)"""
