"""The ten operators as queries over whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat_format, media, mixing, perplexity, pii, quality_rules, repeats, secret_scan, simhash
from .common import table
from .oracles import ORACLES

#: Where the public rank file and its split pattern come from; a deployment may point these elsewhere.
RANKS = "byte_bpe_50k.tiktoken"


def _ranks() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(RANKS), public_tokenizers.PATTERN


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op3_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.text_media(table(spark, sf_dir, "documents"))


def op4_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded_digests(table(spark, sf_dir, "documents"), *_ranks())


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_sizes(table(spark, sf_dir, "documents"))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.with_passages(table(spark, sf_dir, "documents"))
    return found.withColumn("has_repeats", F.col("n_removed") > 0)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"))


#: The text of both turns of conversation -1.
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    types = {f.name: f.dataType for f in turns.schema}
    added = spark.range(0, 2, 1, 1).select(
        F.lit(-1).cast(types["conv_id"]).alias("conv_id"),
        F.col("id").cast(types["turn"]).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    parts = chat_format.formatted(turns.unionByName(added))
    return chat_format.example_digests(chat_format.examples(parts, ordered=True))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_simhash": op2_simhash,
    "op3_media_columns": op3_media_columns,
    "op4_perplexity": op4_perplexity,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_mixing": op6_mixing,
    "op7_repeats": op7_repeats,
    "op8_secret_scan": op8_secret_scan,
    "op9_chat_format": op9_chat_format,
    "op10_pii": op10_pii,
}

__all__ = ["ORACLES", "QUERIES"]
