"""The corpus pipeline: each stage reads what its predecessor wrote and keeps the columns of ``documents``.

The last stage returns the digests of the encoded texts.  Cases with nulls, ties, repeated rows and empty tables are
defined by the operators; the classifier drops empty texts, near-dedup keeps the least id of a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordflow.llm import bpe, mixing, perplexity, secret_scan, simhash
from recordflow.llm.common import table, written
from recordflow.llm.queries import _ranks


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return perplexity.kept_documents(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.representatives(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redacted_documents(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encoded_digests(docs, *_ranks())


STAGES = [
    ("quality classifier", quality),
    ("simhash near-dedup", near_dedup),
    ("secret scans", secrets),
    ("mixing to target weights", mix),
    ("byte-level BPE", encode),
]

#: Perplexities, fingerprints, hashed ranks and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"stage-{i}")
    return docs
