"""The corpus pipeline: stages over the documents table, each written as Parquet and read again."""

from __future__ import annotations

import pathlib
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from flowledger.llm import byte_bpe, mixing, quality_rules as rules, simhash, suffix_dedup  # noqa: E402
from flowledger.llm.common import table, unwrapped, wrapped  # noqa: E402
from flowledger.operators.numbering import stage  # noqa: E402


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged = rules.quality_rules(wrapped(docs, "doc_id", "text"), table(spark, sf_dir, "labels"))
    return unwrapped(judged.where("kept").select("row"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return simhash.near_dedup(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings that also start earlier."""
    return suffix_dedup.without_repeats(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight takes them."""
    return mixing.emit(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the token ids of their texts."""
    return byte_bpe.with_tokens(docs)


STAGES = [
    ("quality rules", quality),
    ("simhash near-dedup", near_dedup),
    ("suffix-array dedup", exact_dedup),
    ("mixing to target weights", mix),
    ("byte-level BPE", encode),
]

# Hashed n-grams cannot be written in SQL; tests compare the result with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents table; every result is written before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir))
    return docs
