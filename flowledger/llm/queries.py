"""Registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowledger.llm import (
    byte_bpe,
    chat_format,
    class_lm,
    html_template,
    merkle,
    mixing,
    quality_rules as rules,
    sharding,
    simhash,
    spelling,
    suffix_dedup,
    token_files,
    vector_topk,
)
from flowledger.llm.common import table
from flowledger.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_html_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = html_template.extract(table(spark, sf_dir, "pages"))
    return extracted.select("page_id", "url", "text", "n_chars")


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat_format.with_injection(table(spark, sf_dir, "conversations"))
    return chat_format.conversation_digests(turns)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sizes(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *rules.COUNTS, "base_failed", "score", "kept")


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = suffix_dedup.suffix_dedup(docs)
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", byte_bpe.round_trip().alias("found"))
    return docs.select(
        "doc_id",
        "found.n_tokens",
        F.lower(F.hex("found.ids")).alias("ids_sha256"),
        F.lower(F.hex("found.decoded")).alias("decoded_sha256"),
    )


def op7_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.score(table(spark, sf_dir, "documents"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs)


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_topk.top_k(table(spark, sf_dir, "embeddings"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_sizes(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.checked_proofs(table(spark, sf_dir, "documents"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write(table(spark, sf_dir, "documents"), scratch_path(spark, "token-files"))
    return token_files.digests(files)


def queries() -> dict[str, Query]:
    found = [
        op1_html_template,
        op2_chat_format,
        op3_mixing,
        op4_quality_rules,
        op5_suffix_array_dedup,
        op6_byte_bpe,
        op7_class_lm,
        op8_simhash_near_dedup,
        op9_exact_top_k,
        op10_sharding,
        op11_spelling_variants,
        op12_merkle_manifest,
        op13_token_files,
    ]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_chat_format": chat_format.ORACLE_SQL,
        "op3_mixing": mixing.ORACLE_SQL,
        "op9_exact_top_k": vector_topk.ORACLE_SQL,
        "op10_sharding": sharding.oracle_sql(),
        "op11_spelling_variants": spelling.oracle_sql(),
        "op12_merkle_manifest": merkle.oracle_sql(),
    }
