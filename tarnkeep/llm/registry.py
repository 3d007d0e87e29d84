"""The queries of this subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from tarnkeep.llm import (
    attention,
    burst_trie,
    circulant,
    hash_tree,
    line_spread,
    periodic,
    raking,
    relative_lz,
    repeats,
    secrets,
    vamana,
    winnowing,
)
from tarnkeep.llm.tables import table
from tarnkeep.session import apply_settings


def op1_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark = apply_settings(spark)
    documents, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return winnowing.op1(documents, items)


def op2_raking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raking.op2(table(apply_settings(spark), sf_dir, "documents"))


def op3_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_spread.op3(table(apply_settings(spark), sf_dir, "documents"))


def op4_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark = apply_settings(spark)
    return attention.op4(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_bpe_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Only this query needs a tokenizer's library and file.
    import public_tokenizers

    from tarnkeep.llm import bpe_counts

    documents = table(apply_settings(spark), sf_dir, "documents")
    return bpe_counts.token_counts(documents, public_tokenizers.path("byte_bpe_50k.json"))


def op6_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_tree.op6(table(apply_settings(spark), sf_dir, "documents"))


def op7_vamana(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vamana.op7(table(apply_settings(spark), sf_dir, "embeddings"))


def op8_suffix_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.op8(table(apply_settings(spark), sf_dir, "documents"))


def op9_circulant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return circulant.op9(table(apply_settings(spark), sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.op10(table(apply_settings(spark), sf_dir, "documents"))


def op11_burst_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return burst_trie.op11(table(apply_settings(spark), sf_dir, "conversations"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.op12(table(apply_settings(spark), sf_dir, "documents"))


def op13_relative_lz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relative_lz.op13(table(apply_settings(spark), sf_dir, "documents"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_winnowing": op1_winnowing,
    "op2_raking": op2_raking,
    "op3_line_spread": op3_line_spread,
    "op4_attention": op4_attention,
    "op5_bpe_counts": op5_bpe_counts,
    "op6_hash_tree": op6_hash_tree,
    "op7_vamana": op7_vamana,
    "op8_suffix_groups": op8_suffix_groups,
    "op9_circulant": op9_circulant,
    "op10_secrets": op10_secrets,
    "op11_burst_trie": op11_burst_trie,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_relative_lz": op13_relative_lz,
    "pipeline": corpus_pipeline.run,
}

LLM_ORACLES: dict[str, str] = {
    "op2_raking": raking.OP2_SQL,
    "op3_line_spread": line_spread.OP3_SQL,
}

if corpus_pipeline.ORACLE_SQL:
    LLM_ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
