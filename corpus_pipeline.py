"""From raw documents to a sharded training corpus.

Quality classifier, near-dedup, benchmark decontamination, mixing to target weights, sharding.
Every stage works on all that the one before it kept; the result of each is written as Parquet to the
folder named by ``spark.checkpoint.dir`` and read again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tarnkeep.llm import attention, circulant, hash_tree, raking, winnowing
from tarnkeep.llm.tables import table, written
from tarnkeep.session import apply_settings

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the attention classifier does not reject; it learns from ``labels``."""
    return attention.accepted(docs, table(apply_settings(spark), sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, a similarity of 0.8)."""
    apply_settings(spark)
    return circulant.deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``."""
    return winnowing.decontaminated(docs, table(apply_settings(spark), sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose sources, languages and topics have their target weights."""
    apply_settings(spark)
    return raking.sampled(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All remaining documents with their region, rack, shard and slot."""
    apply_settings(spark)
    return hash_tree.sharded(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shard", shard),
]

#: A learned classifier has no SQL form; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
