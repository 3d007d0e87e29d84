"""Row counts before and after a load, and the verdicts on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_LOSS_PCT = 5.0


def row_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: ``source_rows`` and ``target_rows``.

    Each side is reduced to a number per task, so nothing but counts is shuffled.
    """
    sides = source.select(F.lit(True).alias("from_source")).unionAll(
        target.select(F.lit(False).alias("from_source"))
    )
    return sides.agg(
        F.count_if("from_source").alias("source_rows"),
        F.count_if(~F.col("from_source")).alias("target_rows"),
    )


def loss_percent(source_rows: Column, target_rows: Column) -> Column:
    """Rows lost by replacing the target with the source; negative when it grows."""
    return (target_rows - source_rows) / F.greatest(target_rows, F.lit(1)) * 100


def row_loss_guard(counts: DataFrame, max_loss_pct: float = MAX_LOSS_PCT) -> DataFrame:
    """Adds ``loss_pct`` and ``abort`` (strictly more than the limit is lost)."""
    loss = loss_percent(F.col("source_rows"), F.col("target_rows"))
    return counts.withColumn("loss_pct", loss).withColumn(
        "abort", F.col("loss_pct") > max_loss_pct
    )


def key_profile(source: DataFrame, key: str) -> DataFrame:
    """One row about the merge key, from the key column alone.

    ``source_rows``; ``distinct_keys`` (without null); ``null_keys``; ``max_copies`` of any one key.  Copies are counted per task before the shuffle, so a key
    that fills a large part of the source costs no more than any other.
    """
    per_key = source.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
    known = F.col(key).isNotNull()
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("source_rows"),
        F.count(key).alias("distinct_keys"),
        F.coalesce(F.sum(F.when(~known, F.col("copies"))), F.lit(0)).alias("null_keys"),
        F.coalesce(F.max(F.when(known, F.col("copies"))), F.lit(0)).alias("max_copies"),
    )


def post_load_check(checked: DataFrame) -> DataFrame:
    """Adds ``passed``: at least ``required_rows`` are in the target (``rows_after``)."""
    return checked.withColumn("passed", F.col("rows_after") >= F.col("required_rows"))
