"""Newest log file per table, its age, and the health of each warehouse."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnkeep.functions.ages import (
    age_hours,
    fixed_point,
    ntz,
    round_half_even,
    without_zone,
)
from tarnkeep.functions.names import pad_to

DEFAULT_THRESHOLD_HOURS = 24.0
ERROR_LENGTH = 200

_EPOCH = "1970-01-01 00:00:00"


def latest_log_file(files: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Newest file per table; of several with the same time, the smallest name.

    ``files`` has the ``keys``, ``file_name``, ``modified`` and, optionally, ``error``.
    The smallest (time back to the epoch, name) pair is the newest file.  Each task reduces
    its rows to one pair per table before the shuffle, so a table that owns a large part of
    all files sends no more than one row per task.  The time is an aggregate of its own:
    whoever needs no names, such as the summary, then reads and sorts none.
    """
    newest = F.min(
        F.when(
            F.col("file_name").isNotNull(),
            F.struct((ntz(_EPOCH) - F.col("modified")).alias("order"), "file_name"),
        )
    )
    error = F.min("error") if "error" in files.columns else F.lit(None).cast("string")
    return without_zone(files, "modified").groupBy(*keys).agg(
        newest["file_name"].alias("latest_file"),
        F.max("modified").alias("latest_ts"),
        error.alias("error"),
    )


def advance_latest(state: DataFrame, files: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest file per table of all runs: that of ``state`` or one of the ``files`` seen since.

    ``state`` has the ``keys``, ``latest_file`` and ``latest_ts``, as this returns them.  The newest file of
    two sets of files is the newer one of their newest files, so however files are split into runs, in whatever
    order these come and even if a file is seen twice, the last state is the result over all of them.  A
    folder that could not be listed leaves the state of its table as it was.
    """
    before = state.select(*keys, F.col("latest_file").alias("file_name"), F.col("latest_ts").alias("modified"))
    seen = without_zone(files, "modified").select(*keys, "file_name", "modified")
    both = before.unionByName(seen.filter("file_name IS NOT NULL AND modified IS NOT NULL"))
    return latest_log_file(both, keys).select(*keys, "latest_file", "latest_ts")


def table_ages(
    tables: DataFrame,
    files: DataFrame,
    now: Column,
    keys: Sequence[str] = ("item_id", "table_path"),
    threshold_hours: float = DEFAULT_THRESHOLD_HOURS,
) -> DataFrame:
    """One row per inventory table with its newest log, stored age and stale flag.

    ``tables`` has ``item_id``, ``table_path`` and the ``keys`` that tie it to ``files``.  Files
    are reduced per table first, so the join meets at most one row per table on either side.
    A row of ``tables`` with an ``error`` and no path stays, as what could not be listed.
    """
    inventory = tables.filter(F.col("table_path").isNotNull()).select(
        *dict.fromkeys(["item_id", "table_path", *keys])
    )
    age = F.col("age")
    dated = (
        inventory.join(latest_log_file(files, keys), list(keys), "left")
        .withColumn("age", age_hours(F.col("latest_ts"), now))
        .select(
            "item_id",
            "table_path",
            "latest_file",
            "latest_ts",
            F.when(age != 0, age).alias("age"),
            F.when(age != 0, round_half_even(age, 2)).alias("age_hours"),
            F.coalesce(F.when(age != 0, age > threshold_hours), F.lit(False)).alias("is_stale"),
            F.substring("error", 1, ERROR_LENGTH).alias("error"),
        )
    )
    if "error" not in tables.columns:
        return dated
    failed = tables.filter(F.col("table_path").isNull() & F.col("error").isNotNull()).select(
        "item_id", F.substring("error", 1, ERROR_LENGTH).alias("error"), F.lit(False).alias("is_stale")
    )
    return dated.unionByName(failed, allowMissingColumns=True)


def freshness_detail(
    targets: DataFrame, ages: DataFrame, run_ts: Column, threshold_hours: float
) -> DataFrame:
    """Detail log rows: one per table of every target, and one without path per failed listing."""
    named = targets.select("item_id", "workspace_name", "item_name")
    return ages.join(named, "item_id").select(
        run_ts.alias("RunTs"),
        F.col("workspace_name").alias("WorkspaceName"),
        F.col("item_name").alias("WarehouseName"),
        F.col("table_path").alias("TablePath"),
        F.col("latest_file").alias("LatestLogFile"),
        F.col("latest_ts").alias("LatestLogTs"),
        F.col("age_hours").alias("AgeHours"),
        F.lit(float(threshold_hours)).alias("ThresholdHours"),
        F.col("is_stale").alias("IsStale"),
        F.col("error").alias("ErrorMessage"),
    )


def freshness_summary(
    targets: DataFrame, ages: DataFrame, run_ts: Column, threshold_hours: float
) -> DataFrame:
    """Summary log rows: one per target, also for a target without any table.

    Tables are rolled up per item before the targets join in.  An item that owns a large
    part of all tables is then a single row, and no row is joined on a hot key.
    """
    has_log = F.col("latest_ts").isNotNull()
    per_item = ages.groupBy("item_id").agg(
        F.count("table_path").alias("total"),
        F.count("latest_ts").alias("logged"),
        F.count_if(has_log & F.col("is_stale")).alias("stale"),
        F.max("latest_ts").alias("newest"),
        F.min("latest_ts").alias("oldest"),
        F.max("age_hours").alias("max_age"),
        F.min("age_hours").alias("min_age"),
    )

    def counter(name: str) -> Column:
        return F.coalesce(name, F.lit(0)).cast("int")

    named = targets.select("item_id", "workspace_name", "item_name")
    return named.join(per_item, "item_id", "left").select(
        run_ts.alias("RunTs"),
        F.col("workspace_name").alias("WorkspaceName"),
        F.col("item_name").alias("WarehouseName"),
        counter("total").alias("TotalTables"),
        counter("logged").alias("TablesWithDeltaLog"),
        counter("stale").alias("StaleTables"),
        F.col("newest").alias("LatestDeltaLogTs"),
        F.col("oldest").alias("OldestDeltaLogTs"),
        F.nullif("max_age", F.lit(0.0)).alias("MaxAgeHours"),
        F.nullif("min_age", F.lit(0.0)).alias("MinAgeHours"),
        F.lit(float(threshold_hours)).alias("ThresholdHours"),
        F.when(F.col("logged") > 0, F.col("stale") == F.col("logged")).alias(
            "IsPublishingBroken"
        ),
    )


def table_lines(ages: DataFrame) -> DataFrame:
    """Readable line per table: mark, path, and the age, the error or ``no log``."""
    state = F.coalesce(
        F.concat(fixed_point(F.col("age"), 1), F.lit("h")), "error", F.lit("no log")
    )
    line = F.concat(
        F.when(F.col("is_stale"), "🔴").otherwise("🟢"),
        F.lit("  "),
        pad_to(F.coalesce("table_path", F.lit("(not listed)")), 60),
        F.lit("  "),
        state,
    )
    return ages.select("item_id", "table_path", line.alias("line"))


def warehouse_lines(summary: DataFrame) -> DataFrame:
    """Readable line per warehouse: verdict, stale of logged tables, greatest age."""
    broken = F.coalesce("IsPublishingBroken", F.lit(False))
    line = F.concat(
        F.when(broken, "🔴 PUBLISHING BROKEN").otherwise("🟢 healthy"),
        F.lit(" — "),
        F.col("StaleTables").cast("string"),
        F.lit("/"),
        F.col("TablesWithDeltaLog").cast("string"),
        F.lit(" stale  max age "),
        F.coalesce(F.col("MaxAgeHours").cast("string"), F.lit("None")),
        F.lit("h"),
    )
    return summary.select("WorkspaceName", "WarehouseName", line.alias("line"))

