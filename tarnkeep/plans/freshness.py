"""Freshness run: choose warehouses, date their tables, roll up, log."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnkeep.functions.ages import ntz
from tarnkeep.functions.names import WAREHOUSE_NAME, WAREHOUSE_TYPE
from tarnkeep.operators.freshness import (
    DEFAULT_THRESHOLD_HOURS,
    advance_latest,
    freshness_detail,
    freshness_summary,
    latest_log_file,
    table_ages,
)
from tarnkeep.operators.inventory import select_targets, select_workspaces
from tarnkeep.sinks.targets import PathTarget, TableTarget
from tarnkeep.sources.folders import list_log_files, list_tables
from tarnkeep.sources.store_listing import store_log_files, store_tables
from tarnkeep.storage import kept


def warehouse_targets(
    workspaces: DataFrame, items: DataFrame, domains: Sequence[str], suffix: str
) -> DataFrame:
    """Warehouses of the selected workspaces."""
    chosen = select_workspaces(workspaces, domains, suffix)
    return select_targets(chosen, items, WAREHOUSE_TYPE, WAREHOUSE_NAME)


def freshness(
    targets: DataFrame,
    tables: DataFrame,
    files: DataFrame,
    now: datetime | str | Column | None = None,
    threshold_hours: float = DEFAULT_THRESHOLD_HOURS,
    keys: Sequence[str] = ("item_id", "table_path"),
    keep: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Detail and summary rows of one run at the UTC time ``now`` (by default right now).

    ``tables`` and ``files`` may cover more items than the targets; what belongs to other items is
    left out before anything is dated.  With ``keep`` the table
    ages are computed once, in the shared folder, and both results read them from there; set
    it when both will be used.
    """
    run_ts = ntz(now)
    wanted = targets.select("item_id").distinct()
    tables = tables.join(wanted, "item_id", "left_semi")
    if "item_id" in keys:
        files = files.join(wanted, "item_id", "left_semi")
    ages = table_ages(tables, files, run_ts, keys, threshold_hours)
    if keep:
        ages, _ = kept(ages, "table-ages")
    return (
        freshness_detail(targets, ages, run_ts, threshold_hours),
        freshness_summary(targets, ages, run_ts, threshold_hours),
    )


def freshness_on_mount(
    targets: DataFrame,
    root: str,
    now: datetime | str | Column | None = None,
    threshold_hours: float = DEFAULT_THRESHOLD_HOURS,
    tasks: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The same for table folders under ``<root>/<item id>``, listed by the executors.

    Only the targets' folders are listed, each of them once.
    """
    roots = targets.select(
        "item_id", F.concat(F.lit(f"{root.rstrip('/')}/"), F.col("item_id")).alias("item_root")
    )
    tables, _ = kept(list_tables(roots, tasks), "tables")
    files = list_log_files(tables, tasks)
    return freshness(targets, tables, files, now, threshold_hours, keep=True)


def freshness_incremental(
    targets: DataFrame,
    tables: DataFrame,
    new_files: DataFrame,
    state: PathTarget | TableTarget,
    now: datetime | str | Column | None = None,
    threshold_hours: float = DEFAULT_THRESHOLD_HOURS,
    keys: Sequence[str] = ("item_id", "table_path"),
) -> tuple[DataFrame, DataFrame]:
    """Detail and summary rows of a run that only sees files it has not seen before.

    ``state`` holds the newest file of each table of the ``keys``; it is brought up to date first, by replacing it as a
    whole, so a run that is cut off can be repeated with the same files.  ``new_files`` may hold files of
    earlier runs again, and must hold all that came since the last one (see :func:`seen_until`).  Log files
    must not be changed or removed: the newest file of a table is known from the state alone.
    """
    spark = targets.sparkSession
    state.recover(spark)
    before = state.read(spark)
    if before is None:
        before = latest_log_file(new_files.limit(0), keys).select(*keys, "latest_file", "latest_ts")
    staged, _ = state.stage(advance_latest(before, new_files, keys))
    state.publish(spark, staged)
    newest = state.read(spark).select(
        *keys, F.col("latest_file").alias("file_name"), F.col("latest_ts").alias("modified")
    )
    if "error" in new_files.columns:
        failed = new_files.filter("error IS NOT NULL").select(*keys, "error")
        newest = newest.unionByName(failed, allowMissingColumns=True)
    return freshness(targets, tables, newest, now, threshold_hours, keys)


def seen_until(state: PathTarget | TableTarget, spark: SparkSession) -> datetime | None:
    """The newest time in ``state``: stores date files by their own clock, so a file of an earlier date can
    only still come from a writer that was not done when the last run listed.  Ask for files from some time
    before it; files that are seen twice change nothing."""
    held = state.read(spark)
    return None if held is None else held.agg(F.max("latest_ts")).first()[0]


def freshness_on_store(
    targets: DataFrame,
    root: str,
    now: datetime | str | Column | None = None,
    threshold_hours: float = DEFAULT_THRESHOLD_HOURS,
) -> tuple[DataFrame, DataFrame]:
    """As :func:`freshness_on_mount`, for any store that Arrow opens, without a mount.

    The item ids of the targets, one per warehouse, are what the driver needs to plan the listing.
    """
    spark = targets.sparkSession
    items = [str(row.item_id) for row in targets.select("item_id").distinct().collect()]
    tables, _ = kept(store_tables(spark, root, items), "tables")
    return freshness(targets, tables, store_log_files(spark, root, items), now, threshold_hours, keep=True)


def log_freshness(
    detail: DataFrame, summary: DataFrame, append: Callable[[DataFrame, str], None]
) -> None:
    """Hand both results to ``append(rows, log_name)``, one bulk append each."""
    append(detail, "detail")
    append(summary, "summary")
