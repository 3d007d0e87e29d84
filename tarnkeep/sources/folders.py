"""Listing table folders and log files on a mounted path, spread over the executors.

Spark's own file index lists on the driver, keeps every entry there and hides names that
start with ``_`` or ``.`` as well as empty files.  Here each task scans the folders of its
own rows and streams the entries out, so neither the driver nor one task ever holds a whole
listing.  The path must be mounted on every executor.  For other storage see
:mod:`tarnkeep.sources.store_listing`.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarnkeep.sources.tables import TABLE_ROOT

LOG_FOLDER = "_delta_log"

_ENTRY_FIELDS = (
    StructType()
    .add("name", "string")
    .add("is_directory", "boolean")
    .add("modified", "timestamp_ntz")
    .add("error", "string")
)
_ENTRY_TYPES = [pa.string(), pa.bool_(), pa.timestamp("us"), pa.string()]
_ROWS_PER_BATCH = 10_000


def _scanner(
    missing_is_error: bool = False,
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The task body.  Nested functions travel with the plan, so that executors need not have
    this package installed."""

    def entries(folder: str | None) -> Iterator[tuple]:
        """(name, is directory, microseconds, error) per entry.

        A null folder gives one empty entry, so that its row is carried along.  An entry that is
        gone before it is looked at is left out, and only that one.
        """
        if folder is None:
            yield None, None, None, None
            return
        try:
            found = os.scandir(folder.removeprefix("file://").removeprefix("file:"))
        except FileNotFoundError as error:
            if missing_is_error:
                yield None, None, None, str(error)
            return
        except OSError as error:
            yield None, None, None, str(error)
            return
        with found:
            while True:
                try:
                    entry = next(found, None)
                    if entry is None:
                        return
                except OSError as error:
                    yield None, None, None, str(error)
                    return
                try:
                    modified = entry.stat().st_mtime_ns // 1000
                    yield entry.name, entry.is_dir(), modified, None
                except FileNotFoundError:
                    continue
                except OSError as error:
                    yield None, None, None, str(error)

    def rows(batch: pa.RecordBatch, position: list, found: list) -> pa.RecordBatch:
        given = batch.take(pa.array(position, pa.int64())).columns
        added = [pa.array(values, kind) for values, kind in zip(zip(*found), _ENTRY_TYPES)]
        names = batch.schema.names + _ENTRY_FIELDS.names
        return pa.RecordBatch.from_arrays([*given, *added], names=names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            position, found = [], []
            for row, folder in enumerate(batch.column("folder").to_pylist()):
                for entry in entries(folder):
                    position.append(row)
                    found.append(entry)
                    if len(found) == _ROWS_PER_BATCH:
                        yield rows(batch, position, found)
                        position, found = [], []
            if found:
                yield rows(batch, position, found)

    return scan


def list_entries(
    folders: DataFrame, tasks: int | None = None, missing_is_error: bool = False
) -> DataFrame:
    """Direct entries of every ``folder``; the other columns of the row are carried along.

    The rows are spread over a fixed number of tasks (``spark.sql.shuffle.partitions`` by
    default): they are few bytes but much waiting, so they must not be merged by size.
    A folder that cannot be read gives one row with ``error`` set and no name; so does one that
    does not exist, if ``missing_is_error``, and else it gives none.
    """
    count = tasks or int(folders.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = StructType(folders.schema.fields + _ENTRY_FIELDS.fields)
    return folders.repartition(count, "folder").mapInArrow(_scanner(missing_is_error), schema)


def list_tables(items: DataFrame, tasks: int | None = None) -> DataFrame:
    """Directories exactly two levels under ``<item_root>/Tables``.

    ``items`` has ``item_id`` and ``item_root``.  Adds ``table_path``, ``folder`` and
    ``error``; an unreadable folder, or an item without one, gives a row with an error and no
    ``table_path``, beside the tables that could be listed.
    """
    failed = F.col("error").isNotNull()
    below = F.when(~failed, F.concat_ws("/", "folder", "name"))
    roots = items.select(
        "item_id", F.concat("item_root", F.lit(f"/{TABLE_ROOT}")).alias("folder")
    )
    schemas = list_entries(roots, tasks, missing_is_error=True).filter(F.col("is_directory") | failed)
    tables = list_entries(
        schemas.select(
            "item_id",
            F.col("name").alias("schema_name"),
            F.col("error").alias("schema_error"),
            below.alias("folder"),
        ),
        tasks,
    ).withColumn("error", F.coalesce("schema_error", "error"))
    path = F.when(~failed, F.concat_ws("/", F.lit(TABLE_ROOT), "schema_name", "name"))
    return tables.filter(F.col("is_directory") | failed).select(
        "item_id", path.alias("table_path"), below.alias("folder"), "error"
    )


def list_log_files(tables: DataFrame, tasks: int | None = None) -> DataFrame:
    """Every non-directory entry directly in the log folder of each table, by any name.

    ``tables`` has ``item_id``, ``table_path`` and ``folder``.  A table without a log folder
    gives no row; one whose log folder cannot be read gives a row with ``error`` set.
    """
    logs = tables.filter(F.col("table_path").isNotNull()).select(
        "item_id", "table_path", F.concat("folder", F.lit(f"/{LOG_FOLDER}")).alias("folder")
    )
    return (
        list_entries(logs, tasks)
        .filter(~F.coalesce("is_directory", F.lit(False)))
        .select("item_id", "table_path", F.col("name").alias("file_name"), "modified", "error")
    )
