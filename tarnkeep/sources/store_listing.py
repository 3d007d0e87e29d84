"""Listing log files on any store that Arrow can open, as a Spark data source.

``pyarrow.fs`` opens local paths and ``file:``, ``s3:``, ``gs:``, ``abfs:`` and ``hdfs:`` addresses.  The folders of the
tables are found while the query is planned, by several threads; each table is a partition of its own, and the task that
reads it lists its log folder and streams the entries out.  Conditions on ``modified`` are applied before anything
leaves the task, conditions on ``item_id`` before anything is listed.

Names that start with ``_`` and empty files are listed like all others; what cannot be listed is a row with ``error``.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
)

from tarnkeep.sources.folders import LOG_FOLDER
from tarnkeep.sources.tables import TABLE_ROOT

NAME = "store_listing"
#: Folders that are listed at the same time while a query is planned.
THREADS = 32
ENTRIES = 10_000
SCHEMA = pa.schema(
    [
        ("item_id", pa.string()),
        ("table_path", pa.string()),
        ("file_name", pa.string()),
        ("modified", pa.timestamp("us")),
        ("size", pa.int64()),
        ("error", pa.string()),
    ]
)
SCHEMA_TYPES = (
    "item_id string, table_path string, file_name string, modified timestamp_ntz, size long, error string"
)


def open_store(address: str) -> tuple[fs.FileSystem, str]:
    """The file system of an address or plain path, and the path in it."""
    if address.startswith("file:"):
        address = "/" + address.removeprefix("file:").lstrip("/")
    if "://" not in address:
        return fs.LocalFileSystem(), address.rstrip("/")
    store, path = fs.FileSystem.from_uri(address)
    return store, path.rstrip("/")


def _folders(store: fs.FileSystem, path: str) -> list[str]:
    """Names of the folders directly in ``path``."""
    found = store.get_file_info(fs.FileSelector(path))
    return sorted(entry.base_name for entry in found if entry.type == fs.FileType.Directory)


@dataclass
class TablePartition(InputPartition):
    """One table, or one item or schema whose folders could not be listed."""

    item_id: str
    table_path: str | None
    error: str | None = None


class _Reader(DataSourceReader):
    def __init__(self, root: str, items: list[str] | None, kind: str):
        self._root, self._items, self._kind = root, items, kind
        self._bounds: list[tuple[str, datetime]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Take what concerns names of items and times; Spark keeps the rest."""
        bounds = {GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<=", EqualTo: "="}
        for one in filters:
            about = getattr(one, "attribute", None)  # a negation has none
            if about == ("item_id",) and isinstance(one, (EqualTo, In)):
                named = [one.value] if isinstance(one, EqualTo) else list(one.value)
                self._items = [n for n in named if n is not None and (self._items is None or n in self._items)]
            elif about == ("modified",) and type(one) in bounds:
                self._bounds.append((bounds[type(one)], one.value))
            elif about != ("item_id",) or not isinstance(one, IsNotNull):  # items have names
                yield one

    def partitions(self) -> list[TablePartition]:
        store, root = open_store(self._root)
        items = _folders(store, root) if self._items is None else sorted(set(self._items))
        with ThreadPoolExecutor(THREADS) as pool:
            found = list(pool.map(lambda item: self._tables(store, f"{root}/{item}", item), items))
        return [partition for partitions in found for partition in partitions]

    def _tables(self, store: fs.FileSystem, folder: str, item: str) -> list[TablePartition]:
        try:
            schemas = _folders(store, f"{folder}/{TABLE_ROOT}")
        except OSError as error:
            return [TablePartition(item, None, str(error))]
        found = []
        for schema in schemas:
            try:
                tables = _folders(store, f"{folder}/{TABLE_ROOT}/{schema}")
                found += [TablePartition(item, f"{TABLE_ROOT}/{schema}/{table}") for table in tables]
            except OSError as error:
                found.append(TablePartition(item, None, str(error)))
        return found

    def read(self, partition: TablePartition | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # there are none
            return
        item, table = partition.item_id, partition.table_path
        if self._kind == "tables" or table is None:
            if not self._bounds:
                yield self._rows([(item, table, None, None, None, partition.error)])
            return
        store, root = open_store(self._root)
        try:
            entries = store.get_file_info(fs.FileSelector(f"{root}/{item}/{table}/{LOG_FOLDER}"))
        except FileNotFoundError:
            return  # a table without a log
        except OSError as error:
            if not self._bounds:
                yield self._rows([(item, table, None, None, None, str(error))])
            return
        rows = []
        for entry in entries:
            if entry.type == fs.FileType.Directory or entry.type == fs.FileType.NotFound:
                continue
            modified = None if entry.mtime_ns is None else entry.mtime_ns // 1_000
            if self._wanted(modified):
                rows.append((item, table, entry.base_name, modified, entry.size, None))
            if len(rows) == ENTRIES:
                yield self._rows(rows)
                rows = []
        if rows:
            yield self._rows(rows)

    def _wanted(self, modified: int | None) -> bool:
        """Whether a time in microseconds passes all conditions; no time passes none."""
        if self._bounds and modified is None:
            return False
        for how, bound in self._bounds:
            since = bound.replace(tzinfo=None) - datetime(1970, 1, 1)
            limit = (since.days * 86_400 + since.seconds) * 1_000_000 + since.microseconds
            passes = {
                ">": modified > limit,
                ">=": modified >= limit,
                "<": modified < limit,
                "<=": modified <= limit,
                "=": modified == limit,
            }
            if not passes[how]:
                return False
        return True

    @staticmethod
    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(zip(*rows, strict=True), SCHEMA.types, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], schema=SCHEMA)


class StoreListing(DataSource):
    """Options: ``root``, whose folders are the items; ``items``, a JSON list of names, else all; ``kind``, ``files``
    (by default) or ``tables``, which lists no logs and gives one row per table."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA_TYPES

    def reader(self, schema) -> DataSourceReader:
        kind = self.options.get("kind", "files")
        if kind not in ("files", "tables"):
            raise ValueError(f"kind is 'files' or 'tables', not {kind!r}")
        items = self.options.get("items")
        return _Reader(self.options["root"], None if items is None else json.loads(items), kind)


def _listed(spark: SparkSession, root: str, items: list[str] | None, kind: str) -> DataFrame:
    # A session that lists is one that may push conditions to the listing.
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(StoreListing)
    reader = spark.read.format(NAME).option("root", root).option("kind", kind)
    return (reader if items is None else reader.option("items", json.dumps(items))).load()


def store_tables(spark: SparkSession, root: str, items: list[str] | None = None) -> DataFrame:
    """``item_id``, ``table_path`` and ``error`` of all tables below ``root``: folders two levels under ``Tables``.

    An item or schema folder that cannot be listed is a row with an error and no path.
    """
    return _listed(spark, root, items, "tables").select("item_id", "table_path", "error")


def store_log_files(spark: SparkSession, root: str, items: list[str] | None = None) -> DataFrame:
    """``item_id``, ``table_path``, ``file_name``, ``modified``, ``size`` and ``error`` of all log files.

    A table without a log has no row; what cannot be listed has one with an error and no file.
    """
    return _listed(spark, root, items, "files")
