"""Appending run and freshness rows to log tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def jdbc_options(
    url: str,
    table: str,
    driver: str | None = None,
    connections: int = 8,
    rows_per_insert: int = 10_000,
) -> dict[str, str]:
    """Options for :func:`append_log` into a database table."""
    options = {
        "url": url,
        "dbtable": table,
        "numPartitions": str(connections),
        "batchsize": str(rows_per_insert),
    }
    if driver:
        options["driver"] = driver
    return options


def not_yet_logged(rows: DataFrame, logged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose ``keys`` are not in the log.

    A database append that dies half-way keeps the partitions it has committed.  Appending
    this remainder of the same run completes the log without repeating a row.
    """
    return rows.join(logged.select(*keys), list(keys), "left_anti").select(*rows.columns)


def append_log(rows: DataFrame, format: str, **options: str) -> None:
    """One bulk append of all rows; columns are matched by name, failures are raised."""
    rows.write.format(format).mode("append").options(**options).save()
