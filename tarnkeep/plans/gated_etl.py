"""CSV to table through the schema gate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from tarnkeep.operators.drift import cast_to, path_drift, schema_paths
from tarnkeep.sinks.targets import PathTarget, TableTarget
from tarnkeep.sources.csv_files import raw_csv
from tarnkeep.sources.registry import SchemaMissing, SchemaRegistry


class SchemaDrift(ValueError):
    """The incoming columns differ from the approved schema."""


def check_schema(frame: DataFrame, approved: StructType, mode: str = "strict") -> None:
    """Raise one :class:`SchemaDrift` that lists every difference.

    ``strict`` compares types too; ``names`` leaves them to the cast, which is the mode for
    all-text sources.
    """
    if mode not in ("strict", "names"):
        raise ValueError(f"unknown mode: {mode!r}")
    expected, incoming = approved, frame.schema
    if mode == "names":
        expected, incoming = _names_only(expected), _names_only(incoming)
    spark = frame.sparkSession
    drift = path_drift(schema_paths(spark, expected), schema_paths(spark, incoming))
    found = drift.collect()  # at most one row per column or place within it
    if found:
        lines = [
            f"  {row.kind}: {row.column_name} (expected {row.expected}, actual {row.actual})"
            for row in found
        ]
        raise SchemaDrift("\n".join(["schema drift", *lines]))


def gated_etl(
    source_path: str,
    registry: SchemaRegistry,
    schema_name: str,
    table_name: str,
    target: PathTarget | TableTarget,
    mode: str = "names",
) -> DataFrame:
    """Scan, gate, cast and append; returns the typed rows.

    Without any schema on file the incoming one is recorded and the run stops for review.
    """
    incoming = raw_csv(registry.spark, source_path)
    try:
        approved = registry.approved(schema_name, table_name)
    except SchemaMissing:
        registry.bootstrap(incoming, schema_name, table_name)
    check_schema(incoming, approved, mode)
    target.recover(registry.spark)
    present = target.read(registry.spark)
    if present is not None:
        # A folder would take rows of other types and become unreadable.
        check_schema(present, approved)
    typed = cast_to(incoming, approved)
    target.append(typed)
    return typed


def _names_only(schema: StructType) -> StructType:
    return StructType([StructField(name, StringType()) for name in schema.names])
