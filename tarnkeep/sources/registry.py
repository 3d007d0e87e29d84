"""Approved schemas kept as JSON files, one folder per schema."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tarnkeep.operators.drift import APPROVED_ENDING, BOOTSTRAP_ENDING
from tarnkeep.storage import Storage


class SchemaPending(ValueError):
    """A schema waits for review; the run must stop."""


class SchemaMissing(FileNotFoundError):
    """Neither an approved nor a bootstrap schema exists."""


@dataclass(frozen=True)
class SchemaRegistry:
    """Folder ``<root>/<schema>/`` with ``<table>.json`` (approved) or a bootstrap file."""

    spark: SparkSession
    root: str

    def record(
        self, schema: StructType, schema_name: str, table_name: str, ending: str
    ) -> str:
        """Write one schema file and return its path."""
        path = self._file(schema_name, table_name, ending)
        text = json.dumps(json.loads(schema.json()), indent=2, ensure_ascii=False)
        Storage(self.spark).write_text(path, text)
        return path

    def bootstrap(self, frame: DataFrame, schema_name: str, table_name: str) -> None:
        """Record the schema of ``frame`` for review, then stop the run."""
        path = self.record(frame.schema, schema_name, table_name, BOOTSTRAP_ENDING)
        raise SchemaPending(
            f"schema recorded at {path}: review it, rename it to "
            f"{table_name}{APPROVED_ENDING} and run again"
        )

    def approved(self, schema_name: str, table_name: str) -> StructType:
        """The approved schema; an error tells apart 'under review' and 'none at all'."""
        path = self._file(schema_name, table_name, APPROVED_ENDING)
        storage = Storage(self.spark)
        if storage.exists(path):
            return StructType.fromJson(json.loads(storage.read_text(path)))
        recorded = self._file(schema_name, table_name, BOOTSTRAP_ENDING)
        if storage.exists(recorded):
            raise SchemaPending(
                f"only {recorded} exists: review it and rename it to "
                f"{table_name}{APPROVED_ENDING}"
            )
        raise SchemaMissing(f"no schema file for {schema_name}/{table_name}")

    def _file(self, schema_name: str, table_name: str, ending: str) -> str:
        return f"{self.root.rstrip('/')}/{schema_name}/{table_name}{ending}"
