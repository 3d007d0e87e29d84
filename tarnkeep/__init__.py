"""Keep lakehouse tables loaded, checked and fresh with Spark DataFrames."""

from tarnkeep.plans.freshness import (
    freshness,
    freshness_incremental,
    freshness_on_mount,
    freshness_on_store,
    log_freshness,
    warehouse_targets,
)
from tarnkeep.plans.gated_etl import SchemaDrift, check_schema, gated_etl
from tarnkeep.plans.load import LoadRejected, load
from tarnkeep.plans.sync_log import log_sync, sync_log, sync_targets
from tarnkeep.session import apply_settings
from tarnkeep.sinks.bucketed import BucketedTarget
from tarnkeep.sinks.log_tables import append_log, jdbc_options
from tarnkeep.sinks.run_log import append_run, read_run_log
from tarnkeep.sinks.targets import PathTarget, TableTarget
from tarnkeep.sources.csv_files import raw_csv, typed_csv
from tarnkeep.sources.registry import SchemaMissing, SchemaPending, SchemaRegistry
from tarnkeep.sources.store_listing import store_log_files, store_tables

__all__ = [
    "BucketedTarget",
    "LoadRejected",
    "PathTarget",
    "SchemaDrift",
    "SchemaMissing",
    "SchemaPending",
    "SchemaRegistry",
    "TableTarget",
    "append_log",
    "append_run",
    "apply_settings",
    "check_schema",
    "freshness",
    "freshness_incremental",
    "freshness_on_mount",
    "freshness_on_store",
    "gated_etl",
    "jdbc_options",
    "load",
    "log_freshness",
    "log_sync",
    "raw_csv",
    "read_run_log",
    "store_log_files",
    "store_tables",
    "sync_log",
    "sync_targets",
    "typed_csv",
    "warehouse_targets",
]
