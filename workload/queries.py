"""One query per operator; each takes the session and the folder with the tables."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from datetime import datetime, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnkeep.functions.ages import ntz
from tarnkeep.functions.names import WAREHOUSE_NAME, WAREHOUSE_TYPE, env_suffix
from tarnkeep.operators import drift, freshness, guards, inventory, runs
from tarnkeep.plans.freshness import freshness as freshness_run
from tarnkeep.plans.freshness import (
    freshness_incremental,
    freshness_on_mount,
    freshness_on_store,
    warehouse_targets,
)
from tarnkeep.plans.gated_etl import gated_etl
from tarnkeep.plans.load import load
from tarnkeep.plans.sync_log import sync_log, sync_targets
from tarnkeep.sinks.bucketed import BucketedTarget
from tarnkeep.sinks.log_tables import append_log
from tarnkeep.sinks.run_log import append_run, read_run_log
from tarnkeep.sinks.targets import PathTarget, TableTarget
from tarnkeep.sources.csv_files import raw_csv, typed_csv
from tarnkeep.sources.folders import list_log_files, list_tables
from tarnkeep.sources.registry import SchemaRegistry
from tarnkeep.sources.service_lists import items_from, workspaces_from
from tarnkeep.sources.store_listing import store_log_files
from tarnkeep.sources.tables import tables_from_paths
from tarnkeep.storage import shared_folder
from workload import frames
from workload.frames import table

REGIONS = ["AFRICA", "ASIA", "EUROPE"]
SEGMENTS = ["BUILDING", "FURNITURE", "HOUSEHOLD"]


# -- freshness ---------------------------------------------------------------------------


def _freshness(spark, sf_dir):
    targets = warehouse_targets(
        frames.region_workspaces(spark, sf_dir),
        frames.warehouse_items(spark, sf_dir),
        REGIONS,
        "_DEV",
    )
    return freshness_run(
        targets,
        frames.order_tables(spark, sf_dir),
        frames.line_files(spark, sf_dir),
        frames.RUN_TS,
        frames.THRESHOLD,
        ["table_id"],
    )


def freshness_detail(spark, sf_dir):
    return _freshness(spark, sf_dir)[0]


def freshness_summary(spark, sf_dir):
    return _freshness(spark, sf_dir)[1]


def latest_log_file(spark, sf_dir):
    files = frames.event_files(spark, sf_dir)
    return freshness.latest_log_file(files, ["item_id", "event_type"]).drop("error")


def health_label(spark, sf_dir):
    """Line per table and per warehouse, with the events as log files."""
    now = ntz(frames.EVENTS_NOW)
    ages = freshness.table_ages(
        frames.event_tables(spark, sf_dir),
        frames.event_files(spark, sf_dir),
        now,
        ["item_id", "event_type"],
        frames.EVENTS_THRESHOLD,
    )
    targets = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("item_id"),
        F.col("c_mktsegment").alias("workspace_name"),
        F.col("c_name").alias("item_name"),
    )
    summary = freshness.freshness_summary(targets, ages, now, frames.EVENTS_THRESHOLD)
    subject = F.concat_ws("/", F.col("item_id"), "table_path").alias("subject")
    return freshness.table_lines(ages).select(subject, "line").unionAll(
        freshness.warehouse_lines(summary).select("WarehouseName", "line")
    )


def freshness_log_append(spark, sf_dir):
    """Detail rows appended to a log in one write, then read back."""
    log = shared_folder(spark, "freshness-log")
    append_log(freshness_detail(spark, sf_dir), "parquet", path=log)
    return spark.read.parquet(log)


# -- inventory ---------------------------------------------------------------------------


def env_suffixes(spark, sf_dir):
    return frames.customer_workspaces(spark, sf_dir).select(
        "workspace_id", "workspace_name", env_suffix(F.col("workspace_name")).alias("suffix")
    )


def select_workspaces(spark, sf_dir):
    workspaces = frames.customer_workspaces(spark, sf_dir)
    return inventory.select_workspaces(workspaces, SEGMENTS, "_N7")


def select_targets(spark, sf_dir):
    workspaces = frames.customer_workspaces(spark, sf_dir)
    chosen = inventory.select_workspaces(workspaces, SEGMENTS, "_N7")
    items = frames.order_items(spark, sf_dir)
    return inventory.select_targets(chosen, items, WAREHOUSE_TYPE, WAREHOUSE_NAME)


def current_suffix(spark, sf_dir):
    return inventory.current_suffix(frames.customer_workspaces(spark, sf_dir), 7)


def service_targets(spark, sf_dir):
    """The same targets from lists named as the service exports them."""
    workspaces = workspaces_from(
        frames.customer_workspaces(spark, sf_dir).select(
            F.col("workspace_id").alias("Id"), F.col("workspace_name").alias("Name")
        )
    )
    listing = frames.order_items(spark, sf_dir).select(
        F.col("workspace_id").alias("Workspace Id"),
        F.col("item_id").alias("Id"),
        F.col("item_type").alias("Type"),
        F.col("item_name").alias("Display Name"),
    )
    chosen = inventory.select_workspaces(workspaces, SEGMENTS, "_N7")
    items = items_from(listing, "Workspace Id")
    return inventory.select_targets(chosen, items, WAREHOUSE_TYPE, WAREHOUSE_NAME)


def target_counts(spark, sf_dir):
    workspaces = frames.customer_workspaces(spark, sf_dir)
    chosen = inventory.select_workspaces(workspaces, SEGMENTS, "_N7")
    items = frames.order_items(spark, sf_dir)
    targets = inventory.select_targets(chosen, items, WAREHOUSE_TYPE, WAREHOUSE_NAME)
    return inventory.target_counts(chosen, targets)


def table_inventory(spark, sf_dir):
    return tables_from_paths(frames.page_listing(spark, sf_dir))


def pick_monitor_db(spark, sf_dir):
    return inventory.pick_monitor_db(frames.database_replies(spark, sf_dir))


def pick_monitor_db_nulls(spark, sf_dir):
    """Replies with JSON nulls, absent and nested fields, and others that are no JSON."""
    return inventory.pick_monitor_db(frames.odd_database_replies(spark, sf_dir))


def _write_page_logs(root: str, bare: bool):
    """Task body: one log file per page, dated by its id; if ``bare``, also tables without a log."""
    epoch = datetime(1970, 1, 1)
    first = datetime(2024, 1, 1)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page in batch.to_pylist():
                folder = f"{root}/{page['item_id']}/{page['table_path']}/_delta_log"
                os.makedirs(folder, exist_ok=True)
                path = f"{folder}/{page['page_id']:020d}.json"
                with open(path, "w", encoding="utf-8") as file:
                    file.write(page["url"])
                written = first + timedelta(minutes=page["page_id"]) - epoch
                os.utime(path, (written.total_seconds(),) * 2)
                if bare and page["page_id"] % 10 == 0:
                    os.makedirs(f"{root}/{page['item_id']}/Tables/bare/t{page['page_id']}", exist_ok=True)
            yield batch.select(["item_id"])

    return write


def _mounted(spark, folder):
    """The folder as the tasks' own file functions see it; only a local or ``file:`` path is one."""
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS")
    if not folder.startswith("file:") and ("://" in folder or not default.startswith("file:")):
        raise RuntimeError(f"{folder} is not a mounted path: set spark.checkpoint.dir to one")
    return "/" + folder.removeprefix("file:").lstrip("/")


def _page_tree(spark, sf_dir, bare=False):
    """A folder tree with one log file per page; its root and the page rows."""
    root = _mounted(spark, shared_folder(spark, "page-tree"))
    pages = frames.page_logs(spark, sf_dir)
    written = pages.mapInArrow(_write_page_logs(root, bare), "item_id string")
    written.write.format("noop").mode("overwrite").save()
    return root, pages


def log_file_listing(spark, sf_dir):
    """The log files of all pages, listed by the executors."""
    root, pages = _page_tree(spark, sf_dir)
    items = pages.select(
        "item_id", F.concat(F.lit(f"{root}/"), "item_id").alias("item_root")
    ).distinct()
    return list_log_files(list_tables(items)).drop("error")


def log_file_store(spark, sf_dir):
    """The same files through the data source, which needs no mount."""
    root, _ = _page_tree(spark, sf_dir)
    return store_log_files(spark, root).drop("error", "size")


def log_files_since(spark, sf_dir):
    """Files from a time on; the condition is applied where they are listed."""
    root, _ = _page_tree(spark, sf_dir)
    recent = store_log_files(spark, root).filter(F.col("modified") >= ntz(frames.PAGES_SINCE))
    return recent.drop("error", "size")


def freshness_stored(spark, sf_dir):
    """Summary of a run that lists the tree through the data source."""
    root, pages = _page_tree(spark, sf_dir)
    targets = pages.select(
        "item_id", F.lit("WS_PAGES").alias("workspace_name"), F.col("item_id").alias("item_name")
    ).distinct()
    return freshness_on_store(targets, root, frames.PAGES_NOW, frames.PAGES_THRESHOLD)[1]


def freshness_in_runs(spark, sf_dir):
    """Detail after three runs, each of which sees a part of the files; some are seen twice."""
    targets = warehouse_targets(
        frames.region_workspaces(spark, sf_dir), frames.warehouse_items(spark, sf_dir), REGIONS, "_DEV"
    )
    tables, files = frames.order_tables(spark, sf_dir), frames.line_files(spark, sf_dir)
    state = PathTarget(shared_folder(spark, "freshness-state"))
    part = F.pmod(F.xxhash64("file_name", "modified"), F.lit(4))
    for seen in ((3,), (0, 3), (1, 2)):
        detail, _ = freshness_incremental(
            targets, tables, files.filter(part.isin(*seen)), state, frames.RUN_TS, frames.THRESHOLD, ["table_id"]
        )
    return detail


def freshness_mounted(spark, sf_dir):
    """Summary of a run that lists the tree itself; the hosts are the warehouses."""
    root, pages = _page_tree(spark, sf_dir)
    targets = pages.select(
        "item_id", F.lit("WS_PAGES").alias("workspace_name"), F.col("item_id").alias("item_name")
    ).distinct()
    return freshness_on_mount(targets, root, frames.PAGES_NOW, frames.PAGES_THRESHOLD)[1]


def freshness_mounted_detail(spark, sf_dir):
    """Detail rows with tables that have no log and targets that have no folder."""
    root, pages = _page_tree(spark, sf_dir, bare=True)
    hosts = pages.select("item_id").distinct()
    targets = hosts.unionAll(hosts.select(F.concat(F.lit("gone."), "item_id"))).select(
        "item_id", F.lit("WS_PAGES").alias("workspace_name"), F.col("item_id").alias("item_name")
    )
    detail, _ = freshness_on_mount(targets, root, frames.PAGES_NOW, frames.PAGES_THRESHOLD)
    return detail.withColumn("Failed", F.col("ErrorMessage").isNotNull()).drop("ErrorMessage")


# -- loads -------------------------------------------------------------------------------


def _orders_target(spark, sf_dir, *partition_by):
    target = PathTarget(shared_folder(spark, "orders"), partition_by=partition_by)
    target.append(table(spark, sf_dir, "orders"))
    return target


def target_scan_counts(spark, sf_dir):
    return guards.row_counts(
        table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    )


def row_loss_guard(spark, sf_dir):
    shipped = table(spark, sf_dir, "lineitem").select("l_orderkey").distinct()
    return guards.row_loss_guard(guards.row_counts(shipped, table(spark, sf_dir, "orders")))


def post_load_check(spark, sf_dir):
    target = _orders_target(spark, sf_dir)
    source = frames.restated_orders(spark, sf_dir)
    load(source, target, "merge", key="o_orderkey")
    counts = guards.row_counts(source, target.read(spark))
    return guards.post_load_check(
        counts.withColumnsRenamed({"source_rows": "required_rows", "target_rows": "rows_after"})
    )


def load_report(spark, sf_dir):
    target = _orders_target(spark, sf_dir)
    return load(frames.restated_orders(spark, sf_dir), target, "fullload")


def load_append(spark, sf_dir):
    target = _orders_target(spark, sf_dir)
    load(frames.restated_orders(spark, sf_dir), target, "append")
    return target.read(spark)


def load_full(spark, sf_dir):
    target = _orders_target(spark, sf_dir)
    load(frames.restated_orders(spark, sf_dir), target, "fullload")
    return target.read(spark)


def load_merge(spark, sf_dir):
    target = _orders_target(spark, sf_dir)
    load(frames.restated_orders(spark, sf_dir), target, "merge", key="o_orderkey")
    return target.read(spark)


def load_merge_table(spark, sf_dir):
    """A merge into a partitioned catalog table; one of three partitions is exchanged."""
    folder = shared_folder(spark, "orders-table")
    name = f"orders_{folder.rpartition('-')[2]}"
    orders = table(spark, sf_dir, "orders")
    orders.write.partitionBy("o_orderstatus").option("path", folder).saveAsTable(name)
    target = TableTarget(name)
    load(frames.repriced_orders(spark, sf_dir), target, "merge", key="o_orderkey", check="content")
    return target.read(spark)


def load_merge_buckets(spark, sf_dir):
    """A merge into a table laid out by its key, of which the source touches some slots."""
    folder = shared_folder(spark, "orders-buckets")
    target = BucketedTarget(f"orders_{folder.rpartition('-')[2]}", "o_orderkey", slots=64, buckets=4)
    target.append(table(spark, sf_dir, "orders"))
    load(frames.restated_orders(spark, sf_dir), target, "merge", key="o_orderkey")
    return target.read(spark)


def load_full_proved(spark, sf_dir):
    """A full load whose stored content is compared with what was written."""
    target = _orders_target(spark, sf_dir)
    load(frames.restated_orders(spark, sf_dir), target, "fullload", check="content")
    return target.read(spark)


def load_merge_first(spark, sf_dir):
    target = PathTarget(shared_folder(spark, "orders"))
    load(frames.restated_orders(spark, sf_dir), target, "merge", key="o_orderkey")
    return target.read(spark)


def load_merge_partitions(spark, sf_dir):
    """A merge that rewrites one of three partitions."""
    target = _orders_target(spark, sf_dir, "o_orderstatus")
    load(frames.repriced_orders(spark, sf_dir), target, "merge", key="o_orderkey")
    return target.read(spark)


def load_merge_text_partitions(spark, sf_dir):
    """A merge into partitions whose names look like numbers but are text."""
    target = PathTarget(shared_folder(spark, "orders"), partition_by=("bucket",))
    bucket = F.lpad((F.col("o_custkey") % 20).cast("string"), 2, "0")
    orders = table(spark, sf_dir, "orders").withColumn("bucket", bucket)
    target.append(orders)
    finished = orders.filter("o_orderstatus = 'F'")
    source = finished.withColumn("o_totalprice", F.col("o_totalprice") * 2)
    load(source, target, "merge", key="o_orderkey")
    return target.read(spark)


# -- CSV and schema gate -----------------------------------------------------------------


def _orders_csv(spark, sf_dir, **renamed):
    path = shared_folder(spark, "orders-csv")
    orders = table(spark, sf_dir, "orders").withColumnsRenamed(renamed)
    orders.write.option("header", True).csv(path)
    return path


def csv_typed_scan(spark, sf_dir):
    schema = table(spark, sf_dir, "orders").schema
    return typed_csv(spark, _orders_csv(spark, sf_dir), schema)


def csv_raw_scan(spark, sf_dir):
    return raw_csv(spark, _orders_csv(spark, sf_dir))


def csv_multi_line_scan(spark, sf_dir):
    """Orders with line breaks, quotes and separators in quotes, cut into records by all tasks."""
    path = shared_folder(spark, "orders-csv")
    noted = F.concat(F.lit('a "note",\n\nfor '), "o_orderpriority")
    orders = table(spark, sf_dir, "orders").withColumn("o_orderpriority", noted)
    orders.write.option("header", True).option("escape", '"').csv(path)
    return typed_csv(spark, path, multi_line=True).withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


def schema_fields(spark, sf_dir):
    """Schema inferred from all rows of a CSV file."""
    return drift.schema_fields(spark, typed_csv(spark, _orders_csv(spark, sf_dir)).schema)


def schema_drift(spark, sf_dir):
    """Schema inferred from all rows of a CSV file against that of the table."""
    path = _orders_csv(spark, sf_dir, o_orderpriority="o_priority")
    return drift.schema_drift(
        drift.schema_fields(spark, table(spark, sf_dir, "orders").schema),
        drift.schema_fields(spark, typed_csv(spark, path).schema),
    )


def schema_path_drift(spark, sf_dir):
    """Line items nested in orders; a field renamed, one of another type, one gone with all that it holds."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")

    def nested(line, *more):
        whole = F.struct(*[F.col(name) for name in orders.columns]).alias("head")
        return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
            whole, F.array(F.struct(*line)).alias("lines"), F.create_map("l_linenumber", F.struct(*line)).alias("by_number"), *more
        )

    plain = [F.col(name) for name in lines.columns]
    changed = [
        F.col(name).cast("string").alias(name) if name == "l_quantity" else F.col(name).alias(name.replace("l_tax", "l_vat"))
        for name in lines.columns
    ]
    expected = nested(plain, F.struct(F.struct("l_tax").alias("inner")).alias("extra"))
    return drift.path_drift(
        drift.schema_paths(spark, expected.schema), drift.schema_paths(spark, nested(changed).schema)
    )


def schema_approval_state(spark, sf_dir):
    """Customers as tables, their orders as files of the registry."""
    tables = table(spark, sf_dir, "customer").select(
        F.lit("crm").alias("schema_name"),
        F.concat(F.lit("t"), F.col("c_custkey").cast("string")).alias("table_name"),
    )
    ending = (
        F.when(F.col("o_totalprice") > 480000, ".json")
        .when(F.col("o_orderpriority") == "1-URGENT", "_InitialLoad.json")
        .otherwise(".csv")
    )
    files = table(spark, sf_dir, "orders").select(
        F.lit("crm").alias("schema_name"),
        F.concat(F.lit("t"), F.col("o_custkey").cast("string"), ending).alias("file_name"),
    )
    return drift.approval_states(tables, files)


def schema_cast(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    texts = lineitem.select(*[F.col(name).cast("string") for name in reversed(lineitem.columns)])
    return drift.cast_to(texts, lineitem.schema)


def schema_rejects(spark, sf_dir):
    """Line items with the ship date where a number belongs."""
    lineitem = table(spark, sf_dir, "lineitem")
    late = F.when(F.col("l_returnflag") == "R", F.col("l_shipdate").cast("string"))
    texts = lineitem.select(
        F.col("l_orderkey").cast("string"),
        F.coalesce(late, F.col("l_quantity").cast("string")).alias("l_quantity"),
        F.when(F.col("l_linestatus") == "F", "n/a").otherwise("0.5").alias("l_tax"),
    )
    return drift.rejected_rows(
        texts, lineitem.select("l_orderkey", "l_quantity", "l_tax").schema
    ).withColumn("bad_columns", F.array_join("bad_columns", ","))


def gated_orders(spark, sf_dir):
    path = _orders_csv(spark, sf_dir)
    registry = SchemaRegistry(spark, shared_folder(spark, "registry"))
    schema = table(spark, sf_dir, "orders").schema
    registry.record(schema, "sales", "orders", drift.APPROVED_ENDING)
    target = PathTarget(shared_folder(spark, "gated"))
    gated_etl(path, registry, "sales", "orders", target)
    return target.read(spark)


def gated_strict(spark, sf_dir):
    """The gate that compares types, which a text source passes for text columns."""
    path = shared_folder(spark, "orders-csv")
    texts = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string"), "o_orderstatus", "o_orderpriority"
    )
    texts.write.option("header", True).csv(path)
    registry = SchemaRegistry(spark, shared_folder(spark, "registry"))
    registry.record(texts.schema, "sales", "orders", drift.APPROVED_ENDING)
    target = PathTarget(shared_folder(spark, "gated"))
    gated_etl(path, registry, "sales", "orders", target, mode="strict")
    return target.read(spark)


# -- runs --------------------------------------------------------------------------------


def sync_final_state(spark, sf_dir):
    return runs.sync_final_state(frames.event_polls(spark, sf_dir))


def sync_outcomes(spark, sf_dir):
    ends = runs.sync_final_state(frames.line_polls(spark, sf_dir))
    return runs.sync_outcomes(frames.order_replies(spark, sf_dir), ends)


def _sync_log(spark, sf_dir, **how):
    targets = sync_targets(
        frames.customer_workspaces(spark, sf_dir),
        frames.order_items(spark, sf_dir),
        SEGMENTS,
        "_N7",
    )
    return sync_log(targets, frames.RUN_TS, **how)


def run_log_rows(spark, sf_dir):
    replies = frames.order_replies(spark, sf_dir)
    return _sync_log(spark, sf_dir, responses=replies, polls=frames.line_polls(spark, sf_dir))


def run_log_append(spark, sf_dir):
    """Log entries with 0/1 flags, brought to the log's types and appended in two runs."""
    entries = run_log_rows(spark, sf_dir).withColumn("IsDryRun", F.col("IsDryRun").cast("int"))
    log = shared_folder(spark, "run-log")
    append_log(runs.as_run_log(entries.filter("Status = 'Starting'")), "parquet", path=log)
    append_log(runs.as_run_log(entries.filter("Status <> 'Starting'")), "parquet", path=log)
    return spark.read.parquet(log)


def run_log_once(spark, sf_dir):
    """Both parts of a run appended, one of them twice; the log has each once."""
    entries = runs.as_run_log(run_log_rows(spark, sf_dir))
    log = shared_folder(spark, "run-log")
    for run, rows in (
        ("starts", entries.filter("Status = 'Starting'")),
        ("ends", entries.filter("Status <> 'Starting'")),
        ("starts", entries.filter("Status = 'Starting'")),
    ):
        append_run(rows, log, run)
    return read_run_log(spark, log, entries.schema).drop("run")


def run_log_dry_run(spark, sf_dir):
    return _sync_log(spark, sf_dir, dry_run=True)


def sync_latest_status(spark, sf_dir):
    return runs.sync_latest_status(frames.event_log(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "freshness_detail": freshness_detail,
    "freshness_summary": freshness_summary,
    "latest_log_file": latest_log_file,
    "health_label": health_label,
    "freshness_log_append": freshness_log_append,
    "env_suffix": env_suffixes,
    "current_suffix": current_suffix,
    "service_targets": service_targets,
    "select_workspaces": select_workspaces,
    "select_targets": select_targets,
    "target_counts": target_counts,
    "table_inventory": table_inventory,
    "pick_monitor_db": pick_monitor_db,
    "pick_monitor_db_nulls": pick_monitor_db_nulls,
    "log_file_listing": log_file_listing,
    "log_file_store": log_file_store,
    "log_files_since": log_files_since,
    "freshness_on_store": freshness_stored,
    "freshness_in_runs": freshness_in_runs,
    "freshness_on_mount": freshness_mounted,
    "freshness_on_mount_detail": freshness_mounted_detail,
    "target_scan_counts": target_scan_counts,
    "row_loss_guard": row_loss_guard,
    "post_load_check": post_load_check,
    "load_report": load_report,
    "load_append": load_append,
    "load_full": load_full,
    "load_merge": load_merge,
    "load_merge_first": load_merge_first,
    "load_merge_table": load_merge_table,
    "load_merge_buckets": load_merge_buckets,
    "load_full_proved": load_full_proved,
    "load_merge_partitions": load_merge_partitions,
    "load_merge_text_partitions": load_merge_text_partitions,
    "csv_typed_scan": csv_typed_scan,
    "csv_raw_scan": csv_raw_scan,
    "csv_multi_line_scan": csv_multi_line_scan,
    "schema_fields": schema_fields,
    "schema_drift": schema_drift,
    "schema_path_drift": schema_path_drift,
    "schema_approval_state": schema_approval_state,
    "schema_cast": schema_cast,
    "schema_rejects": schema_rejects,
    "gated_etl": gated_orders,
    "gated_etl_strict": gated_strict,
    "sync_final_state": sync_final_state,
    "sync_outcomes": sync_outcomes,
    "run_log_rows": run_log_rows,
    "run_log_append": run_log_append,
    "run_log_once": run_log_once,
    "run_log_dry_run": run_log_dry_run,
    "sync_latest_status": sync_latest_status,
}
