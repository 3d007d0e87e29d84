"""Outcomes of metadata syncs: final states, classification, run log, latest status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarnkeep.functions.payloads import reply_object, text_or
from tarnkeep.operators.merge import conform

# States and markers of the run log.
IN_PROGRESS = "inProgress"
STARTING = "Starting"
DRY_RUN_SUCCESS = "DRY_RUN_SUCCESS"
FAILED_ALREADY_RUNNING = "FAILED_ALREADY_RUNNING"
ERROR_FETCHING_STATUS = "ERROR_FETCHING_STATUS"
UNKNOWN_STATE = "unknown"
NO_BATCH_ID = "NO_ID"
NOT_STARTED_BATCH = "N/A"
BUSY_CODES = [400, 409]
ERROR_LENGTH = 50

RUN_LOG = (
    "ExecutionTime timestamp_ntz, WorkspaceName string, EndpointName string, "
    "Status string, BatchId string, IsDryRun boolean"
)


def _error_status(text: Column) -> Column:
    return F.concat(F.lit("ERROR: "), F.substring(text, 1, ERROR_LENGTH))


def _unreadable(body: Column) -> Column:
    shown = F.coalesce(body, F.lit("no body"))
    return _error_status(F.concat(F.lit("not a JSON object: "), shown))


def sync_final_state(polls: DataFrame) -> DataFrame:
    """State each batch ended with: its first poll that is not ``inProgress``.

    ``polls`` has ``endpoint_id``, ``batch_id``, ``poll_ts``, ``poll_no`` (settles equal
    times), ``ok`` and the reply ``body``.  Batches still running have no row.  Polls are
    reduced per task first, so a batch with very many of them is no burden.
    """
    reply = F.col("reply")
    state = (
        F.when(~F.col("ok"), ERROR_FETCHING_STATUS)
        .when(reply.isNull(), _unreadable(F.col("body")))
        .otherwise(text_or(reply["progressState"], UNKNOWN_STATE))
    )
    # The running polls are left out inside the aggregate: a filter would be pushed below the
    # parsing and parse every reply once more.
    ended = F.when(
        ~F.equal_null("state", F.lit(IN_PROGRESS)), F.struct("poll_ts", "poll_no", "state")
    )
    return (
        polls.withColumn(
            "reply", F.when(F.col("ok"), reply_object(F.col("body"), "progressState"))
        )
        .select("endpoint_id", "batch_id", "poll_ts", "poll_no", state.alias("state"))
        .groupBy("endpoint_id", "batch_id")
        .agg(F.min(ended).alias("first"))
        .filter(F.col("first").isNotNull())
        .select("endpoint_id", "batch_id", F.col("first.state").alias("final_state"))
    )


def sync_outcomes(responses: DataFrame, final_states: DataFrame) -> DataFrame:
    """``status`` and ``batch_id`` of every triggered sync.

    ``responses`` has ``endpoint_id``, ``http_status``, the reply ``body`` and ``error`` (text
    of a failed call, or null).  ``finished`` is false while no final state is known.
    """
    reply = F.col("reply")
    failed_call = F.col("error").isNotNull()
    busy = F.col("http_status").isin(BUSY_CODES)
    settled = (
        F.when(failed_call, _error_status(F.col("error")))
        .when(busy, FAILED_ALREADY_RUNNING)
        .when(reply.isNull(), _unreadable(F.col("body")))
    )
    started = text_or(reply["batchId"], NO_BATCH_ID)
    triggers = (
        responses.withColumn(
            "reply",
            F.when(failed_call | busy, None).otherwise(reply_object(F.col("body"), "batchId")),
        )
        .withColumn("settled", settled)
        .select(
            "endpoint_id",
            "settled",
            F.when(F.col("settled").isNotNull(), NOT_STARTED_BATCH)
            .otherwise(started)
            .alias("batch_id"),
        )
    )
    ends = final_states.select(
        F.col("endpoint_id").alias("polled_id"),
        F.col("batch_id").alias("polled_batch"),
        "final_state",
    )
    same_batch = (F.col("endpoint_id") == F.col("polled_id")) & F.equal_null(
        "batch_id", "polled_batch"
    )
    return triggers.join(ends, same_batch, "left").select(
        "endpoint_id",
        F.coalesce("settled", "final_state").alias("status"),
        "batch_id",
        (F.col("settled").isNotNull() | F.col("polled_id").isNotNull()).alias("finished"),
    )


def dry_run_outcomes(targets: DataFrame) -> DataFrame:
    """What a dry run records: success for every target, nothing started."""
    return targets.select(
        F.col("item_id").alias("endpoint_id"),
        F.lit(DRY_RUN_SUCCESS).alias("status"),
        F.lit(NOT_STARTED_BATCH).alias("batch_id"),
        F.lit(True).alias("finished"),
    )


def run_log_rows(
    targets: DataFrame, outcomes: DataFrame, run_ts: Column, dry_run: bool
) -> DataFrame:
    """Run-log rows: ``Starting`` for every target, then its outcome once it is finished.

    Both rows of a target come out of one joined row, so nothing is scanned twice.
    """
    named = targets.select(
        F.col("item_id").alias("endpoint_id"), "workspace_name", "item_name"
    )
    start = F.struct(F.lit(STARTING).alias("status"), F.lit(NOT_STARTED_BATCH).alias("batch_id"))
    outcome = F.when(F.col("finished"), F.struct("status", "batch_id"))
    both = F.array_compact(F.array(start, outcome))
    return (
        named.join(outcomes, "endpoint_id", "left")
        .select("workspace_name", "item_name", F.explode(both).alias("entry"))
        .select(
            run_ts.cast("timestamp_ntz").alias("ExecutionTime"),
            F.col("workspace_name").alias("WorkspaceName"),
            F.col("item_name").alias("EndpointName"),
            F.col("entry.status").alias("Status"),
            F.col("entry.batch_id").alias("BatchId"),
            F.lit(dry_run).cast("boolean").alias("IsDryRun"),
        )
    )


def as_run_log(entries: DataFrame) -> DataFrame:
    """Log entries from elsewhere in the types of the run log (0/1 flags become booleans)."""
    return conform(entries, StructType.fromDDL(RUN_LOG))


def sync_latest_status(log: DataFrame) -> DataFrame:
    """Latest log row per endpoint.

    ``Starting`` and the outcome of one run carry the same time; the outcome comes later.
    """
    order = F.struct(
        F.col("ExecutionTime"),
        (F.col("Status") != STARTING).alias("settled"),
        "Status",
        "BatchId",
        "IsDryRun",
    )
    latest = log.groupBy("WorkspaceName", "EndpointName").agg(F.max(order).alias("latest"))
    fields = ["ExecutionTime", "Status", "BatchId", "IsDryRun"]
    return latest.select(
        "WorkspaceName", "EndpointName", *[f"latest.{field}" for field in fields]
    )
