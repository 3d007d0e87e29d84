"""Metadata-sync run: choose endpoints, classify what came back, make the log rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnkeep.functions.ages import ntz
from tarnkeep.functions.names import ENDPOINT_NAME, ENDPOINT_TYPE
from tarnkeep.operators.inventory import select_targets, select_workspaces
from tarnkeep.operators.runs import (
    dry_run_outcomes,
    run_log_rows,
    sync_final_state,
    sync_outcomes,
)


def sync_targets(
    workspaces: DataFrame, items: DataFrame, domains: Sequence[str], suffix: str
) -> DataFrame:
    """SQL endpoints of the selected workspaces."""
    chosen = select_workspaces(workspaces, domains, suffix)
    return select_targets(chosen, items, ENDPOINT_TYPE, ENDPOINT_NAME)


def sync_log(
    targets: DataFrame,
    run_ts: datetime | str | Column | None = None,
    responses: DataFrame | None = None,
    polls: DataFrame | None = None,
    dry_run: bool = False,
) -> DataFrame:
    """Log rows of one run.  A dry run needs the targets only.

    Every failure is a row of its own target; without targets there are no rows.
    """
    if dry_run:
        outcomes = dry_run_outcomes(targets)
    else:
        # Replies and polls of other endpoints are left out before they are parsed.
        wanted = targets.select(F.col("item_id").alias("endpoint_id")).distinct()
        responses = responses.join(wanted, "endpoint_id", "left_semi")
        polls = polls.join(wanted, "endpoint_id", "left_semi")
        outcomes = sync_outcomes(responses, sync_final_state(polls))
    return run_log_rows(targets, outcomes, ntz(run_ts), dry_run)


def log_sync(rows: DataFrame, append: Callable[[DataFrame], None] | None) -> None:
    """Hand all rows to ``append`` at once; nothing is written if there is no log."""
    if append is not None:
        append(rows)
