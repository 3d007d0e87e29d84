"""Choosing workspaces, items and the monitoring database by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnkeep.functions.names import env_suffix, matches, workspace_pattern
from tarnkeep.functions.payloads import text_or


def current_suffix(workspaces: DataFrame, workspace_id) -> DataFrame:
    """Name and environment suffix of one workspace."""
    return workspaces.filter(F.col("workspace_id") == workspace_id).select(
        "workspace_id", "workspace_name", env_suffix(F.col("workspace_name")).alias("suffix")
    )


def select_workspaces(
    workspaces: DataFrame, domains: Sequence[str], suffix: str
) -> DataFrame:
    """Workspaces named ``WS_<domain><suffix>``, whatever their case."""
    return workspaces.filter(
        matches(F.col("workspace_name"), workspace_pattern(domains, suffix))
    )


def select_targets(
    workspaces: DataFrame, items: DataFrame, item_type: str, name_pattern: str
) -> DataFrame:
    """Items of one type and name pattern in the given (already selected) workspaces.

    ``items`` may carry an ``error`` column with one row per workspace whose listing failed;
    those rows never match and the other workspaces go on.
    """
    chosen = items.filter(
        (F.col("item_type") == item_type) & matches(F.col("item_name"), name_pattern)
    ).select("workspace_id", "item_id", "item_name")
    return chosen.join(workspaces.select("workspace_id", "workspace_name"), "workspace_id").select(
        "workspace_id", "workspace_name", "item_id", "item_name"
    )


def target_counts(workspaces: DataFrame, targets: DataFrame) -> DataFrame:
    """One row: how many workspaces matched and how many targets they have."""
    both = workspaces.select(F.lit(False).alias("is_target")).unionAll(
        targets.select(F.lit(True).alias("is_target"))
    )
    return both.agg(
        F.count_if(~F.col("is_target")).alias("matching_workspaces"),
        F.count_if("is_target").alias("targets"),
    )


def pick_monitor_db(payloads: DataFrame, prefix: str = "ProcessDB") -> DataFrame:
    """First database of each reply whose name has the prefix and no underscore.

    ``payloads`` has ``workspace_id`` and the reply ``body``.  Replies without such a database, or that are
    not JSON, keep their row with nulls.  A database without an address has an empty ``server``; one whose
    address, name or properties are a JSON null, or of another kind than text, has a null there.  The list order
    inside the reply decides, so the choice stays inside the row and needs no shuffle.
    """

    def eligible(database):
        name = F.try_variant_get(database, "$.displayName", "string")
        return F.startswith(name, F.lit(prefix)) & ~F.contains(name, F.lit("_"))

    listed = F.try_variant_get(F.try_parse_json("body"), "$.value", "array<variant>")
    first = F.get(F.filter(listed, eligible), F.lit(0))
    picked = payloads.select("workspace_id", first.alias("db"))
    properties = F.try_variant_get("db", "$.properties", "variant")
    host = text_or(F.try_variant_get("db", "$.properties.serverFqdn", "variant"), "")
    known = F.col("db").isNotNull() & ~F.coalesce(F.is_variant_null(properties), F.lit(False))
    return picked.select(
        "workspace_id",
        F.try_variant_get("db", "$.displayName", "string").alias("display_name"),
        F.when(known, F.replace(host, F.lit(","), F.lit(":"))).alias("server"),
        F.try_variant_get("db", "$.properties.databaseName", "string").alias("database_name"),
    )
