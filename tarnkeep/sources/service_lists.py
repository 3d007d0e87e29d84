"""Workspace and item lists as the service exports them, in this package's column names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def workspaces_from(listing: DataFrame) -> DataFrame:
    """``Id`` and ``Name`` become ``workspace_id`` and ``workspace_name``."""
    return listing.select(
        F.col("Id").alias("workspace_id"), F.col("Name").alias("workspace_name")
    )


def items_from(listing: DataFrame, workspace_column: str) -> DataFrame:
    """``Id``, ``Type`` and ``Display Name`` of items, beside the id of their workspace."""
    return listing.select(
        F.col(workspace_column).alias("workspace_id"),
        F.col("Id").alias("item_id"),
        F.col("Type").alias("item_type"),
        F.col("Display Name").alias("item_name"),
    )
