"""Table inventories from folder listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnkeep.functions.names import without_prefix

TABLE_ROOT = "Tables"


def tables_from_paths(listing: DataFrame) -> DataFrame:
    """Table folders ``Tables/<schema>/<table>`` named or implied by a recursive listing.

    ``listing`` has ``item_id``, ``path`` (relative to the item, or starting with the item
    id) and ``is_directory``.  A path with more parts implies its table folder; one with
    exactly three parts counts only if it is a directory.
    """
    item_prefix = F.concat(F.col("item_id").cast("string"), F.lit("/"))
    parts = F.split(without_prefix(F.col("path"), item_prefix), "/")
    return (
        listing.select("item_id", "is_directory", parts.alias("parts"))
        .filter(F.get("parts", F.lit(0)) == TABLE_ROOT)
        .filter((F.size("parts") > 3) | ((F.size("parts") == 3) & F.col("is_directory")))
        .select("item_id", F.array_join(F.slice("parts", 1, 3), "/").alias("table_path"))
        .distinct()
    )
