"""Session settings the plans in this package are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Joins are re-planned from real sizes; a hot partition is cut up even if that
    # costs one more exchange below an aggregate.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Intermediate results are written tables, so the shuffles behind one are of no use once it is
    # there.  Without this they stay on disk until the driver happens to collect its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the above on a running session and return it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
