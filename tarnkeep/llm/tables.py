"""Reading the input tables and keeping intermediate results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnkeep.storage import kept


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of the input folder, through Spark's own reader."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """``frame`` computed once into the shared folder and read back from there.

    Later steps then neither repeat the work nor depend on the executors that did it.  The files
    stay until the shared folder is cleared: the returned plan reads them lazily.
    """
    return kept(frame, purpose)[0]


def hex_number(text: Column, salt: str, digits: int = 13) -> Column:
    """A whole number from the first hex digits of the MD5 of ``salt`` and ``text``.

    13 digits are 52 bits, which a double holds exactly.
    """
    digest = F.md5(F.concat(F.lit(f"{salt}|"), text).cast("binary"))
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")


def unit_draw(text: Column, salt: str) -> Column:
    """A draw between 0 and 1, neither included, that ``text`` and ``salt`` alone decide."""
    return (hex_number(text, salt) + F.lit(0.5)) / F.lit(float(1 << 52))
