"""Casts that neither turn a bad value into null nor lose a part of a good one."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DatetimeType, IntegralType, NumericType

_WHOLE = ["tinyint", "smallint", "int", "bigint"]


def _may_lose(given: DataType, wanted: DataType) -> bool:
    """Whether a cast that succeeds can still drop digits or a time."""
    if given == wanted:
        return False
    numbers = isinstance(given, NumericType) and isinstance(wanted, NumericType)
    if numbers and isinstance(given, IntegralType) and isinstance(wanted, IntegralType):
        # A narrower whole number fails or holds the same value.
        return False
    if given.simpleString() in _WHOLE[:3] and wanted.simpleString() == "double":
        return False
    if (given.simpleString(), wanted.simpleString()) == ("float", "double"):
        return False
    return numbers or (isinstance(given, DatetimeType) and isinstance(wanted, DatetimeType))


def strict_cast(
    spark: SparkSession, value: Column, data_type: DataType, given: DataType | None = None
) -> Column:
    """``value`` in another type; a value that does not fit fails the query.

    In ANSI mode, the default, a cast fails for what it cannot read.  Without it a cast gives
    null, and the test has to be spelled out.  With the type ``given`` of the value, numbers and
    times must also come back unchanged when cast back, so 1.9 does not fit a whole number.
    """
    ansi = spark.conf.get("spark.sql.ansi.enabled") == "true"
    fitted = value.cast(data_type) if ansi else value.try_cast(data_type)
    unfit = F.lit(False) if ansi else value.isNotNull() & fitted.isNull()
    if given is not None and _may_lose(given, data_type):
        unfit = unfit | ~value.eqNullSafe(fitted.try_cast(given))
    elif ansi:
        return fitted
    refusal = F.raise_error(F.lit(f"value does not fit {data_type.simpleString()}"))
    return F.when(unfit, refusal.cast(data_type)).otherwise(fitted)
