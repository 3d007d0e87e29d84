"""Ages and their rounding as Column expressions.

An age is ``now - ts`` in hours.  The difference is taken between two
``TIMESTAMP_NTZ`` values, so the session time zone never enters.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

_SPLITTER = 134217729.0  # 2**27 + 1: cuts a double into two halves of at most 26 bits


def ntz(moment: datetime | str | Column | None) -> Column:
    """A ``TIMESTAMP_NTZ`` column from a UTC time, from an existing column, or of right now.

    Now is read once, on the driver, so that everything made from it carries the same time.
    """
    if isinstance(moment, Column):
        return moment
    if moment is None:
        moment = datetime.now(timezone.utc)
    if isinstance(moment, datetime):
        if moment.tzinfo is not None:
            moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
        moment = moment.isoformat(sep=" ")
    return F.lit(moment).cast("timestamp_ntz")


def utc_wall_time(ts: Column) -> Column:
    """UTC wall-clock time of a zoned ``TIMESTAMP``, whatever the session zone is."""
    seconds = F.unix_micros(ts).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")
    since_epoch = F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    return F.lit("1970-01-01").cast("timestamp_ntz") + since_epoch


def without_zone(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` with the time column ``name`` as UTC wall-clock time, if it has a zone."""
    if frame.schema[name].dataType != TimestampType():
        return frame
    return frame.withColumn(name, utc_wall_time(F.col(name)))


def age_hours(ts: Column, now: Column) -> Column:
    """Hours from ``ts`` to ``now`` as an unrounded double; negative for a future ``ts``."""
    seconds = (now - ts).cast("decimal(18,6)").cast("double")
    return seconds / F.lit(3600.0)


def _nearest_unit(x: Column, unit: float) -> Column:
    # floor(x * unit) may be off by the rounding of the product, so the distance to the
    # halfway point is computed exactly: both halves of x times unit fit in a double.
    scaled = F.floor(x * unit)
    big = x * _SPLITTER
    high = big - (big - x)
    low = x - high
    past_half = (high * unit - (scaled + F.lit(0.5))) + low * unit
    tie_up = (past_half == 0) & (F.abs(scaled % 2) == 1)
    return scaled + F.when((past_half > 0) | tie_up, 1).otherwise(0)


def round_half_even(x: Column, digits: int) -> Column:
    """Round the exact value of a double, ties to even, for magnitudes below 1e13.

    Spark's ``round`` and ``bround`` work on the shortest decimal text of the double
    instead, which gives another answer for values such as 2.675.
    """
    unit = float(10**digits)
    return _nearest_unit(x, unit).cast("double") / F.lit(unit)


def fixed_point(x: Column, digits: int) -> Column:
    """Text of ``x`` with exactly ``digits`` (at least 1) decimals, rounded as above."""
    units = F.abs(_nearest_unit(x, float(10**digits)))
    scale = 10**digits
    whole = F.floor(units / scale).cast("string")
    decimals = F.lpad((units % scale).cast("string"), digits, "0")
    return F.concat(F.when(x < 0, "-").otherwise(""), whole, F.lit("."), decimals)
