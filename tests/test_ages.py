import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from tarnkeep.functions.ages import (
    age_hours,
    fixed_point,
    ntz,
    round_half_even,
    utc_wall_time,
    without_zone,
)

NOW = datetime(2024, 5, 1)


def moments():
    rng = random.Random(7)
    ties = [timedelta(seconds=18 * n) for n in range(-1500, 1500)]
    odd = [timedelta(microseconds=rng.randrange(-(10**12), 3 * 10**13)) for _ in range(20000)]
    near = [t + timedelta(microseconds=d) for t in ties[::3] for d in (-1, 1)]
    return ties + odd + near


def test_ages_round_and_print_like_python(spark):
    deltas = moments()
    frame = spark.createDataFrame(
        [(n, NOW - delta) for n, delta in enumerate(deltas)], "n int, ts timestamp_ntz"
    )
    age = age_hours(F.col("ts"), ntz(NOW))
    rows = (
        frame.select("n", age.alias("age"))
        .select(
            "n",
            "age",
            round_half_even(F.col("age"), 2).alias("stored"),
            fixed_point(F.col("age"), 1).alias("shown"),
        )
        .collect()
    )
    assert len(rows) == len(deltas)
    for row in rows:
        expected = deltas[row.n].total_seconds() / 3600
        assert row.age == expected
        assert row.stored == round(expected, 2)
        assert row.shown == f"{expected:.1f}"


def test_rounding_of_plain_doubles(spark):
    values = [2.675, 1.005, 0.125, 0.375, -0.125, -2.675, 0.0, 1e12 + 0.125, 5.0, 0.995]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    for row in frame.select("x", round_half_even(F.col("x"), 2).alias("r")).collect():
        assert row.r == round(row.x, 2)


def test_age_ignores_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        frame = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-10 01:00:00' AS ts")
        age = frame.select(age_hours(F.col("ts"), ntz("2024-03-10 03:00:00"))).first()[0]
        assert age == 2.0
        utc = spark.sql("SELECT timestamp_micros(1704067200123456) AS ts")
        assert without_zone(utc, "ts").first().ts == datetime(2024, 1, 1, 0, 0, 0, 123456)
        assert without_zone(frame, "ts") is frame
        wall = utc.select(utc_wall_time(F.col("ts"))).first()[0]
        assert wall == datetime(2024, 1, 1, 0, 0, 0, 123456)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_moments(spark):
    zoned = datetime(2024, 5, 1, 14, tzinfo=timezone(timedelta(hours=2)))
    one = spark.range(1)
    assert one.select(ntz(zoned)).first()[0] == datetime(2024, 5, 1, 12)
    assert one.select(ntz("2024-05-01 12:00:00.5")).first()[0].microsecond == 500_000
    now = one.select(ntz(None)).first()[0]
    assert abs(now - datetime.now(timezone.utc).replace(tzinfo=None)) < timedelta(minutes=1)
