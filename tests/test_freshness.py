import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tarnkeep.operators.freshness import advance_latest, latest_log_file, table_lines, warehouse_lines
from tarnkeep.plans.freshness import (
    freshness,
    freshness_incremental,
    log_freshness,
    seen_until,
    warehouse_targets,
)
from tarnkeep.sinks.log_tables import append_log, jdbc_options, not_yet_logged
from tarnkeep.sinks.targets import PathTarget

NOW = datetime(2024, 5, 1, 12)
WORKSPACES = [
    (1, "WS_SALES_dev"),
    (2, "ws_finance_dev"),
    (3, "WS_SALES_prod"),
    (4, "xWS_SALES_dev"),
]
ITEMS = [
    (1, 10, "Warehouse", "WH_core_main"),
    (1, 11, "Warehouse", "wh_empty_one"),
    (2, 12, "Warehouse", "WH_no_logs"),
    (2, 13, "warehouse", "WH_lower_type"),
    (2, 14, "Warehouse", "WH_a_b_c"),
    (2, 15, "Warehouse", "WH_a"),
    (3, 16, "Warehouse", "WH_other_env"),
    (2, 17, "Warehouse", "WH_all_stale"),
    (4, 18, "Warehouse", "WH_prefix_before"),
]


def before(**delta):
    return NOW - timedelta(**delta)


FILES = [
    (10, "Tables/s/zero", "a", before(), None),
    (10, "Tables/s/limit", "a", before(hours=24), None),
    (10, "Tables/s/over", "a", before(hours=24, microseconds=1), None),
    (10, "Tables/s/future", "a", before(hours=-3), None),
    (10, "Tables/s/tie", "b", before(hours=5), None),
    (10, "Tables/s/tie", "a", before(hours=5), None),
    (10, "Tables/s/tie", "0", before(hours=6), None),
    (10, "Tables/s/failed", None, None, "E" * 300),
    (17, "Tables/s/old", "a", before(days=9), None),
    (16, "Tables/s/elsewhere", "a", before(days=9), None),
]
TABLES = sorted({row[:2] for row in FILES} | {(12, "Tables/s/bare")})


@pytest.fixture(scope="module")
def result(spark):
    return run(spark)


def run(spark, **how):
    targets = warehouse_targets(
        spark.createDataFrame(WORKSPACES, "workspace_id int, workspace_name string"),
        spark.createDataFrame(
            ITEMS, "workspace_id int, item_id int, item_type string, item_name string"
        ),
        ["FINANCE", "SALES"],
        "_dev",
    )
    tables = spark.createDataFrame(TABLES, "item_id int, table_path string")
    return freshness(targets, tables, files(spark), NOW, **how)


def files(spark):
    return spark.createDataFrame(
        FILES,
        "item_id int, table_path string, file_name string, modified timestamp_ntz, error string",
    )


def test_detail_rows(result):
    rows = {row.TablePath.split("/")[-1]: row for row in result[0].collect()}
    assert set(rows) == {"zero", "limit", "over", "future", "tie", "failed", "old", "bare"}
    ages = {name: (row.AgeHours, row.IsStale) for name, row in rows.items()}
    assert ages == {
        "zero": (None, False),
        "limit": (24.0, False),
        "over": (24.0, True),
        "future": (-3.0, False),
        "tie": (5.0, False),
        "failed": (None, False),
        "old": (216.0, True),
        "bare": (None, False),
    }
    assert rows["tie"].LatestLogFile == "a"
    assert rows["zero"].LatestLogTs == NOW
    assert rows["failed"].ErrorMessage == "E" * 200
    assert rows["failed"].LatestLogFile is None
    assert {row.RunTs for row in rows.values()} == {NOW}
    assert {row.ThresholdHours for row in rows.values()} == {24.0}


def test_summary_rows(result):
    rows = {row.WarehouseName: row for row in result[1].collect()}
    assert set(rows) == {"WH_core_main", "wh_empty_one", "WH_no_logs", "WH_all_stale"}

    def numbers(name):
        row = rows[name]
        return (
            row.TotalTables,
            row.TablesWithDeltaLog,
            row.StaleTables,
            row.MaxAgeHours,
            row.MinAgeHours,
            row.IsPublishingBroken,
        )

    assert numbers("WH_core_main") == (6, 5, 1, 24.0, -3.0, False)
    assert numbers("wh_empty_one") == (0, 0, 0, None, None, None)
    assert numbers("WH_no_logs") == (1, 0, 0, None, None, None)
    assert numbers("WH_all_stale") == (1, 1, 1, 216.0, 216.0, True)
    core = rows["WH_core_main"]
    assert core.LatestDeltaLogTs == before(hours=-3)
    assert core.OldestDeltaLogTs == before(hours=24, microseconds=1)


def test_schemas_of_the_logs(result):
    detail, summary = result
    assert detail.dtypes == [
        ("RunTs", "timestamp_ntz"),
        ("WorkspaceName", "string"),
        ("WarehouseName", "string"),
        ("TablePath", "string"),
        ("LatestLogFile", "string"),
        ("LatestLogTs", "timestamp_ntz"),
        ("AgeHours", "double"),
        ("ThresholdHours", "double"),
        ("IsStale", "boolean"),
        ("ErrorMessage", "string"),
    ]
    assert summary.dtypes == [
        ("RunTs", "timestamp_ntz"),
        ("WorkspaceName", "string"),
        ("WarehouseName", "string"),
        ("TotalTables", "int"),
        ("TablesWithDeltaLog", "int"),
        ("StaleTables", "int"),
        ("LatestDeltaLogTs", "timestamp_ntz"),
        ("OldestDeltaLogTs", "timestamp_ntz"),
        ("MaxAgeHours", "double"),
        ("MinAgeHours", "double"),
        ("ThresholdHours", "double"),
        ("IsPublishingBroken", "boolean"),
    ]


def test_only_age_zero_is_no_greatest_age(spark):
    frame = spark.createDataFrame(
        [(1, "t", "f", before(seconds=3))],
        "item_id int, table_path string, file_name string, modified timestamp_ntz",
    )
    from tarnkeep.functions.ages import ntz
    from tarnkeep.operators.freshness import freshness_summary, table_ages

    ages = table_ages(frame.select("item_id", "table_path"), frame, ntz(NOW))
    assert ages.first().age_hours == 0.0
    targets = spark.createDataFrame(
        [(1, "ws", "wh")], "item_id int, workspace_name string, item_name string"
    )
    row = freshness_summary(targets, ages, ntz(NOW), 24.0).first()
    assert (row.TablesWithDeltaLog, row.MaxAgeHours, row.IsPublishingBroken) == (1, None, False)


def test_lines(spark, result):
    lines = {row.WarehouseName: row.line for row in warehouse_lines(result[1]).collect()}
    assert lines == {
        "WH_core_main": "🟢 healthy — 1/5 stale  max age 24.0h",
        "wh_empty_one": "🟢 healthy — 0/0 stale  max age Noneh",
        "WH_no_logs": "🟢 healthy — 0/0 stale  max age Noneh",
        "WH_all_stale": "🔴 PUBLISHING BROKEN — 1/1 stale  max age 216.0h",
    }
    long_path = "Tables/s/" + "x" * 70
    ages = spark.createDataFrame(
        [
            (1, "Tables/s/t", 30.26, True, None),
            (2, long_path, -0.01, False, None),
            (3, "Tables/s/t", None, False, None),
            (4, "Tables/s/t", None, False, "denied"),
        ],
        "item_id int, table_path string, age double, is_stale boolean, error string",
    )
    shown = {row.item_id: row.line for row in table_lines(ages).collect()}
    padded = f"{'Tables/s/t':<60}"
    assert shown == {
        1: f"🔴  {padded}  30.3h",
        2: f"🟢  {long_path}  -0.0h",
        3: f"🟢  {padded}  no log",
        4: f"🟢  {padded}  denied",
    }


def test_kept_ages_give_the_same_rows(spark, result):
    kept = run(spark, keep=True)
    for one, other in zip(kept, result):
        assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))


def test_latest_of_a_table_that_owns_most_files(spark):
    hot = spark.range(0, 200_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("item_id"),
        F.format_string("%020d.json", "id").alias("file_name"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs="id")).alias(
            "modified"
        ),
    )
    row = latest_log_file(hot, ["item_id"]).filter("item_id = 0").first()
    assert row.latest_file == f"{199_998:020d}.json"


def test_log_append(spark, result, tmp_path):
    def append(rows, log_name):
        append_log(rows, "parquet", path=str(tmp_path / log_name))

    for _ in range(2):
        log_freshness(*result, append)
    assert spark.read.parquet(str(tmp_path / "detail")).count() == 2 * result[0].count()
    assert spark.read.parquet(str(tmp_path / "summary")).count() == 2 * result[1].count()


def test_completing_a_log(spark, result, tmp_path):
    log = str(tmp_path / "log")
    append_log(result[0].filter("IsStale"), "parquet", path=log)
    keys = ["RunTs", "WorkspaceName", "WarehouseName", "TablePath"]
    rest = not_yet_logged(result[0], spark.read.parquet(log), keys)
    append_log(rest, "parquet", path=log)
    logged = spark.read.parquet(log)
    assert sorted(map(str, logged.collect())) == sorted(map(str, result[0].collect()))


def test_jdbc_options():
    options = jdbc_options("jdbc:x://host", "Log.Detail", driver="x.Driver", connections=4)
    assert options == {
        "url": "jdbc:x://host",
        "dbtable": "Log.Detail",
        "driver": "x.Driver",
        "numPartitions": "4",
        "batchsize": "10000",
    }


@pytest.mark.parametrize("seed", range(3))
def test_any_split_of_the_files_gives_the_full_state(spark, seed):
    pick = random.Random(seed)
    kinds = "item_id int, table_path string, file_name string, modified timestamp_ntz, error string"
    start = datetime(2024, 1, 1)
    rows = [
        (pick.randint(0, 2), pick.choice("ab"), f"{pick.randint(0, 9)}.json", start + timedelta(hours=pick.randint(0, 3)), None)
        for _ in range(60)
    ]
    rows += [(0, "a", None, None, "not readable"), (5, "c", None, None, "not readable")]
    keys = ["item_id", "table_path"]
    whole = latest_log_file(spark.createDataFrame(rows, kinds), keys).select(*keys, "latest_file", "latest_ts")
    expected = sorted(map(tuple, whole.filter("latest_ts IS NOT NULL").collect()))
    state = whole.limit(0)
    pick.shuffle(rows)
    parts = [rows[:7], rows[7:7], rows[5:40], rows[40:]]
    for part in parts:
        held = advance_latest(state, spark.createDataFrame(part, kinds), keys).collect()
        state = spark.createDataFrame(held, whole.schema)
    assert sorted(map(tuple, state.collect())) == expected


def test_incremental_runs_equal_one_full_run(spark, tmp_path):
    kinds = "item_id int, table_path string, file_name string, modified timestamp_ntz, error string"
    targets = spark.createDataFrame([(1, "WS", "one"), (2, "WS", "two")], "item_id int, workspace_name string, item_name string")
    tables = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "item_id int, table_path string")
    day = datetime(2024, 1, 1)
    runs = [
        [(1, "a", "1", day, None), (1, "b", None, None, "denied")],
        [],
        [(1, "a", "0", day, None), (1, "b", "5", day + timedelta(hours=30), None), (9, "z", "1", day, None)],
    ]
    state = PathTarget(str(tmp_path / "state"))
    now = day + timedelta(hours=36)
    assert seen_until(state, spark) is None
    for files in runs:
        got = freshness_incremental(targets, tables, spark.createDataFrame(files, kinds), state, now)
    every = spark.createDataFrame([f for files in runs for f in files if f[2]], kinds)
    for one, other in zip(got, freshness(targets, tables, every, now), strict=True):
        assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))
    assert seen_until(state, spark) == day + timedelta(hours=30)
    errors = freshness_incremental(targets, tables, spark.createDataFrame(runs[0], kinds), state, now)[0]
    assert {r.TablePath: r.ErrorMessage for r in errors.collect()} == {"a": None, "b": "denied", "c": None}
