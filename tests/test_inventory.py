import json

import pytest
from pyspark.sql import functions as F

from tarnkeep.functions.names import env_suffix, workspace_pattern
from tarnkeep.operators.inventory import (
    current_suffix,
    pick_monitor_db,
    select_targets,
    select_workspaces,
)
from tarnkeep.plans.sync_log import sync_targets
from tarnkeep.sources.service_lists import items_from, workspaces_from
from tarnkeep.sources.tables import tables_from_paths


def test_env_suffix(spark):
    names = {"WS_A_dev": "_dev", "plain": "", "ends_": "_", "_x": "_x", "a_b_c": "_c"}
    frame = spark.createDataFrame([(n,) for n in names], "name string")
    rows = frame.select("name", env_suffix(F.col("name")).alias("s")).collect()
    assert {row.name: row.s for row in rows} == names


def test_current_suffix(spark):
    frame = spark.createDataFrame(
        [("a", "WS_X_dev"), ("b", "WS_Y_prod")], "workspace_id string, workspace_name string"
    )
    assert current_suffix(frame, "b").first().suffix == "_prod"


def test_domains_are_patterns_and_the_suffix_is_text(spark):
    assert workspace_pattern(["A", "B.*"], "_x+y") == r"^WS_(A|B.*)_x\+y$"
    frame = spark.createDataFrame(
        [(n,) for n in ["WS_A_x+y", "ws_bcd_X+Y", "WS_A_xxy", "WS_C_x+y", "aWS_A_x+y"]],
        "workspace_name string",
    )
    chosen = select_workspaces(frame, ["A", "B.*"], "_x+y").collect()
    assert {row.workspace_name for row in chosen} == {"WS_A_x+y", "ws_bcd_X+Y"}


def test_a_failed_listing_does_not_stop_the_others(spark):
    workspaces = spark.createDataFrame(
        [(1, "one"), (2, "two")], "workspace_id int, workspace_name string"
    )
    items = spark.createDataFrame(
        [(1, None, None, None, "403"), (2, 5, "SQLEndpoint", "lh_a_b", None)],
        "workspace_id int, item_id int, item_type string, item_name string, error string",
    )
    rows = select_targets(workspaces, items, "SQLEndpoint", "^LH_[^_]+_[^_]+$").collect()
    assert [(row.workspace_name, row.item_id) for row in rows] == [("two", 5)]


@pytest.mark.parametrize(
    "names, expected",
    [
        (["ProcessDB_x", "ProcessDB1", "ProcessDB2"], "ProcessDB1"),
        (["Other", "xProcessDB"], None),
        (["processdb"], None),
        ([], None),
    ],
)
def test_pick_monitor_db(spark, names, expected):
    value = [
        {"displayName": n, "properties": {"serverFqdn": "h,1433", "databaseName": f"db {n}"}}
        for n in names
    ]
    frame = spark.createDataFrame(
        [(1, json.dumps({"value": value}))], "workspace_id int, body string"
    )
    row = pick_monitor_db(frame).first()
    assert row.display_name == expected
    assert row.server == (None if expected is None else "h:1433")
    assert row.database_name == (None if expected is None else f"db {expected}")


def test_monitor_db_defaults(spark):
    bodies = ['{"value": [{"displayName": "ProcessDB"}]}', "{}", "not json"]
    frame = spark.createDataFrame(list(enumerate(bodies)), "workspace_id int, body string")
    rows = {row.workspace_id: row for row in pick_monitor_db(frame).collect()}
    assert (rows[0].server, rows[0].database_name) == ("", None)
    assert (rows[1].display_name, rows[2].display_name) == (None, None)


def test_tables_from_paths(spark):
    listing = [
        ("i", "Tables/dbo", True),
        ("i", "Tables/dbo/a", True),
        ("i", "i/Tables/dbo/b", True),
        ("i", "Tables/dbo/file", False),
        ("i", "Tables/dbo/c/_delta_log/0.json", False),
        ("i", "Tables/dbo/c/part.parquet", False),
        ("i", "Files/dbo/d", True),
        ("j", "j/Tables/j/Tables", True),
    ]
    frame = spark.createDataFrame(listing, "item_id string, path string, is_directory boolean")
    rows = {(row.item_id, row.table_path) for row in tables_from_paths(frame).collect()}
    assert rows == {
        ("i", "Tables/dbo/a"),
        ("i", "Tables/dbo/b"),
        ("i", "Tables/dbo/c"),
        ("j", "Tables/j/Tables"),
    }


def test_service_lists(spark):
    listed = spark.createDataFrame([("w1", "WS_A_dev")], "Id string, Name string")
    items = spark.createDataFrame(
        [("i1", "SQLEndpoint", "LH_a_b", "w1"), ("i2", "Report", "LH_a_b", "w1")],
        "Id string, Type string, `Display Name` string, workspace string",
    )
    targets = sync_targets(
        workspaces_from(listed), items_from(items, "workspace"), ["A"], "_dev"
    )
    assert [tuple(row) for row in targets.collect()] == [("w1", "WS_A_dev", "i1", "LH_a_b")]
