"""The listing of a store against that of a mount, and what is pushed into it."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tarnkeep.plans.freshness import freshness_on_mount, freshness_on_store
from tarnkeep.sources.folders import list_log_files, list_tables
from tarnkeep.sources.store_listing import open_store, store_log_files, store_tables


def put(path, seconds, text="x"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    os.utime(path, (seconds, seconds))


@pytest.fixture
def tree(tmp_path):
    put(tmp_path / "i1/Tables/dbo/a/_delta_log/0.json", 1_000_000)
    put(tmp_path / "i1/Tables/dbo/a/_delta_log/_last_checkpoint", 2_000_000.25)
    put(tmp_path / "i1/Tables/dbo/a/_delta_log/.hidden", 2_100_000)
    put(tmp_path / "i1/Tables/dbo/a/_delta_log/empty.json", 1_500_000, "")
    put(tmp_path / "i1/Tables/dbo/a/_delta_log/sub/deep.json", 3_000_000)
    put(tmp_path / "i1/Tables/dbo/no_log/part.parquet", 5)
    put(tmp_path / "i1/Tables/_s/c d%20/_delta_log/ü.json", 7)
    put(tmp_path / "i1/Tables/dbo/loose_file", 5)
    put(tmp_path / "i1/Tables/readme", 5)
    put(tmp_path / "i2/Tables/s/b/_delta_log/1.json", 1_000_001)
    put(tmp_path / "i2/Tables/s/broken/_delta_log", 5)
    put(tmp_path / "i3/other", 5)
    put(tmp_path / "i4/Tables", 5)
    return tmp_path


ITEMS = ["i1", "i2", "i3", "i4"]


def mounted(spark, tree):
    items = spark.createDataFrame([(n, str(tree / n)) for n in ITEMS], "item_id string, item_root string")
    return list_tables(items)


def plain(frame, *columns):
    rows = frame.withColumn("failed", F.col("error").isNotNull()).select(*columns, "failed").collect()
    return sorted(map(tuple, rows), key=str)


def test_the_store_lists_what_the_mount_lists(spark, tree):
    tables = mounted(spark, tree)
    for root in (str(tree), f"file://{tree}", f"file:{tree}/"):
        names = ("item_id", "table_path")
        assert plain(store_tables(spark, root), *names) == plain(tables, *names)
    names = ("item_id", "table_path", "file_name", "modified")
    files = plain(list_log_files(tables), *names)
    failed = [(i, None, None, None, True) for i in ("i3", "i4")]
    assert plain(store_log_files(spark, str(tree)), *names) == sorted([*files, *failed], key=str)
    assert any(row[2] == ".hidden" for row in files) and any(row[2] == "empty.json" for row in files)


def test_items_that_are_asked_for(spark, tree):
    found = store_log_files(spark, str(tree), ["i2", "absent"])
    assert {(r.item_id, r.error is None) for r in found.collect()} == {("i2", True), ("i2", False), ("absent", False)}
    assert store_tables(spark, str(tree), []).collect() == []


def test_conditions_are_pushed_into_the_listing(spark, tree):
    files = store_log_files(spark, str(tree))
    since = datetime(1970, 1, 18)
    recent = files.filter((F.col("modified") >= F.lit(since)) & (F.col("item_id") == "i1"))
    assert {r.file_name for r in recent.collect()} == {"_last_checkpoint", ".hidden", "empty.json"}
    # Only that there is a time is left for Spark to ask, and the folders of other items are no partitions.
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert ">=" not in plan and "= i1" not in plan
    assert recent.rdd.getNumPartitions() == 3
    for how, expected in (
        (F.col("modified") > datetime(1970, 1, 18, 8, 40), {"_last_checkpoint", ".hidden"}),
        (F.col("modified") < datetime(1970, 1, 12, 13, 46, 41), {"0.json", "ü.json"}),
        (F.col("modified") <= datetime(1970, 1, 12, 13, 46, 41), {"0.json", "1.json", "ü.json"}),
        (F.col("modified") == datetime(1970, 1, 12, 13, 46, 41), {"1.json"}),
        (F.col("item_id").isin("i2") & (F.col("file_name") != "x"), {"1.json"}),
        (F.col("modified").isNull(), {None}),
    ):
        assert {r.file_name for r in files.filter(how).collect()} == expected


def test_freshness_without_a_mount(spark, tree):
    targets = spark.createDataFrame([(n, "WS", n) for n in ITEMS], "item_id string, workspace_name string, item_name string")
    now = "1970-02-01 00:00:00"
    for one, other in zip(
        freshness_on_store(targets, str(tree), now), freshness_on_mount(targets, str(tree), now), strict=True
    ):
        texts = [f.drop("ErrorMessage") for f in (one, other)]
        assert sorted(map(str, texts[0].collect())) == sorted(map(str, texts[1].collect()))


def test_more_entries_than_one_batch(spark, tmp_path):
    log = tmp_path / "i/Tables/s/t/_delta_log"
    log.mkdir(parents=True)
    for number in range(10_001):
        (log / f"{number:020d}.json").touch()
    assert store_log_files(spark, str(tmp_path)).count() == 10_001


def test_addresses():
    assert open_store("/a/b/")[1] == open_store("file:/a/b")[1] == open_store("file:///a/b/")[1] == "/a/b"
    with pytest.raises(Exception, match="nosuch"):
        open_store("nosuch://host/a")
