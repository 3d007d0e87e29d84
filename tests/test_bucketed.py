"""Merges into tables laid out by key: rows, files that stay, plans, and merges that were cut off."""

import os

import pytest
from pyspark.sql import functions as F

from tarnkeep.plans.load import load
from tarnkeep.sinks import bucketed
from tarnkeep.sinks.bucketed import SLOT, BucketedTarget
from tarnkeep.sinks.targets import table_folder
from tarnkeep.storage import Storage

SCHEMA = "id long, part string, amount int"


@pytest.fixture
def target(spark, tmp_path):
    made = BucketedTarget(f"bucketed_{abs(hash(str(tmp_path)))}", "id", slots=16, buckets=4)
    rows = spark.range(400).select("id", F.lit("old").alias("part"), F.lit(1).alias("amount"))
    nulls = spark.createDataFrame([(None, "null", i) for i in range(30)], SCHEMA)
    load(rows.unionAll(nulls), made, "append")
    return made


def files(spark, target):
    """Names of all files by slot."""
    folder = table_folder(spark, target.name).removeprefix("file:")
    return {
        slot: {n for n in os.listdir(f"{folder}/{slot}") if n.endswith(".parquet")}
        for slot in os.listdir(folder)
        if "=" in slot
    }


def held(spark, target):
    return sorted(map(tuple, target.read(spark).collect()), key=str)


def merged(spark, target, source):
    keys = {r.id for r in source.collect()} - {None}
    rows = [tuple(r) for r in target.read(spark).collect() if r.id not in keys]
    return sorted(rows + [tuple(r) for r in source.collect()], key=str)


def test_a_merge_leaves_files_of_other_slots(spark, target):
    source = spark.createDataFrame([(5, "new", 50), (6, "new", 60), (None, "null", 99)], SCHEMA)
    expected, before = merged(spark, target, source), files(spark, target)
    load(source, target, "merge", key="id")
    after = files(spark, target)
    assert held(spark, target) == expected
    rewritten = {slot for slot in before if not before[slot] <= after[slot]}
    touched = spark.table(target.name).filter("id IN (5, 6)").select(SLOT).distinct().collect()
    assert rewritten == {f"{SLOT}={r[0]}" for r in touched} and len(rewritten) <= 2
    columns = spark.catalog.listColumns(target.name)
    assert {c.name for c in columns if c.isBucket} == {"id"}


def test_keys_without_a_match_are_only_appended(spark, target):
    source = spark.range(1_000, 1_050).select("id", F.lit("new").alias("part"), F.lit(2).alias("amount"))
    expected, before = merged(spark, target, source), files(spark, target)
    load(source, target, "merge", key="id")
    after = files(spark, target)
    assert held(spark, target) == expected
    assert all(before[slot] <= after[slot] for slot in before)


def test_the_target_is_not_shuffled(spark, target, monkeypatch):
    plans = []
    real = BucketedTarget._save

    def watched(self, frame, name, mode, measures=()):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return real(self, frame, name, mode, measures)

    monkeypatch.setattr(BucketedTarget, "_save", watched)
    source = spark.range(0, 800, 2).select("id", F.lit("new").alias("part"), F.lit(2).alias("amount"))
    expected = merged(spark, target, source)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target.merge_rows(source)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert held(spark, target) == expected
    plan = plans[0]
    assert "LeftAnti" in plan and "SelectedBucketsCount: 4 out of 4" in plan
    left = plan[plan.index("LeftAnti") :].split("Exchange")[0]
    assert "FileScan" in left and target.name in left


def test_large_buckets_are_joined_by_several_tasks(spark, target, monkeypatch):
    tasks = []
    real = BucketedTarget._save

    def watched(self, frame, name, mode, measures=()):
        tasks.append(frame.rdd.getNumPartitions())
        return real(self, frame, name, mode, measures)

    monkeypatch.setattr(BucketedTarget, "_save", watched)
    monkeypatch.setattr(bucketed, "ROWS_TOGETHER", 40, raising=False)
    source = spark.range(0, 800, 2).select("id", F.lit("new").alias("part"), F.lit(2).alias("amount"))
    expected = merged(spark, target, source)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target.merge_rows(source)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert held(spark, target) == expected
    # 400 rows on either side; three tasks for each of four buckets.
    assert tasks[0] == 24
    # Each file has the rows of its bucket, by which Spark finds a key.
    for key in (0, 7, 398, 798):
        assert spark.table(target.name).filter(F.col("id") == key).count() == 1


def test_full_loads_and_first_loads(spark, tmp_path):
    made = BucketedTarget(f"fresh_{abs(hash(str(tmp_path)))}", "id", slots=8, buckets=2)
    rows = spark.range(50).select("id", F.lit("a").alias("part"), F.lit(1).alias("amount"))
    load(rows, made, "merge", key="id", check="content")
    assert made.read(spark).count() == 50
    load(rows.withColumn("amount", F.lit(3)), made, "fullload", check="content")
    assert made.read(spark).filter("amount = 3").count() == 50
    load(rows.limit(0), made, "append")
    assert "Buckets" in str(spark.sql(f"DESCRIBE EXTENDED {made.name}").collect())
    with pytest.raises(ValueError, match="laid out by id"):
        load(rows, made, "merge", key="amount")


@pytest.mark.parametrize("count", range(1, 9))
def test_a_merge_cut_off_at_any_rename(spark, target, monkeypatch, count):
    source = spark.createDataFrame([(i, "new", i) for i in (1, 2, 3, 50, 700)] + [(None, "null", 7)], SCHEMA)
    before, expected = held(spark, target), merged(spark, target, source)
    replaced = {1, 2, 3, 50}
    real, calls = Storage.rename, []

    def failing(self, *names):
        calls.append(names)
        if len(calls) >= count:
            raise RuntimeError("cut off")
        return real(self, *names)

    with monkeypatch.context() as patch:
        patch.setattr(Storage, "rename", failing)
        try:
            load(source, target, "merge", key="id", stored_source=True)
        except RuntimeError:
            pass
    target.recover(spark)
    half = sorted([r for r in before if r[0] not in replaced] + [r for r in expected if r[0] in replaced], key=str)
    assert held(spark, target) in (before, half, expected)
    if held(spark, target) != expected:
        load(source, target, "merge", key="id")
        assert held(spark, target) == expected
