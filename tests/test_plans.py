"""What the plans look like: no Python in them, no extra shuffles, hot keys cut up."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as checked
from tarnkeep.operators.freshness import freshness_detail, latest_log_file
from tarnkeep.operators.merge import merge_rows
from tarnkeep.functions.ages import ntz
from tarnkeep.plans.sync_log import sync_log
from workload import frames
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
LISTS_FOLDERS = {"log_file_listing", "freshness_on_mount", "freshness_on_mount_detail", "log_file_store", "log_files_since"}


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def small_skew(spark, no_broadcast):
    """Lets partitions of some kilobytes count as skewed."""
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    }
    small["spark.sql.shuffle.partitions"] = "24"
    before = {key: spark.conf.get(key) for key in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - LISTS_FOLDERS))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(checked.queries()[name](spark, SF_DIR))
    for node in ("Python", "MapInArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_the_summary_reads_no_names_and_sorts_nothing(spark, no_broadcast):
    text = plan(checked.queries()["freshness_summary"](spark, SF_DIR))
    assert "l_partkey" not in text
    assert "SortAggregate" not in text
    # files, tables, tables per item, targets, and one for each side of two small joins
    # and, for the targets' tables alone, the targets once more and a semi join
    assert text.count("Exchange hashpartitioning") <= 14


def test_files_are_shuffled_once_for_age_and_join(spark, no_broadcast):
    files = spark.createDataFrame([], "item_id long, file_name string, modified timestamp_ntz")
    tables = spark.range(10).withColumnRenamed("id", "item_id")
    joined = tables.join(latest_log_file(files, ["item_id"]), "item_id", "left")
    assert plan(joined).count("Exchange hashpartitioning") == 2


def test_merge_of_few_keys_does_not_shuffle_the_target(spark):
    target = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    text = plan(merge_rows(target.limit(5), target, "o_orderkey"))
    assert "Exchange hashpartitioning" not in text
    assert "BroadcastHashJoin" in text


def run_plan(frame, tmp_path):
    """Plan after the run, and the largest number of rows one task wrote."""
    frame.write.parquet(str(tmp_path / "out"))
    frame.collect()
    spark = frame.sparkSession
    written = spark.read.parquet(str(tmp_path / "out"))
    largest = written.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    return plan(frame), largest, written.count()


def wide(column):
    return F.sha2(column.cast("string"), 512)


def test_null_keys_of_a_merge_target_are_spread(spark, tmp_path, no_broadcast):
    target = spark.range(0, 60_000, 1, 12).select(
        F.when(F.col("id") % 3 != 0, F.col("id")).alias("key"), wide(F.col("id")).alias("text")
    )
    source = spark.range(0, 30_000).withColumn("text", wide(F.col("id")))
    source = source.withColumnRenamed("id", "key")
    merged = merge_rows(source, target, "key").filter("key IS NULL")
    spread = merged.groupBy(F.spark_partition_id()).count().collect()
    assert sum(row["count"] for row in spread) == 20_000
    assert max(row["count"] for row in spread) < 10_000


def test_a_hot_key_of_a_merge_target_is_cut_up(spark, tmp_path, small_skew):
    target = spark.range(0, 60_000, 1, 12).select(
        F.when(F.col("id") % 3 != 0, F.col("id")).otherwise(-5).alias("key"),
        wide(F.col("id")).alias("text"),
    )
    source = spark.range(0, 3_000).withColumn("text", wide(F.col("id")))
    source = source.withColumnRenamed("id", "key")
    text, largest, rows = run_plan(merge_rows(source, target, "key"), tmp_path)
    assert "SortMergeJoin(skew=true)" in text
    assert rows == 60_000 + 1_000
    assert largest < 10_000


def test_an_item_with_a_third_of_all_tables_is_cut_up(spark, tmp_path, small_skew):
    ages = spark.range(0, 60_000, 1, 12).select(
        F.when(F.col("id") % 3 != 0, F.col("id") % 2_000).otherwise(-1).alias("item_id"),
        wide(F.col("id")).alias("table_path"),
        F.lit("f").alias("latest_file"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("latest_ts"),
        F.lit(1.0).alias("age_hours"),
        F.lit(False).alias("is_stale"),
        F.lit(None).cast("string").alias("error"),
    )
    targets = spark.range(-1, 2_000).select(
        F.col("id").alias("item_id"),
        F.lit("ws").alias("workspace_name"),
        wide(F.col("id")).alias("item_name"),
    )
    detail = freshness_detail(targets, ages, ntz("2024-01-02"), 24.0)
    text, largest, rows = run_plan(detail, tmp_path)
    assert "SortMergeJoin(skew=true)" in text
    assert rows == 60_000
    assert largest < 10_000


def test_replies_of_other_endpoints_are_dropped_before_parsing(spark):
    targets = spark.createDataFrame([(7, "w", "e")], "item_id long, workspace_name string, item_name string")
    replies, polls = frames.order_replies(spark, SF_DIR), frames.line_polls(spark, SF_DIR)
    log = sync_log(targets, "2001-01-01 00:00:00", responses=replies, polls=polls)
    lines = plan(log).splitlines()
    semi = [i for i, line in enumerate(lines) if "LeftSemi" in line]
    parsed = [i for i, line in enumerate(lines) if "from_json" in line or "parse_json" in line]
    # Plans are printed from the top: what comes later is executed earlier.
    assert len(semi) == 2 and parsed and max(parsed) < max(semi) and min(parsed) < min(semi)
