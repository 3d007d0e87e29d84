"""Runs that are appended twice, fail half-way, or are killed."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarnkeep.sinks import run_log
from tarnkeep.sinks.run_log import append_run, read_run_log

SCHEMA = StructType().add("id", "long").add("Status", "string")


def rows(spark, n):
    return spark.range(n).select("id", F.lit("done").alias("Status")).repartition(4)


def logged(spark, path):
    return {r.run: r["count"] for r in read_run_log(spark, path, SCHEMA).groupBy("run").count().collect()}


def test_a_run_is_logged_once(spark, tmp_path):
    path = f"file://{tmp_path}/log"
    append_run(rows(spark, 10), path, "2024-05-01 12:00:00")
    append_run(rows(spark, 99), path, "2024-05-01 12:00:00")
    append_run(rows(spark, 5), path, "a/b=c %")
    assert logged(spark, path) == {"2024-05-01 12:00:00": 10, "a/b=c %": 5}
    held = read_run_log(spark, path, SCHEMA).filter("run = 'a/b=c %'").orderBy("id").collect()
    assert [tuple(r) for r in held] == [(i, "done", "a/b=c %") for i in range(5)]
    assert len(os.listdir(tmp_path / "log")) == 2


def test_a_run_that_fails_half_way_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "log")
    failing = rows(spark, 100).withColumn("Status", F.when(F.col("id") < 60, "ok").otherwise(F.raise_error(F.lit("lost"))))
    with pytest.raises(Exception, match="lost"):
        append_run(failing, path, "r")
    assert not os.path.exists(path) or os.listdir(path) == []
    append_run(rows(spark, 100), path, "r")
    assert logged(spark, path) == {"r": 100}


def test_what_a_killed_attempt_left_is_not_read_and_goes(spark, tmp_path):
    path = str(tmp_path / "log")
    append_run(rows(spark, 3), path, "one")
    left = tmp_path / "log" / f"_{'0' * 32}-two"
    os.makedirs(left)
    (left / "x.parquet").write_text("no parquet")
    os.makedirs(tmp_path / "log" / f"_{'1' * 32}-other-two")
    assert logged(spark, path) == {"one": 3}
    append_run(rows(spark, 4), path, "two")
    assert logged(spark, path) == {"one": 3, "two": 4}
    assert not left.exists()
    assert (tmp_path / "log" / f"_{'1' * 32}-other-two").exists()


def test_files_of_repeated_tasks_are_left_out(spark, tmp_path):
    writer = run_log._Writer(str(tmp_path / "log"), "r")
    batches = rows(spark, 7).toArrow().to_batches()
    first, again = writer.write(iter(batches)), writer.write(iter(batches))
    assert first.name != again.name
    writer.commit([again, run_log.WrittenFile(None, 0), None])
    assert logged(spark, str(tmp_path / "log")) == {"r": 7}


def test_an_attempt_that_comes_second_gives_way(spark, tmp_path):
    path = str(tmp_path / "log")
    batches = rows(spark, 7).toArrow().to_batches()
    one, other = run_log._Writer(path, "r"), run_log._Writer(path, "r")
    messages = [one.write(iter(batches))], [other.write(iter(batches[:1]))]
    one._clear = lambda *arguments: None
    one.commit(messages[0])
    other.commit(messages[1])
    assert logged(spark, path) == {"r": 7}
    assert len(os.listdir(path)) == 1


def test_a_run_without_rows(spark, tmp_path):
    path = str(tmp_path / "log")
    append_run(rows(spark, 0), path, "none")
    append_run(rows(spark, 9), path, "none")
    assert logged(spark, path) == {}
    with pytest.raises(Exception, match="names the folders"):
        append_run(rows(spark, 1).withColumn("run", F.lit(1)), path, "x")
