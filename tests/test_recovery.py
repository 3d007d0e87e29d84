"""Writes that were cut off: what they leave behind, and the next load."""

import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from tarnkeep.plans.load import LoadRejected, load
from tarnkeep.sinks import targets
from tarnkeep.sinks.targets import PathTarget, TableTarget, table_folder
from tarnkeep.storage import Storage

SCHEMA = "id long, part string, amount int"
ROWS = [(1, "a", 1), (2, "a", 2), (3, "b", 3), (4, None, 4), (7, "c/d:e", 7)]


class CutOff(Exception):
    pass


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def held(target, spark):
    return sorted((tuple(r) for r in target.read(spark).select("id", "part", "amount").collect()), key=str)


@pytest.fixture(params=["path", "table"])
def parted(request, spark, tmp_path):
    """A partitioned target with rows, and its folder."""
    if request.param == "path":
        target = PathTarget(str(tmp_path / "t"), partition_by=("part",))
        folder = target.path
    else:
        target = TableTarget(f"cut_off_{abs(hash(str(tmp_path)))}", partition_by=("part",))
        folder = table_folder(spark, target.name).removeprefix("file:")
    load(frame(spark, ROWS), target, "append")
    return target, folder


def beside(folder):
    """Names of what is beside the target's folder and belongs to it."""
    name = os.path.basename(folder)
    return sorted(n for n in os.listdir(os.path.dirname(folder)) if n.startswith(name + "__"))


def cut_at(monkeypatch, step, count):
    """Let the ``count``-th call of a file operation, and all later ones, fail."""
    real, calls = getattr(Storage, step), []

    def failing(self, *arguments):
        calls.append(arguments)
        if len(calls) >= count:
            raise CutOff(step)
        return real(self, *arguments)

    monkeypatch.setattr(Storage, step, failing)


MERGED = [(1, "a", 10), (3, "b", 30), (4, None, 40), (7, "c/d:e", 70), (9, "n", 90)]
AFTER = sorted([*MERGED, (2, "a", 2)], key=str)


@pytest.mark.parametrize("count", range(1, 12))
def test_an_exchange_cut_off_at_any_rename(spark, parted, monkeypatch, count):
    target, folder = parted
    with monkeypatch.context() as patch:
        cut_at(patch, "rename", count)
        try:
            load(frame(spark, MERGED), target, "merge", key="id", stored_source=True)
        except CutOff:
            pass
    target.recover(spark)
    # All of the merge once its list is there, that is after the first rename; nothing before.
    assert held(target, spark) == (sorted(ROWS, key=str) if count == 1 else AFTER)
    assert beside(folder) == []
    load(frame(spark, MERGED), target, "merge", key="id")
    assert held(target, spark) == AFTER
    columns = [c.name for c in spark.catalog.listColumns(target.name) if c.isPartition] if isinstance(target, TableTarget) else ["part"]
    assert columns == ["part"]


@pytest.mark.parametrize(("step", "count"), [("rename", 1), ("rename", 2), ("delete", 1), ("delete", 2), ("write_text", 2)])
def test_a_full_load_cut_off_at_any_step(spark, parted, monkeypatch, step, count):
    target, folder = parted
    with monkeypatch.context() as patch:
        cut_at(patch, step, count)
        with pytest.raises(CutOff):
            load(frame(spark, AFTER), target, "fullload")
    target.recover(spark)
    assert held(target, spark) in (sorted(ROWS, key=str), AFTER)
    assert beside(folder) == []
    load(frame(spark, AFTER), target, "fullload")
    assert held(target, spark) == AFTER
    assert sorted(n for n in os.listdir(folder) if n.startswith("_s")) in ([], ["_schema.json"])


def test_a_half_written_exchange_is_dropped(spark, parted):
    target, folder = parted
    os.makedirs(f"{folder}__exchange/part=a")
    shutil.copy(os.path.join(folder, "part=b", os.listdir(f"{folder}/part=b")[0]), f"{folder}__exchange/part=a/x.parquet")
    with open(f"{folder}__exchange/{targets.EXCHANGE_FILE}.new", "w") as file:
        file.write('["/part=')
    os.makedirs(f"{folder}__staged/part=zzz")
    load(frame(spark, []), target, "append")
    assert held(target, spark) == sorted(ROWS, key=str)
    assert beside(folder) == []


def test_an_exchange_with_a_list_is_carried_on(spark, parted):
    target, folder = parted
    frame(spark, [(1, "a", 100)]).write.partitionBy("part").parquet(f"{folder}__exchange")
    with open(f"{folder}__exchange/{targets.EXCHANGE_FILE}", "w") as file:
        json.dump(["/part=a", "/part=gone"], file)
    os.makedirs(f"{folder}__replaced")
    shutil.move(f"{folder}/part=a", f"{folder}__replaced/part=a")
    load(frame(spark, []), target, "append")
    assert held(target, spark) == sorted([(1, "a", 100), *ROWS[2:]], key=str)
    assert beside(folder) == []


def test_files_left_in_the_folder_of_a_table(spark, tmp_path):
    target = TableTarget(f"left_{abs(hash(str(tmp_path)))}", partition_by=("part",))
    load(frame(spark, ROWS), target, "append")
    folder = table_folder(spark, target.name).removeprefix("file:")
    load(frame(spark, ROWS), target, "fullload")
    with open(f"{folder}/_left", "w") as file:
        file.write("x")
    load(frame(spark, AFTER), target, "fullload")
    assert held(target, spark) == AFTER


def test_a_replaced_table_keeps_its_properties(spark, tmp_path):
    name = f"properties_{abs(hash(str(tmp_path)))}"
    spark.sql(f"CREATE TABLE {name} ({SCHEMA}) USING parquet PARTITIONED BY (part) TBLPROPERTIES ('team' = 'me')")
    target = TableTarget(name)
    load(frame(spark, ROWS), target, "fullload")
    load(frame(spark, [(3, "b", 30)]), target, "merge", key="id")
    load(frame(spark, AFTER), target, "fullload", max_loss_pct=100)
    assert held(target, spark) == AFTER
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    assert properties["team"] == "me"


# -- proof of content ----------------------------------------------------------------------


class Swapping(PathTarget):
    """Two values change places on their way into the target."""

    def _swap(self, spark, path):
        rows = spark.read.parquet(path)
        swapped = F.when(F.col("id") == 1, 2).when(F.col("id") == 2, 1).otherwise(F.col("amount"))
        changed = spark.createDataFrame(rows.withColumn("amount", swapped).collect(), rows.schema)
        changed.write.mode("overwrite").parquet(path)

    def publish(self, spark, staged):
        self._swap(spark, staged)
        with open(f"{staged}/{targets.STAGED_FILE}", "w"):
            pass
        super().publish(spark, staged)

    def append(self, rows, measures=()):
        written = super().append(rows, measures)
        self._swap(rows.sparkSession, self.path)
        rows.sparkSession.catalog.refreshByPath(self.path)
        return written


@pytest.mark.parametrize("strategy", ["append", "fullload", "merge"])
def test_a_swapped_value_fails_the_load(spark, tmp_path, strategy):
    source = frame(spark, ROWS)
    load(source, Swapping(str(tmp_path / "unseen")), strategy, key="id")
    with pytest.raises(LoadRejected, match="does not hold what was written"):
        load(source, Swapping(str(tmp_path / "seen")), strategy, key="id", check="content")


def test_loads_with_proof(spark, tmp_path):
    for partition_by in ((), ("part",)):
        target = PathTarget(str(tmp_path / f"t{len(partition_by)}"), partition_by=partition_by)
        load(frame(spark, ROWS), target, "append", check="content")
        load(frame(spark, MERGED), target, "merge", key="id", check="content")
        assert held(target, spark) == AFTER
        load(frame(spark, [(100, "z", 1)]), target, "merge", key="id", check="content")
        load(frame(spark, ROWS * 3), target, "fullload", check="content", max_loss_pct=100)
        load(frame(spark, ROWS), target, "append", check="content")
        assert held(target, spark) == sorted(ROWS * 4, key=str)


def test_the_digest_tells_nulls_and_places_apart(spark):
    from tarnkeep.operators.digest import added, content_digest

    kinds = "a int, b int, c array<int>, d map<string, int>, e struct<x: int, y: int>"
    rows = [
        (1, None, [1, None], {"k": None}, (1, None)),
        (None, 1, [1, None], {"k": None}, (1, None)),
        (1, None, [None, 1], {"k": None}, (1, None)),
        (1, None, [1], {"k": None}, (1, None)),
        (1, None, [1, None], {"k": 0}, (1, None)),
        (1, None, [1, None], {}, (1, None)),
        (1, None, [1, None], None, (1, None)),
        (1, None, [1, None], {"k": None}, (None, 1)),
        (1, None, [1, None], {"k": None}, None),
        (1, None, [], {"k": None}, (1, None)),
        (1, None, None, {"k": None}, (1, None)),
    ]
    each = [content_digest(spark.createDataFrame([row], kinds)) for row in rows]
    assert len({d["digest1"] for d in each}) == len({d["digest2"] for d in each}) == len(rows)
    total = content_digest(None)
    for one in each:
        total = added(total, one)
    assert content_digest(spark.createDataFrame(rows[::-1], kinds).repartition(4)) == total
    assert content_digest(spark.createDataFrame([], kinds)) == content_digest(None)
