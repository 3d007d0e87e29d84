import os

import pytest
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import functions as F

from tarnkeep.operators.guards import key_profile, row_loss_guard
from tarnkeep.operators.merge import conform, last_per_key, merge_rows
from tarnkeep.plans.load import LoadRejected, load
from tarnkeep.sinks.targets import PathTarget, TableTarget

SCHEMA = "id long, part string, amount int"


def rows_of(frame):
    return sorted(frame.collect(), key=str)


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def numbers(spark, count):
    return spark.range(count).select(
        "id", F.lit("p").alias("part"), F.lit(1).alias("amount")
    )


@pytest.fixture(params=["path", "table"])
def target(request, tmp_path, spark):
    if request.param == "path":
        return PathTarget(str(tmp_path / "target"))
    return TableTarget(f"target_{abs(hash(str(tmp_path)))}")


def leftovers(target, spark):
    if isinstance(target, PathTarget):
        return sorted(os.listdir(os.path.dirname(target.path)))
    names = [row.tableName for row in spark.sql("SHOW TABLES").collect()]
    return sorted(name for name in names if name.startswith(target.name))


def own_name(target):
    return [os.path.basename(target.path) if isinstance(target, PathTarget) else target.name]


def test_append_keeps_every_row(spark, target):
    first = frame(spark, [(1, "a", 1), (1, "a", 1)])
    report = load(first, target, "append").first()
    assert (report.source_rows, report.target_rows_before, report.target_rows_after) == (2, 0, 2)
    report = load(first, target, "append").first()
    assert (report.source_rows, report.target_rows_before, report.target_rows_after) == (2, 2, 4)
    assert report.required_rows is None


@pytest.mark.parametrize("partition_by", [(), ("part",)])
def test_append_of_nothing(spark, tmp_path, partition_by):
    target = PathTarget(str(tmp_path / "t"), partition_by=partition_by)
    load(numbers(spark, 3), target, "append")
    for empty in (frame(spark, []), numbers(spark, 3).filter("false"), numbers(spark, 0)):
        assert load(empty, target, "append").first().source_rows == 0
    assert target.read(spark).count() == 3


def test_append_to_partitions_counts_rows(spark, tmp_path):
    target = PathTarget(str(tmp_path / "t"), partition_by=("part",))
    rows = numbers(spark, 1000).withColumn("part", (F.col("id") % 3).cast("string"))
    for before in (0, 1000):
        report = load(rows, target, "append").first()
        assert (report.source_rows, report.target_rows_before) == (1000, before)


def test_append_matches_columns_by_name_and_casts(spark, target):
    load(frame(spark, [(1, "a", 1)]), target, "append")
    load(frame(spark, [("5", 2, "b")], "amount string, id int, part string"), target, "append")
    assert rows_of(target.read(spark)) == rows_of(frame(spark, [(1, "a", 1), (2, "b", 5)]))


def test_full_load_replaces(spark, target):
    load(numbers(spark, 100), target, "fullload")
    report = load(numbers(spark, 95), target, "fullload").first()
    assert (report.loss_pct, report.target_rows_after, report.required_rows) == (5.0, 95, 95)
    assert leftovers(target, spark) == own_name(target)


def test_full_load_aborts_on_row_loss(spark, target):
    load(numbers(spark, 100), target, "fullload")
    with pytest.raises(LoadRejected, match="6.0% loss"):
        load(numbers(spark, 94), target, "fullload")
    assert target.read(spark).count() == 100
    assert leftovers(target, spark) == own_name(target)


def test_a_failed_load_leaves_no_trace(spark, target):
    load(numbers(spark, 5), target, "fullload")
    bad = numbers(spark, 5).withColumn("amount", F.lit("much"))
    for strategy in ("fullload", "merge"):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            load(bad, target, strategy, key="id", stored_source=True)
    assert target.read(spark).count() == 5
    assert leftovers(target, spark) == own_name(target)


def test_full_load_may_grow_and_may_fill_an_empty_target(spark, target):
    load(numbers(spark, 0), target, "append")
    assert load(numbers(spark, 3), target, "fullload").first().loss_pct == -300.0
    assert load(numbers(spark, 30), target, "fullload").first().loss_pct == -900.0


def test_empty_full_load(spark, target):
    load(numbers(spark, 0), target, "append")
    with pytest.raises(LoadRejected, match="empty"):
        load(numbers(spark, 0), target, "fullload")
    load(numbers(spark, 0), target, "fullload", allow_empty=True)
    assert leftovers(target, spark) == own_name(target)


def test_full_load_from_the_target_itself(spark, target):
    load(numbers(spark, 10), target, "fullload")
    load(target.read(spark).withColumn("amount", F.lit(7)), target, "fullload")
    assert target.read(spark).filter("amount = 7").count() == 10


def test_merge_updates_inserts_and_keeps(spark, target):
    load(frame(spark, [(1, "a", 1), (2, "a", 2), (None, "n", 3)]), target, "append")
    source = frame(spark, [(2, "b", 20), (3, "c", 30), (None, "m", 40)])
    report = load(source, target, "merge", key="id").first()
    assert (report.source_rows, report.required_rows, report.target_rows_after) == (3, 3, 5)
    expected = [(1, "a", 1), (2, "b", 20), (3, "c", 30), (None, "n", 3), (None, "m", 40)]
    assert rows_of(target.read(spark)) == rows_of(frame(spark, expected))
    assert leftovers(target, spark) == own_name(target)


def test_second_merge_changes_nothing(spark, target):
    load(numbers(spark, 50), target, "append")
    source = numbers(spark, 80).filter("id >= 30").withColumn("amount", F.lit(2))
    load(source, target, "merge", key="id")
    once = rows_of(target.read(spark))
    load(source, target, "merge", key="id")
    assert rows_of(target.read(spark)) == once
    assert len(once) == 80


def test_first_merge_writes_the_source_as_it_is(spark, target):
    source = frame(spark, [(1, "a", 1), (1, "a", 1)])
    assert load(source, target, "merge", key="id").first().target_rows_after == 2


def test_merge_of_an_empty_source(spark, target):
    load(numbers(spark, 5), target, "append")
    load(numbers(spark, 0), target, "merge", key="id")
    assert target.read(spark).count() == 5


def test_repeated_keys(spark, target):
    load(frame(spark, [(1, "a", 1), (9, "z", 9)]), target, "append")
    source = frame(spark, [(1, "b", 2), (1, "c", 3), (None, "n", 4), (None, "n", 4)])
    with pytest.raises(LoadRejected, match="occurs 2 times"):
        load(source, target, "merge", key="id")
    report = load(
        source, target, "merge", key="id", on_duplicate="last", order_by=["amount"]
    ).first()
    assert (report.source_rows, report.required_rows, report.target_rows_after) == (4, 3, 4)
    expected = [(1, "c", 3), (9, "z", 9), (None, "n", 4), (None, "n", 4)]
    assert rows_of(target.read(spark)) == rows_of(frame(spark, expected))


def test_bad_arguments(spark, target):
    source = numbers(spark, 1)
    with pytest.raises(ValueError, match="upsert"):
        load(source, target, "upsert")
    with pytest.raises(ValueError, match="key"):
        load(source, target, "merge")
    with pytest.raises(ValueError, match="order_by"):
        load(source, target, "merge", key="id", on_duplicate="last")
    with pytest.raises(ValueError, match=r"missing \['amount'\], extra \['x'\]"):
        conform(frame(spark, [], "id long, part string, x int"), source.schema)


def test_shuffled_merge_equals_broadcast_merge(spark):
    target = spark.range(0, 4000, 1, 8).select(
        F.when(F.col("id") % 3 != 0, F.col("id")).alias("id"),
        F.lit("p").alias("part"),
        F.lit(1).alias("amount"),
    )
    source = numbers(spark, 9000).filter("id % 7 = 0").withColumn("amount", F.lit(2))
    source = source.unionAll(frame(spark, [(None, "s", 2)]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = merge_rows(source, target, "id")
        one = rows_of(shuffled)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert one == rows_of(merge_rows(source, target, "id"))
    assert sum(row.id is None for row in one) == 1334 + 1


def test_keys_beyond_a_broadcast_are_shuffled(spark, tmp_path):
    target = PathTarget(str(tmp_path / "t"))
    load(numbers(spark, 50), target, "append")
    load(numbers(spark, 60).withColumn("amount", F.lit(2)), target, "merge", key="id")
    assert target.read(spark).filter("amount = 2").count() == 60


def modified(folder):
    return {
        name: os.stat(os.path.join(folder, name)).st_mtime_ns
        for name in os.listdir(folder)
        if "=" in name
    }


PARTS = [(1, "a", 1), (2, "a", 2), (3, "b", 3), (4, None, 4), (None, "b", 5), (7, "c", 7)]


def test_merge_rewrites_only_the_touched_partitions(spark, tmp_path):
    target = PathTarget(str(tmp_path / "t"), partition_by=("part",))
    load(frame(spark, PARTS), target, "append")
    old = modified(target.path)
    source = frame(spark, [(3, "b", 30), (4, None, 40), (5, "d", 50), (None, "b", 6)])
    load(source, target, "merge", key="id")
    new = modified(target.path)
    assert {name for name in new if new[name] == old.get(name)} == {"part=a", "part=c"}
    expected = [PARTS[0], PARTS[1], PARTS[4], PARTS[5], *rows_of(source)]
    got = target.read(spark).select("id", "part", "amount")
    assert rows_of(got) == rows_of(frame(spark, expected))


@pytest.mark.parametrize("partition_by", [(), ("part",)])
def test_merge_without_any_match_only_appends(spark, tmp_path, partition_by):
    target = PathTarget(str(tmp_path / "t"), partition_by=partition_by)
    load(frame(spark, PARTS), target, "append")
    old = {path: os.stat(path).st_mtime_ns for path in files_of(target)}
    source = frame(spark, [(100, "a", 1), (101, "x", 2), (None, "b", 3)])
    load(source, target, "merge", key="id")
    assert old.items() <= {path: os.stat(path).st_mtime_ns for path in files_of(target)}.items()
    got = target.read(spark).select("id", "part", "amount")
    assert rows_of(got) == rows_of(frame(spark, PARTS).unionAll(source))


def files_of(target):
    return [
        os.path.join(folder, name)
        for folder, _, names in os.walk(target.path)
        for name in names
        if name.endswith(".parquet")
    ]


def test_merge_of_a_row_that_changes_partition(spark, tmp_path):
    target = PathTarget(str(tmp_path / "t"), partition_by=("part",))
    load(frame(spark, PARTS), target, "append")
    source = frame(spark, [(7, "a", 70), (3, "b", 30)])
    load(source, target, "merge", key="id")
    expected = [PARTS[0], PARTS[1], PARTS[3], PARTS[4], *rows_of(source)]
    got = target.read(spark).select("id", "part", "amount")
    assert rows_of(got) == rows_of(frame(spark, expected))
    assert leftovers(target, spark) == own_name(target)


def test_partitioned_by_its_key(spark, tmp_path):
    target = PathTarget(str(tmp_path / "t"), partition_by=("id",))
    load(frame(spark, [(1, "a", 1), (2, "b", 2)]), target, "append")
    load(frame(spark, [(2, "c", 3), (3, "d", 4)]), target, "merge", key="id")
    got = target.read(spark).select(F.col("id").cast("long"), "part", "amount")
    assert rows_of(got) == rows_of(frame(spark, [(1, "a", 1), (2, "c", 3), (3, "d", 4)]))


def test_interrupted_swaps_are_put_right(spark, tmp_path):
    target = PathTarget(str(tmp_path / "t"))
    load(numbers(spark, 5), target, "append")
    os.rename(target.path, target.path + "__previous")
    load(numbers(spark, 2), target, "append")
    assert target.read(spark).count() == 7
    numbers(spark, 1).write.parquet(target.path + "__previous")
    with pytest.raises(RuntimeError, match="by hand"):
        load(numbers(spark, 2), target, "append")
    (tmp_path / "t" / "_swapped").write_text("")
    load(numbers(spark, 2), target, "append")
    assert target.read(spark).count() == 9
    assert leftovers(target, spark) == ["t"]


def test_an_append_alone_recovers_first(spark, tmp_path):
    target = PathTarget(str(tmp_path / "t"))
    target.append(numbers(spark, 5))
    os.rename(target.path, target.path + "__previous")
    target.append(numbers(spark, 2))
    load(numbers(spark, 1), target, "append")
    assert target.read(spark).count() == 8


def test_partition_names_keep_their_text(spark, tmp_path):
    target = PathTarget(str(tmp_path / "t"), partition_by=("part",))
    load(frame(spark, [(1, "01", 10), (2, "1", 20)]), target, "append")
    load(frame(spark, [(1, "01", 99)]), target, "merge", key="id")
    got = target.read(spark).select("id", "part", "amount")
    assert rows_of(got) == rows_of(frame(spark, [(1, "01", 99), (2, "1", 20)]))


def test_merge_of_very_many_partitions_leaves_the_others(spark, tmp_path):
    target = PathTarget(str(tmp_path / "t"), partition_by=("part",))
    rows = spark.range(1_200).select(
        "id", F.concat(F.lit("p"), "id").alias("part"), F.lit(1).alias("amount")
    )
    load(rows, target, "append")
    old = modified(target.path)
    load(rows.filter("id < 1100").withColumn("amount", F.lit(2)), target, "merge", key="id")
    new = modified(target.path)
    assert sum(new[name] == old[name] for name in old) == 100
    assert target.read(spark).agg(F.sum("amount")).first()[0] == 100 + 2 * 1_100


def test_casts_that_lose_something_fail(spark, tmp_path):
    target = PathTarget(str(tmp_path / "t"))
    load(spark.sql("SELECT 1L AS id, DATE '2024-01-01' AS day"), target, "append")
    load(spark.sql("SELECT 2.0D AS id, TIMESTAMP '2024-01-02 00:00:00' AS day"), target, "append")
    for row in ("1.9D AS id, DATE '2024-01-01' AS day", "3L AS id, TIMESTAMP '2024-01-02 10:00:00' AS day"):
        with pytest.raises(Exception, match="does not fit"):
            load(spark.sql(f"SELECT {row}"), target, "append")
    assert target.read(spark).count() == 2


def test_last_per_key_carries_maps(spark):
    rows = spark.sql("SELECT * FROM VALUES (1, 1, map('a', 1)), (1, 2, map('b', 2)) AS t(id, n, m)")
    assert last_per_key(rows, "id", ["n"]).first().m == {"b": 2}


def test_an_unreadable_target_is_not_taken_for_a_new_one(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="part-0.parquet"):
        load(numbers(spark, 1), PathTarget(str(tmp_path / "t")), "merge", key="id")
    assert os.listdir(tmp_path / "t") == ["part-0.parquet"]


def test_native_merge_is_left_to_the_format(spark, tmp_path):
    name = f"native_{abs(hash(str(tmp_path)))}"
    load(numbers(spark, 2), TableTarget(name), "append")
    with pytest.raises(UnsupportedOperationException, match="MERGE INTO TABLE"):
        load(numbers(spark, 2), TableTarget(name, transactional=True), "merge", key="id")


@pytest.mark.parametrize("kind", ["path", "table"])
def test_transactional_targets_are_overwritten_in_place(spark, tmp_path, kind):
    if kind == "path":
        target = PathTarget(str(tmp_path / "t"), transactional=True)
    else:
        target = TableTarget(f"own_log_{abs(hash(str(tmp_path)))}", transactional=True)
    load(numbers(spark, 5), target, "fullload")
    load(numbers(spark, 6), target, "fullload")
    assert target.read(spark).count() == 6
    assert leftovers(target, spark) == own_name(target)


def test_a_replaced_table_keeps_its_partitions(spark, tmp_path):
    name = f"parted_{abs(hash(str(tmp_path)))}"
    load(frame(spark, PARTS), TableTarget(name, partition_by=("part",)), "append")
    for how in ({"strategy": "merge", "key": "id"}, {"strategy": "append"}):
        load(frame(spark, [(3, "c", 30)]), TableTarget(name), **how)
        columns = spark.catalog.listColumns(name)
        assert [column.name for column in columns if column.isPartition] == ["part"]
    assert spark.table(name).filter("id = 3 AND part = 'c'").count() == 2
    assert spark.table(name).count() == len(PARTS) + 1
    assert leftovers(TableTarget(name), spark) == [name]


def test_a_cut_off_replacement_of_a_partitioned_table(spark, tmp_path):
    target = TableTarget(f"cut_{abs(hash(str(tmp_path)))}", partition_by=("part",))
    load(frame(spark, PARTS), target, "append")
    target.stage(frame(spark, PARTS[:2]))
    load(frame(spark, []), target, "append")
    assert target.read(spark).count() == len(PARTS)
    target.stage(frame(spark, PARTS[:2]))
    spark.sql(f"DROP TABLE {target.name}")
    load(frame(spark, []), target, "append")
    assert target.read(spark).count() == 2
    assert leftovers(target, spark) == own_name(target)


def test_files_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tarnkeep.sinks.targets.RECORDS_PER_FILE", 10)
    target = PathTarget(str(tmp_path / "t"))
    load(numbers(spark, 95).coalesce(1), target, "append")
    assert len([name for name in os.listdir(target.path) if name.startswith("part")]) == 10


@pytest.mark.parametrize(
    "source, target, loss, abort",
    [(95, 100, 5.0, False), (94, 100, 6.0, True), (0, 0, 0.0, False), (5, 0, -500.0, False)],
)
def test_row_loss_guard(spark, source, target, loss, abort):
    counts = spark.createDataFrame([(source, target)], "source_rows long, target_rows long")
    row = row_loss_guard(counts).first()
    assert (row.loss_pct, row.abort) == (loss, abort)


def test_key_profile(spark):
    rows = [(1, "a", 1), (1, "b", 1), (None, "a", 1), (None, "a", 1), (None, "a", 1), (22, "", 1)]
    row = key_profile(frame(spark, rows), "id").first()
    assert row.asDict() == {
        "source_rows": 6,
        "distinct_keys": 2,
        "null_keys": 3,
        "max_copies": 2,
    }
    empty = key_profile(frame(spark, []), "id").first()
    assert set(empty.asDict().values()) == {0}


def test_last_per_key_settles_ties(spark):
    rows = [(1, "a", 5), (1, "b", 5), (2, "z", 1)]
    got = last_per_key(frame(spark, rows), "id", ["amount"])
    assert rows_of(got) == rows_of(frame(spark, [(1, "b", 5), (2, "z", 1)]))
