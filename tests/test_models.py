"""Random small inputs against plain Python models of the rules."""

import random
from datetime import datetime, timedelta

import pytest

from tarnkeep.functions.ages import ntz
from tarnkeep.operators.freshness import freshness_detail, freshness_summary, table_ages
from tarnkeep.plans.load import load
from tarnkeep.sinks.targets import PathTarget

NOW = datetime(2024, 5, 1)


def modelled_summary(tables, files, threshold):
    """(total, logged, stale, newest, oldest, greatest, least, broken) of one item's tables."""
    rows = []
    for table in tables:
        newest = max((when for name, when in files if name == table), default=None)
        age = None if newest is None else (NOW - newest).total_seconds() / 3600
        rows.append((newest, round(age, 2) if age else None, bool(age and age > threshold)))
    logged = [row for row in rows if row[0] is not None]
    ages = [row[1] for row in logged if row[1] is not None]
    stale = sum(row[2] for row in logged)
    return (
        len(rows),
        len(logged),
        stale,
        max((row[0] for row in logged), default=None),
        min((row[0] for row in logged), default=None),
        max(ages, default=0) or None,
        min(ages, default=0) or None,
        stale == len(logged) if logged else None,
    )


@pytest.mark.parametrize("seed", range(3))
def test_freshness(spark, seed):
    rng = random.Random(seed)
    items = range(40)
    tables = [(i, f"Tables/s/t{n}") for i in items for n in range(rng.randrange(4))]
    files = []
    for item, path in tables:
        for _ in range(rng.choice([0, 1, 3])):
            back = timedelta(seconds=rng.choice([0, 18 * rng.randrange(9000), 5 * 3600]))
            files.append((item, path, f"{rng.randrange(5)}.json", NOW - back))
    targets = [(i, f"ws{i}", f"wh{i}") for i in items if rng.random() < 0.8]
    threshold = 5.0

    frame = spark.createDataFrame
    ages = table_ages(
        frame(tables, "item_id int, table_path string"),
        frame(files, "item_id int, table_path string, file_name string, modified timestamp_ntz"),
        ntz(NOW),
        threshold_hours=threshold,
    )
    chosen = frame(targets, "item_id int, workspace_name string, item_name string")
    detail = freshness_detail(chosen, ages, ntz(NOW), threshold).collect()
    summary = freshness_summary(chosen, ages, ntz(NOW), threshold).collect()

    expected = {}
    for item, _, name in targets:
        own = [path for other, path in tables if other == item]
        logs = [(path, when) for other, path, _, when in files if other == item]
        expected[name] = modelled_summary(own, logs, threshold)
    got = {row.WarehouseName: tuple(row)[3:10] + (row.IsPublishingBroken,) for row in summary}
    assert got == expected
    assert len(detail) == sum(row.TotalTables for row in summary)
    for row in detail:
        item = int(row.WarehouseName.removeprefix("wh"))
        own = [(w, f) for i, p, f, w in files if (i, p) == (item, row.TablePath)]
        newest = max((when for when, _ in own), default=None)
        first = min((file for when, file in own if when == newest), default=None)
        assert (row.LatestLogTs, row.LatestLogFile) == (newest, first)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("partition_by", [(), ("part",)])
def test_merges(spark, tmp_path, seed, partition_by):
    rng = random.Random(seed)
    schema = "id long, part string, amount int"

    def rows(count, keys):
        chosen = rng.sample(range(keys), count) + [None] * rng.randrange(3)
        return [(key, rng.choice(["a", "b", None]), rng.randrange(100)) for key in chosen]

    target = PathTarget(str(tmp_path / "t"), partition_by=partition_by)
    content = rows(30, 60)
    load(spark.createDataFrame(content, schema), target, "append")
    for step in range(2):
        source = rows(10, 80)
        if step == 0:  # rows stay where they are, so single partitions can be replaced
            place = {row[0]: row[1] for row in content if row[0] is not None}
            source = [(k, place.get(k, part), amount) for k, part, amount in source]
        keys = {row[0] for row in source if row[0] is not None}
        content = [row for row in content if row[0] not in keys] + source
        load(spark.createDataFrame(source, schema), target, "merge", key="id")
        got = target.read(spark).select("id", "part", "amount").collect()
        assert sorted(map(tuple, got), key=str) == sorted(content, key=str)
