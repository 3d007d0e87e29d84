import os
import subprocess
import sys
from datetime import datetime

import pytest
from pyspark.cloudpickle import dumps

from tarnkeep.sources.folders import (
    _scanner,
    list_log_files,
    list_tables,
)


def put(path, seconds, text="x"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    os.utime(path, (seconds, seconds))


@pytest.fixture
def tree(tmp_path):
    put(tmp_path / "i1/Tables/dbo/a/_delta_log/0.json", 1_000_000)
    put(tmp_path / "i1/Tables/dbo/a/_delta_log/_last_checkpoint", 2_000_000.25)
    put(tmp_path / "i1/Tables/dbo/a/_delta_log/empty.json", 1_500_000, "")
    put(tmp_path / "i1/Tables/dbo/a/_delta_log/sub/deep.json", 3_000_000)
    put(tmp_path / "i1/Tables/dbo/no_log/part.parquet", 5)
    put(tmp_path / "i1/Tables/dbo/loose_file", 5)
    put(tmp_path / "i1/Tables/readme", 5)
    put(tmp_path / "i2/Tables/s/b/_delta_log/1.json", 1_000_001)
    put(tmp_path / "i3/other", 5)
    return tmp_path


def items(spark, tree, names):
    return spark.createDataFrame(
        [(name, str(tree / name)) for name in names], "item_id string, item_root string"
    )


def test_listing(spark, tree):
    tables = list_tables(items(spark, tree, ["i1", "i2", "i3", "absent"]))
    assert {(r.item_id, r.table_path, r.error is None) for r in tables.collect()} == {
        ("i1", "Tables/dbo/a", True),
        ("i1", "Tables/dbo/no_log", True),
        ("i2", "Tables/s/b", True),
        ("i3", None, False),
        ("absent", None, False),
    }
    files = list_log_files(tables).collect()
    assert {(r.table_path, r.file_name, r.modified) for r in files} == {
        ("Tables/dbo/a", "0.json", datetime(1970, 1, 12, 13, 46, 40)),
        ("Tables/dbo/a", "_last_checkpoint", datetime(1970, 1, 24, 3, 33, 20, 250000)),
        ("Tables/dbo/a", "empty.json", datetime(1970, 1, 18, 8, 40)),
        ("Tables/s/b", "1.json", datetime(1970, 1, 12, 13, 46, 41)),
    }


def test_unreadable_folders_become_rows(spark, tree):
    put(tree / "i4/Tables", 5)
    put(tree / "i2/Tables/s/c/_delta_log", 5)
    tables = list_tables(items(spark, tree, ["i2", "i4"]))
    failed = [row for row in tables.collect() if row.error]
    assert [(row.item_id, row.table_path) for row in failed] == [("i4", None)]
    assert "Not a directory" in failed[0].error
    files = {row.table_path: row for row in list_log_files(tables).collect()}
    assert files["Tables/s/b"].error is None
    assert "Not a directory" in files["Tables/s/c"].error


def test_tasks_do_not_need_the_package(tmp_path):
    task = tmp_path / "task"
    task.write_bytes(dumps(_scanner()))
    load = f"import pickle; pickle.load(open({str(task)!r}, 'rb'))"
    subprocess.run([sys.executable, "-I", "-c", load], cwd=tmp_path, check=True)


def test_more_entries_than_one_batch(spark, tmp_path):
    log = tmp_path / "i/Tables/s/t/_delta_log"
    log.mkdir(parents=True)
    for number in range(25_001):
        (log / f"{number:020d}.json").touch()
    found = list_log_files(list_tables(items(spark, tmp_path, ["i"])))
    assert found.count() == 25_001


def test_a_vanished_entry_hides_no_other(spark, tmp_path):
    folder = tmp_path / "item" / "Tables" / "s" / "t" / "_delta_log"
    folder.mkdir(parents=True)
    for i in range(30):
        (folder / f"{i:03d}.json").write_text("x")
    (folder / "015.gone").symlink_to(tmp_path / "nowhere")
    items = spark.createDataFrame([("item", str(tmp_path / "item"))], "item_id string, item_root string")
    assert list_log_files(list_tables(items)).count() == 30


def test_a_missing_item_is_an_error_row(spark, tmp_path):
    items = spark.createDataFrame([("a", str(tmp_path / "none"))], "item_id string, item_root string")
    (row,) = list_tables(items).collect()
    assert row.table_path is None and "No such file" in row.error
