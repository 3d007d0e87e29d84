"""What near-dedup keeps and joins in its rounds, and what stays on disk behind a kept table."""

import os
import time

import pytest
from pyspark.sql import functions as F

from tarnkeep.llm import circulant
from tarnkeep.llm.tables import written


def _shuffled(spark):
    """Bytes of all shuffle files of the session."""
    disks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    found = [
        os.path.join(folder, name)
        for top in disks.localDirsString()
        for folder, _, names in os.walk(top)
        for name in names
        if name.startswith("shuffle_") and name.endswith(".data")
    ]
    return sum(os.path.getsize(name) for name in found if os.path.exists(name))


@pytest.fixture
def kept(spark, tmp_path, monkeypatch):
    """Row counts and plans of the kept tables, in order, by purpose."""
    tables: dict[str, list] = {}

    def watched(frame, purpose):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        result = written(frame, purpose)
        tables.setdefault(purpose, []).append((result.count(), plan))
        return result

    monkeypatch.setattr(circulant, "written", watched)
    return tables


def test_shuffles_behind_a_kept_table_are_removed(spark):
    before = _shuffled(spark)
    rows = written(spark.range(400_000).groupBy((F.col("id") % 200_000).alias("k")).count(), "shuffled")
    until = time.time() + 20
    while _shuffled(spark) > before and time.time() < until:
        time.sleep(0.2)
    assert rows.count() == 200_000
    assert _shuffled(spark) <= before


def test_rounds_look_at_open_bands_and_join_sets_before_shingles(spark, kept):
    # Copies of some texts with edits at different places, some more than the limit allows.
    texts = []
    for group in range(30):
        words = [f"w{group}x{i}" for i in range(120)]
        for edit in range(8):
            changed = list(words)
            for at in range(edit):
                changed[(at * 17 + edit * 5) % 120] = f"new{group}y{edit}z{at}"
            texts.append(" ".join(changed))
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    groups = {r.row.id: r.first.id for r in circulant.near_duplicates(documents, words=2).collect()}

    sets = [set(zip(t.split(), t.split()[1:], strict=False)) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    assert groups == {i: root(i) for i in range(len(texts))}

    placed = [n for n, _ in kept["minhash-placed"]]
    opened = [n for n, _ in kept["minhash-open"]]
    assert placed[1:] == opened[: len(placed) - 1] and sorted(placed, reverse=True) == placed
    for _, plan in kept.get("minhash-heads", []):
        assert "Join" not in plan[: plan.index("MapInArrow")]
