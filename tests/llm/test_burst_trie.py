"""The prefix trie against a model with one dictionary entry per prefix."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tarnkeep.llm import burst_trie

SCHEMA = "conv_id long, turn long, role string, text string, seq long, pos long, p1 string, members string"


def model_nodes(rows):
    """All nodes of rows (conv, turn, role, text), as the contract has them."""
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in own.items()}
    convs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        convs[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(list)
    for prefix in members:
        if prefix:
            children[prefix[:-1]].append(prefix)
    leaves, saved = {}, {}
    for prefix in sorted(members, key=len, reverse=True):
        below = children[prefix]
        words = len(re.findall(r"[^\x20\x09-\x0D]+", prefix[-1][1])) if prefix else 0
        leaves[prefix] = sum(leaves[p] for p in below) if below else 1
        saved[prefix] = (len(members[prefix]) - 1) * words + sum(saved[p] for p in below)
    result = []
    for prefix, inside in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in inside if convs[c] == prefix))
        parent = min(members[prefix[:-1]]) if prefix else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        result.append(
            (min(inside), len(prefix), parent, len(inside), len(children[prefix]), leaves[prefix], saved[prefix], digest)
        )
    return sorted(result, key=str)


def check(spark, rows):
    table = spark.createDataFrame([(*r, 1, 1, "x", "y") for r in rows], SCHEMA)
    found = burst_trie.op11(table)
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256"
    assert found.columns == names.split()
    assert sorted((tuple(r) for r in found.collect()), key=str) == model_nodes(rows)


def random_rows(pick, convs, letters, longest):
    rows = []
    for c in range(convs):
        for t in range(pick.randint(1, longest)):
            rows.append((c, t, pick.choice("ua"), f"say {pick.randint(0, letters)} " * pick.randint(0, 3)))
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize(("container", "letters"), [(1, 0), (4, 1), (30, 2), (4_096, 2)])
def test_random_conversations_equal_the_model(spark, monkeypatch, container, letters):
    monkeypatch.setattr(burst_trie, "CONTAINER", container)
    check(spark, random_rows(random.Random(container), 70, letters, 12))


def test_copies_of_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(burst_trie, "CONTAINER", 16)
    rows = []
    for c in (0, 40, 80, 120, 5, 6):
        rows += [(c, t, "u", f"turn {t}") for t in range(300 if c < 100 else 299)]
        rows += [(c, 300, "u", f"end {c}")] if c in (40, 80) else []
    check(spark, rows)


def test_edge_rows_equal_the_model(spark):
    rows = [(None, 0, "u", "x"), (1, None, None, None), (1, None, "a", "b c"), (1, 0, "u", " \t"), (1, 0, "u", " \t")]
    rows += [(2, 5, "u", None), (2, -1, "", "a:b"), (3, 1, "a:", "b"), (20, 1, "u", "only"), (25, 1, "u", "w " * 50_000)]
    rows += [(39, 7, "u", "x"), (300, 1, "u", "x"), (317, 1, "", "u:x")]
    check(spark, rows)
    empty = spark.createDataFrame([], SCHEMA)
    assert burst_trie.op11(empty).collect() == []


def test_turnless_conversations_are_members_of_the_root(spark):
    turnless = [c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3]
    rows = [(c, 0, "u", "gone") for c in turnless]
    check(spark, rows)
    check(spark, [*rows, (500, 0, "u", "a b")])


def test_running_values_cross_tasks(spark):
    rows = spark.range(2_000).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("key"),
        F.col("id").alias("at"),
        (F.col("id") * 77 % 1_000).alias("x"),
        (F.col("id") % 10).alias("s"),
    )
    found = burst_trie.running(rows, "key", [F.col("at")], ["x"], ["s"]).collect()
    groups = defaultdict(list)
    for r in rows.collect():
        groups[r.key].append((r.at, r.x, r.s))
    expected = []
    for key, held in groups.items():
        x = s = 0
        for nth, (at, a, b) in enumerate(sorted(held)):
            x, s = x ^ a, s + b
            expected.append((key, at, x, s, nth))
    assert sorted(map(tuple, found)) == sorted(expected)


def test_whole_conversations_equal_the_model(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in burst_trie.op11(table).collect()), key=str) == model_nodes(rows)
