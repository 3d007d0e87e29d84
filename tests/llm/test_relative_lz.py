"""Removal of repeated windows of words against a model."""

import hashlib
import random

import pytest
from llm.models import edge_rows, edge_table

from tarnkeep.llm import relative_lz


def model_rows(rows, hash_of=None):
    """(id, words, removed, digest) of rows (id, text); equal rows are one document."""
    hash_of = hash_of or {}
    last = 1 << 63
    docs = sorted({(last if i is None else i, hash_of.get((i, t), 0), i, t) for i, t in rows}, key=lambda d: d[:2])
    seen, result = set(), {}
    for _, _, name, text in docs:
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if window in seen:
                gone.update(range(i, i + 20))
            seen.add(window)
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        result[name, text] = (name, len(words), len(gone), hashlib.sha256(kept).hexdigest())
    return [result[i, t] for i, t in rows]


def order_of(spark, rows):
    """The hashes that order texts of one id."""
    numbered = relative_lz._numbered(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    return {(r.key, r.text): r.row for r in numbered.collect()}


def check(spark, rows):
    table = spark.createDataFrame(rows, "doc_id long, text string")
    hashes = order_of(spark, rows)
    expected = model_rows(rows, {(i, t): hashes[i, t or ""] for i, t in rows})
    assert sorted(map(tuple, relative_lz.op13(table).collect()), key=str) == sorted(expected, key=str)


def random_rows(pick, count, letters):
    """Texts of random words, and of stretches of other texts with single words changed."""
    rows = []
    for i in range(count):
        words = [f"w{pick.randint(0, letters)}" for _ in range(pick.randint(0, 70))]
        for _ in range(pick.randint(0, 3)):
            if rows:
                other = pick.choice(rows)[1].split()
                a = pick.randint(0, max(0, len(other) - 1))
                stretch = other[a : a + pick.randint(15, 60)]
                if pick.random() < 0.3 and stretch:
                    stretch[pick.randrange(len(stretch))] = "new"
                words += stretch
        rows.append((i, " ".join(words)))
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("letters", [1, 3, 10_000])
def test_random_texts_equal_the_model(spark, letters):
    check(spark, random_rows(random.Random(letters), 120, letters))


def test_hot_anchors_are_cut_into_windows(spark, monkeypatch):
    monkeypatch.setattr(relative_lz, "BLOCK", 3)
    monkeypatch.setattr(relative_lz, "TOGETHER", 100)
    check(spark, random_rows(random.Random(11), 150, 10_000))


def test_a_passage_between_different_words(spark):
    passage = " ".join(f"p{i}" for i in range(55))
    pick = random.Random(2)
    words = [" ".join(f"x{pick.randint(0, 9**9)}" for _ in range(25)) for _ in range(600)]
    rows = [(i, f"{a} {passage} {b}") for i, (a, b) in enumerate(zip(words[::2], words[1::2], strict=True))]
    check(spark, rows)
    table = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in relative_lz.without_repeats(table).collect()}
    assert spans == {i: [(25, 55)] if i else [] for i in range(300)}


def test_null_ids_and_ties(spark):
    base = random_rows(random.Random(5), 40, 10_000)
    rows = [(None if i % 3 == 0 else i % 5, t) for i, t in base] + [(None, None), (3, None), (3, "")]
    check(spark, rows + rows[:10])


def test_edge_rows_equal_the_model(spark):
    rows = [(i, t) for i, t, *_ in edge_rows()]
    hashes = order_of(spark, rows)
    expected = model_rows(rows, {(i, t): hashes[i, t or ""] for i, t in rows})
    found = map(tuple, relative_lz.op13(edge_table(spark)).collect())
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert relative_lz.op13(edge_table(spark).limit(0)).collect() == []


def test_whole_documents_equal_the_model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, relative_lz.op13(docs).collect())) == sorted(model_rows(rows))


def test_texts_of_one_id_are_told_apart_whatever_their_hash(spark, monkeypatch):
    real = relative_lz.F.xxhash64
    calls = []

    def colliding(*columns):
        calls.append(columns)
        return relative_lz.F.lit(7).cast("bigint") if len(calls) == 1 else real(*columns)

    monkeypatch.setattr(relative_lz.F, "xxhash64", colliding)
    table = spark.createDataFrame([(None, "a b"), (None, "c d")], "doc_id long, text string")
    assert len({r.row for r in relative_lz._numbered(table, "doc_id", "text").collect()}) == 2
    assert len(calls) == 3
