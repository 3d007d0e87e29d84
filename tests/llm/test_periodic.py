"""Runs of words against a model that tries every period."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from llm.models import EXTRA, edge_rows, edge_table
from pyspark.sql import functions as F

from tarnkeep.llm import periodic


def model_runs(words):
    """All (start, length, period) with the smallest period and at least four of it and six words."""
    found, n = {}, len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(6, 4 * q):
                stretch = words[start : start + length]
                if all(stretch[p:] != stretch[:-p] for p in range(1, q)):
                    found[start, q] = length
    return sorted((s, n, q) for (s, q), n in found.items())


def model_row(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = sorted(model_runs(words), key=lambda r: (r[0], r[2]))
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (
        doc_id,
        len(runs),
        *best,
        best[1] * 1000 // best[2] if runs else None,
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(kept).hexdigest(),
    )


@pytest.mark.parametrize("letters", [1, 2, 3, 5])
def test_runs_of_random_words_equal_the_model(letters):
    pick = random.Random(letters)
    for _ in range(150):
        texts = []
        for _ in range(pick.randint(1, 4)):
            text = []
            while len(text) < pick.randint(0, 60):
                root = pick.choices(range(letters), k=pick.randint(1, 9))
                text += root * pick.randint(1, 6) + root[: pick.randint(0, len(root))]
            texts.append(text)
        codes = np.array([x for i, t in enumerate(texts) for x in [*t, 100 + i]], dtype=np.int64)
        starts, lengths, periods = (x.tolist() for x in periodic.runs_of(codes))
        expected, at = [], 0
        for text in texts:
            expected += [(at + s, n, q) for s, n, q in model_runs(text)]
            at += len(text) + 1
        assert sorted(zip(starts, lengths, periods, strict=True)) == sorted(expected)


def test_successors_equal_a_search():
    pick = np.random.default_rng(3)
    for n in (1, 2, 7, 64, 100):
        values = pick.permutation(n)
        wavelet = periodic.WaveletMatrix(values)
        left = pick.integers(0, n, 200)
        right = np.minimum(n, left + pick.integers(0, n + 1, 200))
        least = pick.integers(0, n, 200)
        found = wavelet.successors(left, right, least)
        for a, b, x, y in zip(left, right, least, found, strict=True):
            above = [v for v in values[a:b] if v >= x]
            assert y == min(above, default=-1)


def test_edge_rows_equal_the_model(spark):
    rows = edge_rows()
    rows += [(100 + i, "tick tock " * (i + 1) + "end", "en", "s", 0, *EXTRA) for i in range(60)]
    rows += [(200 + i, "a b c " * 9 + "x\x0by\x0c" * i, "en", "s", 0, *EXTRA) for i in range(12)]
    found = [tuple(r) for r in periodic.op12(edge_table(spark, rows)).collect()]
    assert sorted(found, key=str) == sorted((model_row(i, t) for i, t, *_ in rows), key=str)


def test_a_long_text_and_an_empty_table(spark):
    pick = random.Random(8)
    words = [f"w{pick.randint(0, 50_000)}" for _ in range(90_000)]
    words[40_000:70_000] = (words[40_000:45_000] * 6)[:30_000]
    table = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    runs = periodic.periodic_runs(table).first().runs
    assert (40_000, 30_000, 5_000) in [(r.start, r.length, r.period) for r in runs]
    assert periodic.op12(table.limit(0)).collect() == []


def test_whole_documents_equal_the_model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter(F.length("text") < 6_000)
    expected = sorted(model_row(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    assert sorted(map(tuple, periodic.op12(docs).collect())) == expected
