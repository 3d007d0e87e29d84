"""Runs of periodic words, found by internal pattern matching.

A run is a longest stretch of words with smallest period ``q`` that holds it at least ``TIMES`` times.
The texts of a batch are one array of word numbers, each text closed by a number of its own:

* Names of all stretches of 1, 2, 4, ... words come from prefix doubling, which ends with the suffix
  array; all suffixes that start with a block are one interval of it.
* A block of ``2**k`` words at every multiple of ``2**(k-1)`` looks for its next occurrence in the window to
  its right, as the range successor of its place in its interval, by a wavelet matrix over the suffix
  array.  Occurrences in so short a window form a progression, whose difference, the distance to the
  next one, is the candidate period.  Each run with a period above half a block and up to a whole one holds such
  a block and its next occurrence.
* A candidate is prolonged to both sides by the names, longest first.

Every text is worked on alone and whole, so nothing is shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A run holds its period so many times, and so many words.
TIMES, LEAST = 4, 6
#: Words that are looked at together; a longer single text is taken alone.
TOGETHER = 1 << 16
#: Blocks have ``2**SMALLEST`` words or more; the smallest ones serve all periods up to their length.
SMALLEST = 2

Rewrite = Callable[[int | None, list[bytes]], list[bytes]]


class Names(NamedTuple):
    """Per level ``k`` the first place in the suffix array, and the number, of the stretches that equal
    the ``2**k`` words from each position; and the suffix array."""

    first: list[np.ndarray]
    count: list[np.ndarray]
    suffixes: np.ndarray


def named(codes: np.ndarray) -> Names:
    """Names by prefix doubling until no stretch repeats; only repeated ones are sorted again."""
    n = len(codes)
    suffixes = np.argsort(codes, kind="stable")
    ranked = codes[suffixes]
    fresh = np.append(True, ranked[1:] != ranked[:-1])[:n]
    first, count = [], []
    place = np.empty(n, dtype=np.int64)
    size = np.ones(n, dtype=np.int32)
    slots = np.arange(n)
    members, width = suffixes, 1
    while True:
        starts = np.flatnonzero(fresh)
        lengths = np.diff(np.append(starts, len(members)))
        place[members] = np.repeat(slots[starts], lengths)
        size[members] = np.repeat(lengths, lengths)
        first.append(place.astype(np.int32))
        count.append(size.copy())
        slots = slots[np.repeat(lengths > 1, lengths)]
        if not len(slots):
            return Names(first, count, suffixes)
        members = suffixes[slots]
        after = members + width
        follow = np.where(after < n, place[np.minimum(after, n - 1)] + 1, 0)
        keys = place[members] * (n + 1) + follow
        order = np.argsort(keys, kind="stable")
        members, keys = members[order], keys[order]
        suffixes[slots] = members
        fresh = np.append(True, keys[1:] != keys[:-1])
        width *= 2


class WaveletMatrix:
    """Range successor over an array of numbers below its length."""

    def __init__(self, values: np.ndarray):
        self._zeros: list[np.ndarray] = []
        self._bits = range(max(1, int(len(values) - 1).bit_length()) - 1, -1, -1)
        for bit in self._bits:
            low = (values >> bit) & 1 == 0
            zeros = np.zeros(len(values) + 1, dtype=np.int32)
            np.cumsum(low, out=zeros[1:])
            self._zeros.append(zeros)
            values = np.concatenate([values[low], values[~low]])

    def successors(self, left: np.ndarray, right: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The smallest value from ``least`` on in each range [left, right), or -1."""
        smaller = np.zeros(len(left), dtype=np.int32)
        low, high = left, right
        for bit, zeros in zip(self._bits, self._zeros, strict=True):
            a, b = zeros[low], zeros[high]
            one = (least >> bit) & 1 == 1
            smaller += np.where(one, b - a, 0)
            low, high = (np.where(one, zeros[-1] + x - z, z) for x, z in ((low, a), (high, b)))
        some = np.flatnonzero(smaller < right - left)
        low, high, nth = left[some], right[some], smaller[some]
        value = np.zeros(len(some), dtype=np.int64)
        for bit, zeros in zip(self._bits, self._zeros, strict=True):
            a, b = zeros[low], zeros[high]
            one = nth >= b - a
            nth = np.where(one, nth - (b - a), nth)
            value |= one.astype(np.int64) << bit
            low, high = (np.where(one, zeros[-1] + x - z, z) for x, z in ((low, a), (high, b)))
        found = np.full(len(left), -1, dtype=np.int64)
        found[some] = value
        return found


def _candidates(names: Names) -> tuple[np.ndarray, np.ndarray]:
    """Positions of blocks, and the distance to the next occurrence of each where it can be a period."""
    n = len(names.suffixes)
    blocks = []
    for level in range(SMALLEST, len(names.first)):
        at = np.arange(0, n, 1 << (level - 1))
        at = at[names.count[level][at] > 1]
        blocks.append((level, at))
    if not any(len(at) for _, at in blocks):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    wavelet = WaveletMatrix(names.suffixes)
    positions, distances = [], []
    for level, at in blocks:
        left = names.first[level][at]
        distance = wavelet.successors(left, left + names.count[level][at], at + 1) - at
        low = 0 if level == SMALLEST else 1 << (level - 1)
        good = (distance > low) & (distance <= 1 << level)
        positions.append(at[good])
        distances.append(distance[good])
    return np.concatenate(positions), np.concatenate(distances)


def runs_of(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and periods of all runs, by start, then period.

    Every text of ``codes`` ends with a number that occurs nowhere else.
    """
    names = named(codes)
    at, period = _candidates(names)
    right, left = at + period, at.copy()
    for level in range(len(names.first) - 1, -1, -1):
        name, width = names.first[level], 1 << level
        right += width * (name[right - period] == name[right])
        before = left - width
        inside = before >= 0
        before = np.maximum(before, 0)
        left -= width * (inside & (name[before] == name[before + period]))
    length = right - left
    long = length >= np.maximum(LEAST, TIMES * period)
    found = np.unique(np.stack([left[long], period[long], length[long]], axis=1), axis=0)
    return found[:, 0], found[:, 2], found[:, 1]


def _collapsed(words: list[bytes], starts: np.ndarray, lengths: np.ndarray, periods: np.ndarray) -> bytes:
    """The words that are in no run behind its first period, joined by a space."""
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, starts + periods, 1)
    np.add.at(change, starts + lengths, -1)
    staying = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return b" ".join([words[i] for i in staying.tolist()])


def _rows(words: list[list[bytes]]) -> tuple[list[list[dict]], list[bytes]]:
    """Runs and collapsed text of each text."""
    number: dict[bytes, int] = {}
    for text in words:
        for word in text:
            number.setdefault(word, len(number))
    lengths = np.array([len(text) + 1 for text in words])
    ends = np.cumsum(lengths)
    codes = np.empty(int(ends[-1]), dtype=np.int64)
    codes[ends - 1] = len(number) + np.arange(len(words))
    inner = np.ones(len(codes), dtype=bool)
    inner[ends - 1] = False
    codes[inner] = [number[word] for text in words for word in text]
    starts, sizes, periods = runs_of(codes)
    owner = np.searchsorted(ends, starts, side="right")
    starts = starts - (ends - lengths)[owner]
    runs: list[list[dict]] = [[] for _ in words]
    texts = [b" ".join(text) for text in words]
    fresh = np.append(True, owner[1:] != owner[:-1])[: len(owner)]
    edges = np.append(np.flatnonzero(fresh), len(owner))
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        text, part = int(owner[low]), slice(int(low), int(high))
        listed = zip(starts[part].tolist(), sizes[part].tolist(), periods[part].tolist(), strict=True)
        runs[text] = [{"start": s, "length": n, "period": p} for s, n, p in listed]
        texts[text] = _collapsed(words[text], starts[part], sizes[part], periods[part])
    return runs, texts


RUNS = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))


def periodic_runs(
    documents: DataFrame, key: str = "doc_id", text: str = "text", rewrite: Rewrite | None = None
) -> DataFrame:
    """``key``, ``n_words``, ``runs`` (by start, then period) and ``collapsed`` of every row.

    ``rewrite`` may change the words of a text, given its key, before they are looked at.

    * Words are what white space of ASCII parts; a null text and one without words have no runs, and
      their ``collapsed`` is empty.
    * Runs of several periods may overlap; a word goes if any of them holds it behind its first period.
    * Rows are independent: repeated rows and keys, and null keys, each have their own result.  An empty
      table gives an empty result.  Only the two named columns are read.
    """
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def solved(keys: list, words: list[list[bytes]], kind: pa.DataType) -> pa.RecordBatch:
        runs, texts = _rows(words)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(keys, kind),
                pa.array([len(text) for text in words], pa.int64()),
                pa.array(runs, RUNS),
                pa.array(texts, pa.binary()).cast(pa.string()),
            ],
            names=["key", "n_words", "runs", "collapsed"],
        )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.column("key").type
            keys, words, size = [], [], 0
            for name, content in zip(batch.column("key"), batch.column("text"), strict=True):
                name, found = name.as_py(), (content.as_py() or "").encode("utf-8").split()
                keys.append(name)
                words.append(found if rewrite is None else rewrite(name, found))
                size += len(words[-1]) + 1
                if size >= TOGETHER:
                    yield solved(keys, words, kind)
                    keys, words, size = [], [], 0
            if keys:
                yield solved(keys, words, kind)

    kind = rows.schema["key"].dataType.simpleString()
    runs = "array<struct<start: long, length: long, period: long>>"
    found = rows.mapInArrow(scan, f"key {kind}, n_words long, runs {runs}, collapsed string")
    return found.withColumnRenamed("key", key)


def repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """For a tenth of the ids, by hash, the words with a tail that repeats its first words."""
    if doc_id is None or not words:
        return words
    share, seed = zlib.crc32(str(doc_id).encode()) % 10, zlib.crc32(str(doc_id).encode()) // 10
    if share:
        return words
    n = len(words)
    start = seed % n
    period = 1 + (n - start) // (3 + seed % 8)
    return words[:start] + [words[start + i % period] for i in range(n - start)]


def op12(documents: DataFrame) -> DataFrame:
    """Runs, the longest one, and digests of all runs and of the collapsed text, one row per document."""
    found = periodic_runs(documents, rewrite=repeated_tail)
    # The longest run; of equal ones the first, then the shortest period.
    order = F.transform(
        "runs", lambda r: F.struct(-r["length"], r["start"].alias("start"), r["period"].alias("period"))
    )
    best = F.array_min(order)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") == 0, "").otherwise(F.concat(F.array_join(lines, "\n"), F.lit("\n")))
    ranked = found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        best["start"].alias("start"),
        (-best["col1"]).alias("length"),
        best["period"].alias("period"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
    return ranked.withColumn("exponent_milli", F.expr("length * 1000 div period")).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"
    )
