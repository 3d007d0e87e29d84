"""Benchmark decontamination by winnowing.

Words of documents and benchmark items are hashed in runs of ``GRAM``; of every ``WINDOW - GRAM + 1``
neighbouring runs the one with the least hash is kept as a fingerprint (the last of equal ones).  Any
shared span of ``WINDOW`` words therefore keeps the same fingerprint at the same place on both sides.
Fingerprints of documents are joined with those of the items, and every hit is extended: all
windows around it are compared with the windows of the items, word by word.

Items of fewer than ``WINDOW`` words are one window.  The guarantee does not reach so short a span,
so for the lengths that such items have (nine at most) every run of words is a fingerprint.

A bitmap of the items' fingerprints, of fixed size, spares the shuffle of most others.  Findings
depend on the text alone and are made once for equal texts, under the SHA-256 of the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnkeep.llm.bitmaps import bitmap_of
from tarnkeep.llm.grams import ALPHANUMERIC, LOWER, Words, gram_hashes, set_bits, text_pieces, words_of
from tarnkeep.llm.tables import written

#: Words of a window that counts as contamination, and words of a fingerprint.
WINDOW, GRAM = 10, 5

_ANCHORS = pa.list_(
    pa.struct(
        [
            ("fingerprint", pa.int64()),
            ("size", pa.int32()),
            ("first", pa.int64()),
            ("words", pa.list_(pa.string())),
        ]
    )
)
_ANCHORS_SQL = "array<struct<fingerprint:long,size:int,first:long,words:array<string>>>"


def chosen(found: Words) -> tuple[np.ndarray, np.ndarray]:
    """The position that each window selects, in order of all words, and the hash at every position.

    Windows that cross from one text to the next have one too; it means nothing.
    """
    grams = gram_hashes(found.hashes, GRAM)
    n = len(found.hashes) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64), grams
    best, place = grams[:n].copy(), np.arange(n)
    for j in range(1, WINDOW - GRAM + 1):
        later = grams[j : j + n] <= best
        best[later] = grams[j : j + n][later]
        place[later] = np.flatnonzero(later) + j
    return place, grams


def selected(found: Words) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the kept fingerprints among all words, and the hash at every position."""
    place, grams = chosen(found)
    inside = found.text[: len(place)] == found.text[WINDOW - 1 :]
    return np.unique(place[inside]), grams


def _sized(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of all runs of ``size`` words that stay in one text."""
    grams = gram_hashes(found.hashes, size)
    inside = np.flatnonzero(found.text[: len(grams)] == found.text[size - 1 :])
    return inside, grams[inside]


def _texts(data: np.ndarray, found: Words, first: int, last: int) -> list[str]:
    return [
        data[found.starts[i] : found.ends[i]].tobytes().decode("utf-8", "replace")
        for i in range(first, last)
    ]


def item_windows(items: DataFrame) -> DataFrame:
    """From ``item_id`` and ``text``: ``item_id``, ``size``, ``window`` and ``fingerprint``.

    One row per window; ``fingerprint`` is the one that this window selects, as it does in any text.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, texts in text_pieces(batch.column("text")):
                found, low = words_of(texts, ALPHANUMERIC), LOWER[texts.data]
                place, grams = chosen(found)
                ends = np.cumsum(found.counts)
                rows: list[tuple[int, int, str, int]] = []
                for item, (end, count) in enumerate(zip(ends, found.counts, strict=True)):
                    start = end - count
                    words = _texts(low, found, start, end)
                    if 0 < count < WINDOW:
                        mark = gram_hashes(found.hashes[start:end], int(count))[0]
                        rows.append((item, count, " ".join(words), int(mark.view(np.int64))))
                    for i in range(count - WINDOW + 1):
                        mark = grams[place[start + i]]
                        window = " ".join(words[i : i + WINDOW])
                        rows.append((item, WINDOW, window, int(mark.view(np.int64))))
                which = pa.array([row[0] for row in rows], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("item_id").slice(first, last - first).take(which),
                        pa.array([row[1] for row in rows], pa.int32()),
                        pa.array([row[2] for row in rows], pa.string()),
                        pa.array([row[3] for row in rows], pa.int64()),
                    ],
                    names=["item_id", "size", "window", "fingerprint"],
                )

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", "text").mapInArrow(
        scan, f"item_id {kind}, size int, window string, fingerprint long"
    )


def anchored(documents: DataFrame, bitmap: np.ndarray, sizes: list[int]) -> DataFrame:
    """From ``key`` and ``text``: ``key``, ``n_words`` and the fingerprints that may hit, in context.

    ``first`` is the number of the first of ``words``, which hold every window around the hit.
    """
    shared = documents.sparkSession.sparkContext.broadcast(bitmap)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            for first, last, texts in text_pieces(batch.column("text")):
                found, low = words_of(texts, ALPHANUMERIC), LOWER[texts.data]
                ends = np.cumsum(found.counts)
                begins = ends - found.counts
                anchors: list[list[dict]] = [[] for _ in range(last - first)]

                def add(at: int, size: int, mark: np.uint64, before: int, after: int) -> None:
                    text = found.text[at]
                    low_word = max(begins[text], at - before)
                    high_word = min(ends[text], at + after)
                    anchors[text].append(
                        {
                            "fingerprint": int(mark.view(np.int64)),
                            "size": size,
                            "first": int(low_word - begins[text]),
                            "words": _texts(low, found, low_word, high_word),
                        }
                    )

                kept, grams = selected(found)
                for at in kept[set_bits(bits, grams[kept])]:
                    add(at, WINDOW, grams[at], WINDOW - GRAM, WINDOW)
                for size in sizes:
                    places, marks = _sized(found, size)
                    hit = set_bits(bits, marks)
                    for at, mark in zip(places[hit], marks[hit], strict=True):
                        add(at, size, mark, 0, size)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").slice(first, last - first),
                        pa.array(found.counts.astype(np.int64)),
                        pa.array(anchors, _ANCHORS),
                    ],
                    names=["key", "n_words", "anchors"],
                )

    kind = documents.schema["key"].dataType.simpleString()
    return documents.select("key", "text").mapInArrow(
        scan, f"key {kind}, n_words long, anchors {_ANCHORS_SQL}"
    )


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def contaminated(
    documents: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``id``, ``digest``, ``n_words``, ``spans`` and ``items`` for every row of ``documents``.

    ``spans`` are the hit words as an array of (``first``, ``last``), counted from 0, ``last`` not
    included, merged where they meet; ``items`` are the ids, as sorted text, of the items of which
    a window occurs.

    * Null texts and texts without words have no words, spans or items; so have items.
    * Repeated items count once.  An item with a null id makes spans but is not listed.
    * Equal documents get equal results; empty tables give empty results.  Only the named columns
      are read, so others may have any name.
    """
    windows = written(
        item_windows(items.select(F.col(item).alias("item_id"), F.col(item_text).alias("text"))),
        "benchmark-windows",
    )
    marks = windows.select("fingerprint", "size").distinct()
    sizes = sorted(
        row["size"] for row in windows.select("size").distinct().collect() if row["size"] < WINDOW
    )
    bitmap = bitmap_of(windows, F.col("fingerprint"))
    content = F.col(text)
    rows = documents.select(
        F.struct(F.col(key).alias("id"), digest(content).alias("digest")).alias("key"),
        content.alias("text"),
    )
    scanned = written(anchored(rows, bitmap, sizes), "document-fingerprints")
    hits = (
        scanned.filter(F.size("anchors") > 0)
        .select(F.col("key.digest").alias("digest"), F.inline("anchors"))
        .join(marks, ["fingerprint", "size"], "left_semi")
        .withColumn("at", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("size"))))
        .select(
            "digest",
            "size",
            (F.col("first") + F.col("at")).alias("first"),
            F.array_join(F.expr("slice(words, at + 1, size)"), " ").alias("window"),
        )
        .distinct()
        .join(windows.select("window", "size", "item_id").distinct(), ["window", "size"])
    )
    found = hits.groupBy("digest").agg(
        F.array_sort(F.collect_set(F.struct("first", (F.col("first") + F.col("size")).alias("last")))).alias(
            "spans"
        ),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
    )
    found = found.withColumn("spans", _merged(F.col("spans")))
    none = F.expr("cast(array() as array<struct<first:bigint,last:bigint>>)")
    return (
        scanned.select("key.id", "key.digest", "n_words")
        .join(found, "digest", "left")
        .select(
            "id",
            "digest",
            "n_words",
            F.coalesce("spans", none).alias("spans"),
            F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
        )
    )


def _merged(spans: Column) -> Column:
    """Sorted spans, with those that overlap or touch made one."""
    none = F.expr("cast(array() as array<struct<first:bigint,last:bigint>>)")
    state = F.struct(
        none.alias("done"), F.lit(-1).cast("bigint").alias("first"), F.lit(-1).cast("bigint").alias("last")
    )

    def closed(acc: Column) -> Column:
        own = F.array(F.struct(acc["first"].alias("first"), acc["last"].alias("last")))
        return F.when(acc["first"] < 0, acc["done"]).otherwise(F.concat(acc["done"], own))

    def step(acc: Column, x: Column) -> Column:
        goes_on = (acc["first"] >= 0) & (x["first"] <= acc["last"])
        return F.when(
            goes_on,
            F.struct(
                acc["done"].alias("done"),
                acc["first"].alias("first"),
                F.greatest(acc["last"], x["last"]).alias("last"),
            ),
        ).otherwise(
            F.struct(
                closed(acc).alias("done"), x["first"].alias("first"), x["last"].alias("last")
            )
        )

    return F.aggregate(spans, state, step, closed)


def decontaminated(
    documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``documents`` without those in which a window of an item occurs; columns unchanged."""
    bad = contaminated(documents, items, key, text).filter(F.size("spans") > 0)
    bad = written(bad.select(F.col("digest").alias("__digest")).distinct(), "contaminated")
    marked = documents.withColumn("__digest", digest(F.col(text)))
    return marked.join(bad, "__digest", "left_anti").select(*documents.columns)


def op1(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Counts of words and hit words, and a digest of the items, one row per document."""
    n_hit = F.aggregate(
        "spans", F.lit(0).cast("bigint"), lambda acc, s: acc + s["last"] - s["first"]
    )
    return contaminated(documents, items).select(
        F.col("id").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
