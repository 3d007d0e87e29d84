"""Substring dedup in words, by relative Lempel-Ziv parsing.

A word is removed if a window of ``SPAN`` words covers it that also starts earlier: in a document with a
smaller id, or further to the front of the same one.  Parsing every text against the whole corpus would be
quadratic, so texts and reference are cut alike, by content:

* Of the ``GRAM``-word runs in a window, the one with the least hash is its anchor.  Neighbouring windows
  with one anchor are a piece.  Equal windows have equal anchors, so a window can only recur in pieces with its anchor.
* Pieces whose anchor occurs once are dropped; equal pieces are counted once, at their first place.
* The pieces of an anchor, in the order of their first places, are a reference block.  The pieces of an anchor that has
  too many for one task are cut into their windows, and these are dealt to blocks by hash.
* Each piece is factored greedily: the next factor is the longest match with any earlier piece, found in the
  suffix array of the block.  Windows inside a factor of ``SPAN`` words or more have been seen before; windows that
  cross the end of a factor are looked up one by one.
* Every occurrence of a piece but the first loses all its windows, the first one those seen before.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnkeep.llm.bitmaps import bitmap_of
from tarnkeep.llm.grams import NOT_BLANK, POWERS, U64, Texts, gram_hashes, mixed, set_bits, text_pieces, words_of
from tarnkeep.llm.periodic import Names, named
from tarnkeep.llm.tables import written

SPAN, GRAM = 20, 8
#: Windows with one anchor are at most so many; their set is a number of so many bits.
GRAMS = SPAN - GRAM + 1
#: Pieces that one block should hold; anchors with more are cut into windows.
BLOCK = 4_096
#: Words of blocks that are indexed together; a block is at most ``BLOCK`` pieces, about 130,000 words.
TOGETHER = 1 << 15
#: 2**26 bits are 8 MB.  They spare the shuffle of pieces whose anchor occurs once; a fuller bitmap spares less.
BITS = 26
#: Stands for a null id, so that such documents come last.
LAST = int(np.iinfo(np.int64).max)


class Pieces(NamedTuple):
    """Per piece: its text, first word, words, and hashes of its anchor and of the whole (96 bits)."""

    text: np.ndarray
    first: np.ndarray
    length: np.ndarray
    mark: np.ndarray
    name: np.ndarray
    check: np.ndarray


def pieces_of(texts: Texts) -> Pieces:
    """All pieces of some texts; ``first`` counts words from the start of the text."""
    words = words_of(texts, NOT_BLANK, lower=False)
    hashes, counts = words.hashes, words.counts
    n, none = len(hashes), np.zeros(0, dtype=np.int64)
    ends = np.cumsum(counts)
    fits = np.arange(n) + SPAN <= np.repeat(ends, counts)
    windows = np.flatnonzero(fits)
    if not len(windows):
        return Pieces(none, none, none, none.astype(U64), none.astype(U64), none.astype(np.int32))
    grams = gram_hashes(hashes, GRAM)
    # The upper half orders by hash, the lower one prefers the last of equal hashes.
    low = U64(0xFFFFFFFF)
    keys = (grams & ~low) | (low - np.arange(len(grams), dtype=U64))
    least = keys[: n - SPAN + 1].copy()
    for step in range(1, GRAMS):
        np.minimum(least, keys[step : step + len(least)], out=least)
    chosen = (low - (least[windows] & low)).astype(np.int64)
    fresh = np.append(True, chosen[1:] != chosen[:-1])
    starts = np.flatnonzero(fresh)
    first, anchor = windows[starts], chosen[starts]
    length = windows[np.append(starts[1:], len(windows)) - 1] - first + SPAN
    up, down = POWERS.get(n + 1)
    shape = mixed((anchor - first).astype(U64) + U64(64) * length.astype(U64))
    whole = []
    for salt in (0, 0xA5A5A5A5A5A5A5A5):
        sums = np.zeros(n + 1, dtype=U64)
        np.cumsum(mixed(hashes ^ U64(salt)) * up[:n], out=sums[1:])
        whole.append(mixed((sums[first + length] - sums[first]) * down[first] ^ shape))
    text = words.text[first]
    check = (whole[1] >> U64(32)).astype(np.uint32).view(np.int32)
    return Pieces(text, first - (ends - counts)[text], length, grams[anchor], whole[0], check)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors and how often they occur, 2 standing for more."""
    for batch in batches:
        for _, _, texts in text_pieces(batch.column("text")):
            marks, counts = np.unique(pieces_of(texts).mark, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [_signed(marks), pa.array(np.minimum(counts, 2))], names=["mark", "n"]
            )


class _Index:
    """The suffix array of a block, and longest matches with earlier pieces in it."""

    def __init__(self, codes: np.ndarray, owner: np.ndarray):
        self._names: Names = named(codes)
        self._place = self._names.first[-1]
        self._owner = owner
        # Least owners of 1, 2, 4, ... neighbours in the suffix array.
        self._least = [owner[self._names.suffixes]]
        while 2 * len(self._least[-1]) > len(codes) + 1:
            width = 1 << (len(self._least) - 1)
            last = self._least[-1]
            if len(last) <= width:
                break
            self._least.append(np.minimum(last[:-width], last[width:]))

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that the suffixes at ``a`` and at ``b`` have in common at their starts."""
        start = a
        for level in range(len(self._names.first) - 1, -1, -1):
            name = self._names.first[level]
            same = (name[a] == name[b]) << level
            a, b = a + same, b + same
        return a - start

    def longest(self, at: np.ndarray) -> np.ndarray:
        """The longest match of each position with any piece before its own.

        It is at the nearest suffix to the left or right in the suffix array that belongs to an
        earlier piece.
        """
        own, n = self._owner[at], len(self._owner)
        best = np.zeros(len(at), dtype=np.int64)
        left = self._place[at].astype(np.int64)
        right = left + 1
        for level in range(len(self._least) - 1, -1, -1):
            least, width = self._least[level], 1 << level
            near = left >= width
            near &= least[np.maximum(left - width, 0)] >= own
            left = left - width * near
            near = right + width <= n
            near &= least[np.minimum(right, len(least) - 1)] >= own
            right = right + width * near
        for other, some in ((left - 1, left > 0), (right, right < n)):
            found = np.flatnonzero(some)
            match = self._common(at[found], self._names.suffixes[other[found]])
            best[found] = np.maximum(best[found], match)
        return best


def seen_before(pieces: list[list[bytes]]) -> list[int]:
    """For each piece (its words) the set of its windows that earlier pieces have, as bits.

    Pieces are parsed greedily into longest matches with earlier ones.
    """
    number: dict[bytes, int] = {}
    for piece in pieces:
        for word in piece:
            number.setdefault(word, len(number))
    lengths = np.array([len(piece) for piece in pieces])
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    codes = np.empty(int(ends[-1]) + 1, dtype=np.int64)
    codes[ends] = len(number) + np.arange(len(pieces))
    inner = np.ones(len(codes), dtype=bool)
    inner[ends] = False
    codes[inner] = [number[word] for piece in pieces for word in piece]
    owner = np.repeat(np.arange(len(pieces)), lengths + 1)
    index = _Index(codes, owner)
    # Windows start up to here; later factors cannot be long enough.
    last = ends - SPAN
    change = np.zeros(len(codes) + 1, dtype=np.int64)
    cut = np.zeros(len(codes), dtype=bool)
    active, at = np.arange(len(pieces)), starts.copy()
    while len(active):
        length = index.longest(at)
        cut[at] = True
        long = length >= SPAN
        np.add.at(change, at[long], 1)
        np.add.at(change, at[long] + length[long] - SPAN + 1, -1)
        at = at + np.maximum(length, 1)
        going = at <= last[active]
        active, at = active[going], at[going]
    seen = np.cumsum(change[:-1]) > 0
    # Windows that start within a factor and end behind it.
    within = np.arange(len(codes)) <= last[owner]
    across = np.flatnonzero(within & ~seen & ~cut)
    seen[across[index.longest(across) >= SPAN]] = True
    hit = np.flatnonzero(seen)
    bits = np.zeros(len(pieces), dtype=np.int64)
    np.bitwise_or.at(bits, owner[hit], np.left_shift(1, hit - starts[owner[hit]]))
    return bits.tolist()


PIECE = pa.schema(
    [
        ("mark", pa.int64()),
        ("part", pa.int64()),
        ("name", pa.int64()),
        ("check", pa.int32()),
        ("id", pa.int64()),
        ("row", pa.int64()),
        ("start", pa.int32()),
        ("window", pa.int32()),
        ("bytes", pa.binary()),
    ]
)
PIECE_TYPES = "mark long, part long, name long, check int, id long, row long, start int, window int, bytes binary"
SOLVED_TYPES = "name long, check int, id long, row long, start int, seen long"


def _spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the pieces wanted of each text, cut into windows where ``parts`` is over 1."""
    for batch in batches:
        for doc, row, text, wanted in zip(*(batch.column(c) for c in ("id", "row", "text", "wanted")), strict=True):
            doc, row, words = doc.as_py(), row.as_py(), text.as_py().encode("utf-8").split()
            rows = []
            for want in wanted.as_py():
                first, length, parts = want["start"], want["length"], want["parts"]
                head, place = (want["mark"],), (want["name"], want["check"], doc, row, first)
                if parts == 1:
                    rows.append((*head, 0, *place, 0, b" ".join(words[first : first + length])))
                    continue
                for window in range(length - SPAN + 1):
                    content = b" ".join(words[first + window : first + window + SPAN])
                    rows.append((*head, zlib.crc32(content) % parts, *place, window, content))
            columns = zip(zip(*rows, strict=True), PIECE.types, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], schema=PIECE)


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From pieces sorted by block and first place: the windows of each that were seen before."""

    def solve(table: pa.Table) -> pa.RecordBatch:
        listed = table.select(["name", "check", "id", "row", "start", "window"]).to_pandas()
        fresh = ~listed.duplicated().to_numpy()  # a repeated row brings its pieces again
        listed, content = listed[fresh], table.column("bytes").filter(pa.array(fresh)).to_pylist()
        bits = np.array(seen_before([c.split(b" ") for c in content]), dtype=np.int64)
        listed["seen"] = bits << listed.pop("window").to_numpy()
        return pa.RecordBatch.from_pandas(listed, preserve_index=False)

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size * 2 * SPAN < TOGETHER:
            continue
        table = pa.Table.from_batches(held)
        mark, part = (table.column(c).to_numpy() for c in ("mark", "part"))
        other = np.flatnonzero((mark != mark[-1]) | (part != part[-1]))
        if len(other):  # the last block may go on
            yield solve(table.slice(0, int(other[-1]) + 1))
            table = table.slice(int(other[-1]) + 1)
        held, size = table.to_batches(), table.num_rows
    if size:
        yield solve(pa.Table.from_batches(held))


def telling_seed(documents: DataFrame, identity: Column, content: Column) -> int:
    """A seed under which the hash of the text tells apart all texts of one id."""
    seed = 0
    while True:
        digest = F.sha2(content.cast("binary"), 256)
        texts = documents.select(identity.alias("id"), F.xxhash64(F.lit(seed), content).alias("row"), digest.alias("d"))
        both = texts.groupBy("id", "row").agg(F.min("d").alias("low"), F.max("d").alias("high"))
        if both.filter("low <> high").isEmpty():
            return seed
        seed += 1


def _numbered(documents: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, ``id`` and ``row``, which name a document and order it, and ``text``."""
    content = F.coalesce(F.col(text), F.lit(""))
    identity = F.coalesce(F.col(key).cast("bigint"), F.lit(LAST))
    row = F.xxhash64(F.lit(telling_seed(documents, identity, content)), content)
    return documents.select(F.col(key).alias("key"), identity.alias("id"), row.alias("row"), content.alias("text"))


def occurrences(numbered: DataFrame) -> DataFrame:
    """All pieces with an anchor that may occur again: where they are, their anchor and name."""
    counted = numbered.select("text").mapInArrow(_marks, "mark long, n long")
    again = counted.groupBy("mark").agg(F.sum("n").alias("n")).filter("n > 1")
    shared = numbered.sparkSession.sparkContext.broadcast(bitmap_of(again, F.col("mark"), BITS))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, texts in text_pieces(batch.column("text")):
                found = pieces_of(texts)
                hit = set_bits(shared.value, found.mark)
                at = pa.array(found.text[hit] + first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(at),
                        batch.column("row").take(at),
                        pa.array(found.first[hit].astype(np.int32)),
                        pa.array(found.length[hit].astype(np.int32)),
                        _signed(found.mark[hit]),
                        _signed(found.name[hit]),
                        pa.array(found.check[hit]),
                    ],
                    names=["id", "row", "start", "length", "mark", "name", "check"],
                )

    kinds = "id long, row long, start int, length int, mark long, name long, check int"
    result = written(numbered.select("id", "row", "text").mapInArrow(scan, kinds), "factor-occurrences")
    shared.destroy()
    return result


def removals(numbered: DataFrame) -> DataFrame:
    """``id``, ``row`` and ``lost`` of every document that loses words.

    ``lost`` are sorted numbers: a first window times ``2**GRAMS`` plus the windows from it on that go, as bits.
    """
    found = occurrences(numbered)
    pieces = found.groupBy("mark", "name", "check").agg(
        F.min(F.struct("id", "row", "start")).alias("least"),
        F.any_value("length").alias("length"),
        F.count("*").alias("times"),
    )
    anchors = pieces.groupBy("mark").agg(F.count("*").alias("kinds"), F.sum("times").alias("all"))
    windows = F.lit(GRAMS) * F.col("kinds")
    parts = F.when(F.col("kinds") > BLOCK, F.ceil(windows / BLOCK)).otherwise(1)
    anchors = anchors.filter("all > 1").select("mark", parts.cast("bigint").alias("parts"))
    wanted = pieces.join(anchors, "mark").groupBy("least.id", "least.row").agg(
        F.collect_list(F.struct("least.start", "length", "mark", "name", "check", "parts")).alias("wanted")
    )
    texts = numbered.select("id", "row", "text").join(wanted, ["id", "row"])
    spelled = texts.dropDuplicates(["id", "row"]).mapInArrow(_spelled, PIECE_TYPES)
    order = ["mark", "part", "id", "row", "start", "window"]
    blocks = spelled.repartition("mark", "part").sortWithinPartitions(*order)
    solved = blocks.mapInArrow(_solved, SOLVED_TYPES).groupBy("name", "check").agg(
        F.bit_or("seen").alias("seen"), F.any_value(F.struct("id", "row", "start")).alias("least")
    )
    solved = written(solved, "factor-solved")
    whole = F.expr(f"shiftleft(1L, length - {SPAN} + 1) - 1")
    lost = F.when(F.struct("id", "row", "start") == F.col("least"), F.col("seen")).otherwise(whole)
    hit = found.join(solved, ["name", "check"]).withColumn("lost", lost).filter("lost <> 0")
    packed = F.shiftleft(F.col("start").cast("bigint"), GRAMS) + F.col("lost")
    return hit.groupBy("id", "row").agg(F.sort_array(F.collect_list(packed)).alias("lost"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words, the spans of removed words, and the words that stay."""
    for batch in batches:
        counts, spans, kept = [], [], []
        for text, lost in zip(batch.column("text"), batch.column("lost"), strict=True):
            words = text.as_py().encode("utf-8").split()
            counts.append(len(words))
            if not lost.is_valid:
                spans.append([])
                kept.append(b" ".join(words))
                continue
            packed = lost.values.to_numpy()
            bits = (packed[:, None] >> np.arange(GRAMS)) & 1
            windows = ((packed >> GRAMS)[:, None] + np.arange(GRAMS))[bits == 1]
            change = np.zeros(len(words) + 1, dtype=np.int64)
            np.add.at(change, windows, 1)
            np.add.at(change, windows + SPAN, -1)
            gone = np.cumsum(change[:-1]) > 0
            edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]))).reshape(-1, 2)
            spans.append([{"start": int(a), "length": int(b - a)} for a, b in edges])
            kept.append(b" ".join([words[i] for i in np.flatnonzero(~gone).tolist()]))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("key"),
                pa.array(counts, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ],
            names=["key", "n_words", "spans", "kept"],
        )


def without_repeats(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_words``, ``spans`` (of removed words) and ``kept``, the other words, of every row.

    * Words are what white space of ASCII parts; null texts have none, and texts of fewer than ``SPAN`` words
      lose nothing.
    * ``key`` is an integer; null keys come after all others.  Different texts with one key are ordered by a
      hash; repeated rows are one document, so each has its result.
    * An empty table gives an empty result.  Only the two named columns are read.
    """
    numbered = _numbered(documents, key, text)
    lost = written(removals(numbered), "factor-spans")
    joined = numbered.join(lost, ["id", "row"], "left").select("key", "text", "lost")
    kind = joined.schema["key"].dataType.simpleString()
    spans = "array<struct<start: long, length: long>>"
    result = joined.mapInArrow(_cut, f"key {kind}, n_words long, spans {spans}, kept string")
    return result.withColumnRenamed("key", key)


def op13(documents: DataFrame) -> DataFrame:
    """Words, removed words and a digest of what stays, one row per document."""
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, span: total + span["length"])
    return without_repeats(documents).select(
        "doc_id",
        "n_words",
        removed.alias("n_removed"),
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )
