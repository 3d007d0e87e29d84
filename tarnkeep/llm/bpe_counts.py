"""Token counts of byte-level BPE by rank-synchronous merging of ragged arrays.

Texts are split into pre-tokens, and the distinct pre-tokens of a batch that are not known yet are
held as one ragged array of symbols.  In each round every sequence applies its own lowest-rank
pair, at all places of the sequence at once; sequences without a pair leave.  What is left of a
sequence is its count.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 512
#: Counts of pre-tokens that a task remembers; it starts anew beyond that many.
REMEMBERED = 1_000_000
#: Longer pre-tokens are counted but not remembered.
REMEMBERED_CHARS = 64
#: Characters of pre-tokens that are merged together.
MERGED_TOGETHER = 1 << 20

# Fixed value: the pattern that splits text before merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: itself if printable, else a later one."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, spare = [], 256
    for byte in range(256):
        letters.append(chr(byte if byte in printable else spare))
        spare += byte not in printable
    return letters


class Merges:
    """The merges of a ``tokenizers`` file of kind byte-level BPE, as sorted arrays of pairs."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            parsed = json.load(file)
        model, splitter = parsed["model"], parsed["pre_tokenizer"]
        plain = model["type"] == "BPE" and splitter["type"] == "ByteLevel" and splitter["use_regex"]
        odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix")
        if not plain or splitter["add_prefix_space"] or parsed["normalizer"]:
            raise ValueError("only plain byte-level BPE files are supported")
        if any(model.get(name) for name in odd) or model.get("ignore_merges"):
            raise ValueError("only plain byte-level BPE files are supported")
        vocabulary = model["vocab"]
        self.special = [token["content"] for token in parsed["added_tokens"]]
        self.bytes = np.array([vocabulary[x] for x in byte_letters()], dtype=np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocabulary[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocabulary[b] for _, b in pairs], dtype=np.int64)
        self.width = int(max(vocabulary.values())) + 1
        keys = left * self.width + right
        # Of a pair that is listed twice the later rank holds.
        last = np.unique(keys[::-1], return_index=True)
        self.keys, self.ranks = last[0], len(keys) - 1 - last[1]
        self.made = np.array([vocabulary[a + b] for a, b in pairs], dtype=np.int64)

    def counts(self, pretokens: list[bytes]) -> np.ndarray:
        """The number of symbols that are left of each pre-token."""
        lengths = np.array([len(p) for p in pretokens], dtype=np.int64)
        symbols = self.bytes[np.frombuffer(b"".join(pretokens), dtype=np.uint8)]
        which = np.repeat(np.arange(len(pretokens)), lengths)
        result = lengths.copy()
        none = np.int64(len(self.made))
        while len(symbols) > 1:
            keys = symbols[:-1] * self.width + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            known = (self.keys[at] == keys) & (which[:-1] == which[1:])
            rank = np.append(np.where(known, self.ranks[at], none), none)
            starts = np.flatnonzero(np.append(True, which[1:] != which[:-1]))
            lowest = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(symbols)))
            going = lowest < none
            result[which[starts[~going]]] = sizes[~going]
            if not going.any():
                return result
            target = np.repeat(lowest, sizes)
            stay = np.repeat(going, sizes)
            hit = (rank == target) & stay
            places = np.flatnonzero(hit)
            # A pair of equal symbols overlaps itself: of neighbouring hits every second one counts.
            fresh = np.append(True, np.diff(places) != 1)
            run = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
            places = places[(np.arange(len(places)) - run) % 2 == 0]
            symbols[places] = self.made[target[places]]
            stay[places + 1] = False
            symbols, which = symbols[stay], which[stay]
        if len(symbols):
            result[which[0]] = 1
        return result


class Counter:
    """Counts of whole texts, with a memory of pre-tokens."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.split = regex.compile(PATTERN).findall
        marks = sorted(self.merges.special, key=len, reverse=True)
        self.marks = regex.compile("|".join(map(regex.escape, marks))) if marks else None
        self.known: dict[str, int] = {}

    def _learn(self, pretokens: set[str]) -> dict[str, int]:
        """Counts of new pre-tokens; the short ones are remembered."""
        new, size, found = [], 0, {}
        for token in [*pretokens, None]:
            if token is not None:
                new.append(token)
                size += len(token)
            if new and (token is None or size >= MERGED_TOGETHER):
                counts = self.merges.counts([t.encode("utf-8") for t in new])
                found.update(zip(new, counts.tolist(), strict=True))
                new, size = [], 0
        if len(self.known) > REMEMBERED:
            self.known.clear()
        self.known.update((t, n) for t, n in found.items() if len(t) <= REMEMBERED_CHARS)
        return found

    def counts(self, texts: list[str]) -> list[int]:
        totals = [0] * len(texts)
        split: list[tuple[int, list[str]]] = []
        for i, text in enumerate(texts):
            if self.marks and any(mark in text for mark in self.merges.special):
                pieces = self.marks.split(text)
                totals[i] += len(pieces) - 1
                split.extend((i, self.split(piece)) for piece in pieces)
            else:
                split.append((i, self.split(text)))
        known = self.known
        new = set().union(*(tokens for _, tokens in split)).difference(known)
        if new:
            found = self._learn(new)
            known = self.known
        for i, tokens in split:
            try:
                totals[i] += sum(map(known.__getitem__, tokens))
            except KeyError:
                totals[i] += sum(
                    found[t] if t in found else known.get(t) or self._again(t) for t in tokens
                )
        return totals

    def _again(self, token: str) -> int:
        """A count that was forgotten when the memory was cleared."""
        return self._learn({token})[token]


def _runs(texts: list[str], limit: int = 1 << 20) -> Iterator[list[str]]:
    run, size = [], 0
    for text in texts:
        run.append(text)
        size += len(text)
        if size >= limit:
            yield run
            run, size = [], 0
    if run:
        yield run


def token_counts(
    documents: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    limit: int = LIMIT,
) -> DataFrame:
    """``key``, ``n_bytes``, ``n_tokens`` and ``over_limit`` for every row of ``documents``.

    ``tokenizer`` is the path of a byte-level BPE file in the format of ``tokenizers``, present on
    every executor.  Special strings inside texts are single tokens; none are added.

    * A null text counts as empty: no bytes, no tokens.
    * Each row is counted on its own, so repeated rows and null keys need no care; an empty table
      gives an empty result.  Only the two named columns are read.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(tokenizer)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            counts = [n for run in _runs(texts) for n in counter.counts(run)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                names=["key", "n_bytes", "n_tokens"],
            )

    content = F.coalesce(F.col(text), F.lit(""))
    rows = documents.select(
        F.col(key).alias("key"),
        F.octet_length(content).cast("bigint").alias("n_bytes"),
        content.alias("text"),
    )
    kind = rows.schema["key"].dataType.simpleString()
    counted = rows.mapInArrow(scan, f"key {kind}, n_bytes long, n_tokens long")
    return counted.select(
        F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
