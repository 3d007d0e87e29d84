"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` bytes.  Each passage is encoded (frequencies of kinds of
characters, of their neighbours and of hashed words, then a learned layer); a gated attention
weighs the passages of a document; the weighted sum of their codes is the document's representation,
from which the score is read.  All weights are learned together from document labels alone.

Training runs on a bounded sample of labelled documents (``SAMPLE``), whose passages the tasks turn into
numbers; scoring looks at every passage of every document, in tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tarnkeep.llm.grams import ALPHANUMERIC, U64, Texts, text_pieces, words_of
from tarnkeep.llm.tables import written

#: Most labelled documents that are used for training; the ones with the least hashes of their ids.
SAMPLE = 4_000
#: Most bytes of their passages together, which is what the driver holds: documents that go beyond are passed over.
SAMPLE_BYTES = 64 << 20
#: Bytes of a passage, and the width of its description.
PASSAGE = 512
PAIRS, WORDS = 256, 256
HIDDEN, GATE = 32, 16
EPOCHS, DOCUMENTS, RATE, DECAY = 30, 64, 3e-3, 1e-4
#: Documents that score at least this are of good quality.
THRESHOLD = 0.3


def _kinds() -> np.ndarray:
    """A kind for every byte: each small letter, capitals, digits, each sign, blanks, others."""
    kinds, n = np.zeros(256, dtype=np.int64), 0
    for byte in range(128):
        letter = chr(byte)
        if letter.isupper():
            kinds[byte] = 0
        elif letter.isdigit():
            kinds[byte] = 1
        elif byte < 32 and letter != "\n":
            kinds[byte] = 2
        else:
            kinds[byte] = 5 + n
            n += 1
    kinds[128:192], kinds[192:] = 3, 4
    return kinds


KINDS = _kinds()
N_KINDS = int(KINDS.max()) + 1
WIDTH = N_KINDS + PAIRS + WORDS + 4


def described(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The number of passages of each text (at least one) and the description of all passages."""
    data, offsets = texts
    lengths = np.diff(offsets)
    passages = np.maximum(1, -(-lengths // PASSAGE))
    base = np.cumsum(passages) - passages
    total = int(passages.sum())
    position = np.arange(len(data)) - np.repeat(offsets[:-1], lengths)
    own = np.repeat(base, lengths) + position // PASSAGE
    kinds = KINDS[data]

    def frequencies(which: np.ndarray, values: np.ndarray, width: int) -> np.ndarray:
        counts = np.bincount(which * width + values, minlength=total * width).reshape(total, width)
        return np.sqrt(counts / np.maximum(1, counts.sum(axis=1, keepdims=True)))

    result = np.zeros((total, WIDTH), dtype=np.float32)
    result[:, :N_KINDS] = frequencies(own, kinds, N_KINDS)
    if len(data) > 1:
        pairs = ((kinds[:-1] * N_KINDS + kinds[1:]) * 40503 >> 4) % PAIRS
        inner = offsets[1:-1]
        within = np.ones(len(pairs), dtype=bool)  # pairs that do not reach into the next text
        within[inner[(inner > 0) & (inner < len(data))] - 1] = False
        result[:, N_KINDS : N_KINDS + PAIRS] = frequencies(own[:-1][within], pairs[within], PAIRS)
    found = words_of(texts, ALPHANUMERIC)
    if len(found.starts):
        place = own[found.starts]
        hashed = (found.hashes & U64(WORDS - 1)).astype(np.int64)
        at = N_KINDS + PAIRS
        result[:, at : at + WORDS] = frequencies(place, hashed, WORDS)
        words = np.bincount(place, minlength=total)
        letters = np.bincount(place, weights=found.ends - found.starts, minlength=total)
        result[:, -2] = letters / np.maximum(1, words) / 20
        for lag in (1, 2):  # words that repeat the last one or the one before it
            same = (found.hashes[lag:] == found.hashes[:-lag]) & (place[lag:] == place[:-lag])
            repeats = np.bincount(place[lag:][same], minlength=total)
            result[:, -2 - lag] = repeats / np.maximum(1, words)
    result[:, -1] = np.repeat(np.log1p(lengths) / 12, passages)
    return passages, result


class Model(NamedTuple):
    """Weights of the encoder, of the gated attention and of the score."""

    encode: np.ndarray
    encode_bias: np.ndarray
    tanh: np.ndarray
    gate: np.ndarray
    attend: np.ndarray
    score: np.ndarray
    score_bias: np.ndarray


def _segments(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(counts) - counts, np.repeat(np.arange(len(counts)), counts)


def _forward(model: Model, x: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, tuple]:
    starts, own = _segments(counts)
    codes = np.tanh(x @ model.encode + model.encode_bias)
    tanh, gate = np.tanh(codes @ model.tanh), 1 / (1 + np.exp(-(codes @ model.gate)))
    logits = (tanh * gate) @ model.attend
    weights = np.exp(logits - np.maximum.reduceat(logits, starts)[own])
    weights = weights / np.add.reduceat(weights, starts)[own]
    bags = np.add.reduceat(codes * weights[:, None], starts, axis=0)
    z = np.clip(bags @ model.score + model.score_bias, -30, 30)
    return 1 / (1 + np.exp(-z)), (starts, own, codes, tanh, gate, weights, bags)


def _gradient(model: Model, x: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> Model:
    scores, (starts, own, codes, tanh, gate, weights, bags) = _forward(model, x, counts)
    error = (scores - labels) / len(labels)
    d_bags = error[:, None] * model.score[None, :]
    d_codes = d_bags[own] * weights[:, None]
    pull = (codes * d_bags[own]).sum(axis=1)
    mean = np.add.reduceat(weights * pull, starts)[own]
    d_logits = weights * (pull - mean)
    d_gated = d_logits[:, None] * model.attend[None, :]
    d_tanh = d_gated * gate * (1 - tanh * tanh)
    d_gate = d_gated * tanh * gate * (1 - gate)
    d_codes = d_codes + d_tanh @ model.tanh.T + d_gate @ model.gate.T
    d_inner = d_codes * (1 - codes * codes)
    return Model(
        x.T @ d_inner,
        d_inner.sum(axis=0),
        codes.T @ d_tanh,
        codes.T @ d_gate,
        (tanh * gate).T @ d_logits,
        bags.T @ error,
        error.sum(keepdims=True),
    )


def trained(x: np.ndarray, counts: np.ndarray, labels: np.ndarray, seed: int = 11) -> Model:
    """Weights fitted by Adam to the labels (0 or 1) of documents with ``counts`` passages each."""
    random = np.random.default_rng(seed)
    shapes = [(WIDTH, HIDDEN), (HIDDEN,), (HIDDEN, GATE), (HIDDEN, GATE), (GATE,), (HIDDEN,), (1,)]
    model = Model(*[random.normal(0, 1 / np.sqrt(s[0]), s) for s in shapes])
    rate = np.clip(labels.mean() if len(labels) else 0.5, 0.01, 0.99)
    model = model._replace(
        encode_bias=np.zeros(HIDDEN), score_bias=np.array([np.log(rate / (1 - rate))])
    )
    starts = np.cumsum(counts) - counts
    first = [np.zeros_like(p) for p in model]
    second = [np.zeros_like(p) for p in model]
    step = 0
    for _ in range(EPOCHS if len(labels) else 0):
        order = random.permutation(len(labels))
        for at in range(0, len(order), DOCUMENTS):
            batch = order[at : at + DOCUMENTS]
            rows = np.concatenate([np.arange(starts[i], starts[i] + counts[i]) for i in batch])
            own = x[rows].astype(np.float32, copy=False)
            gradient = _gradient(model, own, counts[batch], labels[batch])
            step += 1
            new = []
            for i, (p, g) in enumerate(zip(model, gradient, strict=True)):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                move = first[i] / (1 - 0.9**step) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
                new.append(p - RATE * (move + DECAY * p))
            model = Model(*new)
    return model


def scores(model: Model, texts: Texts) -> np.ndarray:
    counts, x = described(texts)
    return _forward(model, x, counts)[0]


def held_out(key: Column) -> Column:
    """Whether a document is kept out of training: the CRC-32 of its id as text is a multiple of 5."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def sampled(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``id``, ``label`` and the described passages of at most ``sample`` labelled documents."""
    known = (
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("quality").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
        .withColumnRenamed("doc_id", "id")
    )
    rows = documents.select(F.col("doc_id").alias("id"), "text").join(F.broadcast(known), "id")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, texts in text_pieces(batch.column("text")):
                counts, x = described(texts)
                ends = np.cumsum(counts)
                packed = [
                    x[end - n : end].astype(np.float16).tobytes()
                    for n, end in zip(counts, ends, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(first, last - first),
                        batch.column("label").slice(first, last - first),
                        pa.array(packed, pa.binary()),
                    ],
                    names=["id", "label", "passages"],
                )

    kinds = {field.name: field.dataType.simpleString() for field in rows.schema}
    return rows.select("id", "label", "text").mapInArrow(
        scan, f"id {kinds['id']}, label {kinds['label']}, passages binary"
    )


def _within(found: DataFrame, bound: int) -> list:
    """Ids of described documents, by the hash of their id, whose passages together take at most ``bound`` bytes."""
    sizes = found.groupBy("id").agg(F.sum(F.octet_length("passages")).alias("size"))
    chosen, used = [], 0
    for row in sizes.orderBy(F.xxhash64("id"), "id").collect():
        if used + row["size"] <= bound:
            chosen.append(row["id"])
            used += row["size"]
    return chosen


def fitted(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, bound: int = SAMPLE_BYTES) -> Model:
    """The model of the sample; with no labels, or labels of one kind, little more than their rate.

    The driver holds at most ``sample`` ids and ``bound`` bytes of passages.
    """
    found = written(sampled(documents, labels, sample), "labelled-sample")
    chosen = _within(found, bound)
    ids = found.sparkSession.createDataFrame([(i,) for i in chosen], found.select("id").schema)
    kept = found.join(F.broadcast(ids), "id")
    rows = kept.toArrow().sort_by([("id", "ascending")])
    known = rows["label"].to_numpy().astype(np.float64)
    bags = [np.frombuffer(b.as_buffer(), dtype=np.float16).reshape(-1, WIDTH) for b in rows["passages"]]
    counts = np.array([len(b) for b in bags], dtype=np.int64)
    x = np.concatenate(bags) if bags else np.zeros((0, WIDTH), np.float16)
    # Only the passages are needed from here on, not the table they came in.
    del rows, bags
    return trained(x, counts, known)


def scored(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All rows and columns of ``documents`` with ``score``, the probability of good quality.

    * Null and empty texts are one empty passage, and get the score of that.
    * Equal texts get equal scores; only the text is looked at.
    * An empty table gives an empty result; a column named ``score`` is replaced.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    documents = documents.drop("score")
    names = documents.columns
    place = names.index(text)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, texts in text_pieces(batch.column(place)):
                columns = [c.slice(first, last - first) for c in batch.columns]
                columns.append(pa.array(scores(shared.value, texts), pa.float64()))
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "score"])

    schema = StructType([*documents.schema.fields, StructField("score", DoubleType())])
    return documents.mapInArrow(scan, schema)


def accepted(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``documents`` without those that score below ``threshold``; columns unchanged."""
    own = "score" in documents.columns
    marked = documents.withColumnRenamed("score", "__score") if own else documents
    kept = scored(marked, fitted(documents, labels)).filter(F.col("score") >= threshold)
    kept = kept.drop("score")
    kept = kept.withColumnRenamed("__score", "score") if own else kept
    return kept.select(*documents.columns)


def op4(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Score and prediction of every document."""
    rows = documents.select("doc_id", "text")
    return scored(rows, fitted(documents, labels)).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
