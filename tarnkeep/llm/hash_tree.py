"""Sharding by a hierarchical weighted hash tree.

A tree has regions, racks in regions and shards in racks.  A row descends it: at each level every
child of the chosen node gets a draw from the hash of (level, node, key), divided by the weight of
the child, and the smallest draw ``-ln(u) / weight`` wins.  Draws of a node do not depend on its
siblings, so a changed weight moves rows only into or out of the subtree whose weight changed;
rows never move between two nodes that both kept their weights.

The law of :func:`layout` is ``key``: the key and the number of shards decide.  Shards beyond the
planned size each open a region of their own, so one more shard takes rows only into itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLANNED = 40
PER_RACK = 5
RACKS = 2
#: Groups in which the rows of one shard are numbered; more make smaller sorts.
SLOT_BUCKETS = 256


class Leaf(NamedTuple):
    """A shard, where it stands, and its weight (0 takes nothing)."""

    region: int
    rack: int
    shard: int
    weight: float = 1.0


def layout(
    shards: int, planned: int = PLANNED, per_rack: int = PER_RACK, racks: int = RACKS
) -> list[Leaf]:
    """Equal shards: ``planned`` of them in full regions, each later one in its own region."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    size = per_rack * racks
    full = -(-planned // size)
    return [
        Leaf(s // size, s // per_rack, s)
        if s < planned
        else Leaf(full + s - planned, full * racks + s - planned, s)
        for s in range(shards)
    ]


def _children(leaves: Sequence[Leaf]) -> tuple[Column, Column, Column]:
    """The regions, the racks by region and the shards by rack, each child with its weight."""
    regions: dict[int, float] = {}
    racks: dict[int, dict[int, float]] = {}
    shards: dict[int, dict[int, float]] = {}
    for region, rack, shard, weight in leaves:
        if weight > 0:
            regions[region] = regions.get(region, 0.0) + weight
            inside = racks.setdefault(region, {})
            inside[rack] = inside.get(rack, 0.0) + weight
            shards.setdefault(rack, {})[shard] = float(weight)
    if not regions:
        raise ValueError("no shard has a weight above 0")

    def listed(weights: dict[int, float]) -> Column:
        return F.array(
            *[
                F.struct(F.lit(node).alias("node"), F.lit(weight).alias("weight"))
                for node, weight in sorted(weights.items())
            ]
        )

    def by_parent(levels: dict[int, dict[int, float]]) -> Column:
        pairs = [part for key in sorted(levels) for part in (F.lit(key), listed(levels[key]))]
        return F.create_map(*pairs)

    return listed(regions), by_parent(racks), by_parent(shards)


def _drawn(children: Column, level: str, key: Column) -> Column:
    """The child with the smallest weighted draw; equal draws go to the smaller node."""

    def draw(child: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(level), child["node"], key), 11)
        unit = (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
        return F.struct((-F.ln(unit) / child["weight"]).alias("draw"), child["node"].alias("node"))

    return F.array_min(F.transform(children, draw))["node"]


def place(frame: DataFrame, key: Column, leaves: Sequence[Leaf], prefix: str = "") -> DataFrame:
    """Add ``region``, ``rack`` and ``shard`` (with ``prefix``), which ``key`` alone decides.

    A null key counts as the text ``null``.  Rows with equal keys share a shard.  Columns of these
    names are replaced.  No shuffle.
    """
    regions, racks, shards = _children(leaves)
    text = F.coalesce(key.cast("string"), F.lit("null"))
    region, rack, shard = (f"{prefix}{name}" for name in ("region", "rack", "shard"))
    frame = frame.withColumn("__key", text)
    frame = frame.withColumn(region, _drawn(regions, "region", F.col("__key")))
    frame = frame.withColumn(
        rack, _drawn(F.element_at(racks, F.col(region)), "rack", F.col("__key"))
    )
    frame = frame.withColumn(
        shard, _drawn(F.element_at(shards, F.col(rack)), "shard", F.col("__key"))
    )
    return frame.drop("__key")


def numbered(
    frame: DataFrame, keys: DataFrame, order: Sequence[str], buckets: int = SLOT_BUCKETS
) -> DataFrame:
    """Add ``slot``: 0, 1, 2 ... in each ``shard``, ordered by bucket and then by ``order``.

    ``keys`` has the same rows as ``frame``, with at least ``shard`` and the first column of
    ``order``, whose hash gives the bucket.  Counts of each shard and bucket give the first slot of
    a bucket, so no task numbers a whole shard.
    """

    def bucketed(rows: DataFrame) -> DataFrame:
        number = F.xxhash64(F.lit("slot"), F.col(order[0]))
        return rows.withColumn("__bucket", F.pmod(number, F.lit(buckets)).cast("int"))

    counts = bucketed(keys).groupBy("shard", "__bucket").agg(F.count("*").alias("__n"))
    before = F.expr(
        "sum(__n) OVER (PARTITION BY shard ORDER BY __bucket"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    )
    first = counts.select("shard", "__bucket", F.coalesce(before, F.lit(0)).alias("__first"))
    ordered = ", ".join(f"`{name}`" for name in order)
    within = F.expr(f"row_number() OVER (PARTITION BY shard, __bucket ORDER BY {ordered})")
    joined = bucketed(frame).join(first, ["shard", "__bucket"])
    slot = (F.col("__first") + within - 1).cast("bigint")
    return joined.withColumn("slot", slot).drop("__bucket", "__first")


def sharded(
    documents: DataFrame,
    shards: int = PLANNED,
    key: str = "doc_id",
    text: str = "text",
    leaves: Sequence[Leaf] | None = None,
) -> DataFrame:
    """All rows and columns of ``documents`` with ``region``, ``rack``, ``shard`` and ``slot``.

    * A null key is placed as the text ``null``; a null text comes first in the order of slots.
    * Rows with the same key share a shard; full copies take slots in any order.
    * An empty table gives an empty result; columns of the added names are replaced.
    """
    leaves = leaves or layout(shards)
    clean = documents.drop("region", "rack", "shard", "slot")
    rows = place(clean, F.col(key), leaves).withColumn("__crc", F.crc32(F.col(text).cast("binary")))
    keys = place(clean.select(key), F.col(key), leaves)
    return numbered(rows, keys, [key, "__crc"]).drop("__crc")


def op6(documents: DataFrame, shards: int = PLANNED) -> DataFrame:
    """The digest of the placement: size, checksum, shard and slot, and the shard with one more."""
    content = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = documents.select(
        "doc_id",
        (F.octet_length(content) + 16).cast("bigint").alias("size"),
        F.crc32(content).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    rows = place(rows, F.col("doc_id"), layout(shards))
    rows = place(rows, F.col("doc_id"), layout(shards + 1), "grown_")
    keys = place(documents.select("doc_id"), F.col("doc_id"), layout(shards))
    slots = numbered(rows, keys, ["doc_id", "text_crc32"])
    return slots.select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "region", "rack"
    )
