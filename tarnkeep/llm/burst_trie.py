"""The prefix trie of conversations, as a burst trie.

Conversations with equal turns are one sequence.  All sequences start in one container under the root.  A container with
more than ``CONTAINER`` turns bursts: its prefix becomes a head of the trie, and its sequences go to new containers by their
next turn.  Rounds of bursting look at 1, 2, 4, ... further turns at once, and only at sequences whose containers are
too large.  What remains are containers of bounded size, which tasks sort and sweep into nodes, and containers of a single
sequence, each of whose turns is a node.  Sums over the subtrees of heads come from sums over their sequences.

A conversation may be of any length: turns stay rows, and positions and names of prefixes are running values over
rows that are sorted across tasks, whose totals are carried over from task to task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tarnkeep.llm.tables import written

#: Turns of a container that need not burst; a task holds one such container at a time.
CONTAINER = 4_096
#: Every conversation takes its first turns, fewer than ``HEADS``, from the first one of its ``FAMILY``.
HEADS, FAMILY = 4, 20
WORDS = r"[^\x20\x09-\x0D]+"
NOTHING = hashlib.sha256(b"").hexdigest()


def _running(values: np.ndarray, starts: np.ndarray, carried: int, combine: np.ufunc, undo: np.ufunc) -> np.ndarray:
    """Running values within groups that begin at ``starts``; the first group goes on from ``carried``."""
    total = combine.accumulate(values)
    base = np.zeros(len(values), dtype=np.int64)
    inner = starts[starts > 0]
    lengths = np.diff(np.append(inner, len(values)))
    if len(inner):
        base[inner[0] :] = np.repeat(total[inner - 1], lengths)
    result = undo(total, base)
    head = int(inner[0]) if len(inner) else len(values)
    if not len(starts) or starts[0] != 0:
        result[:head] = combine(result[:head], np.int64(carried))
    return result


def running(rows: DataFrame, key: str, order: list[Column], xors: list[str], sums: list[str]) -> DataFrame:
    """``rows`` with ``nth`` (from 0) and the running values of some columns within each ``key``, itself included.

    Rows are sorted across all tasks, so that a key may have any number of rows; the totals of the keys that
    begin in one task and go on in another, at most one per task, are added afterwards.
    """
    with_part = rows.repartitionByRange(F.col(key), *order).sortWithinPartitions(F.col(key), *order)
    with_part = with_part.withColumn("part", F.spark_partition_id().cast("bigint"))
    names = ["nth", *xors, *sums]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carried = None, dict.fromkeys(names, 0)
        for batch in batches:
            keys = batch.column(key).to_numpy()
            if not len(keys):
                continue
            fresh = np.append(last is None or keys[0] != last, keys[1:] != keys[:-1])
            starts, last = np.flatnonzero(fresh), keys[-1]
            made = {}
            for name in names:
                values = np.ones(len(keys), dtype=np.int64) if name == "nth" else batch.column(name).to_numpy()
                how = (np.bitwise_xor, np.bitwise_xor) if name in xors else (np.add, np.subtract)
                made[name] = _running(values, starts, carried[name], *how)
                carried[name] = int(made[name][-1])
            made["nth"] -= 1
            for name, values in made.items():
                values = pa.array(values, pa.int64())
                if name in batch.schema.names:
                    batch = batch.set_column(batch.schema.names.index(name), name, values)
                else:
                    batch = batch.append_column(name, values)
            yield batch

    schema = StructType([*with_part.schema, StructField("nth", LongType())])
    found = written(with_part.mapInArrow(scan, schema), "trie-running")
    parts = found.groupBy(F.col(key).alias("k"), F.col("part").alias("p")).agg(
        *(F.max_by(name, "nth").alias(name) for name in [*xors, *sums]), (F.max("nth") + 1).alias("nth")
    )
    before = Window.partitionBy("k").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    totals = [F.bit_xor(name).over(before).alias(f"__{name}") for name in xors]
    totals += [F.sum(name).over(before).alias(f"__{name}") for name in ["nth", *sums]]
    spread = parts.groupBy("k").agg(F.count("*").alias("__n")).filter("__n > 1").select("k")
    offsets = parts.join(spread, "k").select("k", "p", *totals).filter("__nth IS NOT NULL")
    # Two rows for each task at most.
    joined = found.join(F.broadcast(offsets), (F.col(key) == F.col("k")) & (F.col("part") == F.col("p")), "left")
    zero = F.lit(0).cast("bigint")
    values = {name: F.col(name).bitwiseXOR(F.coalesce(f"__{name}", zero)) for name in xors}
    values |= {name: F.col(name) + F.coalesce(f"__{name}", zero) for name in ["nth", *sums]}
    return joined.withColumns(values).select(*rows.columns, "nth")


def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv``, ``pos`` (from 0), ``id`` (a 128-bit name of role and text) and ``tokens`` of every turn."""
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv"),
        F.col("turn").alias("turn"),
        role.alias("role"),
        text.alias("text"),
    )
    name = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    return running(rows, "conv", order, [], []).select(
        "conv",
        F.col("nth").alias("pos"),
        F.unhex(F.md5(name.cast("binary"))).alias("id"),
        F.regexp_count("text", F.lit(WORDS)).cast("bigint").alias("tokens"),
    )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All conversations (``conv``) and their turns, with heads from the first conversation of each family."""
    borrowed = F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS
    base = F.col("conv") - F.pmod(F.col("conv"), F.lit(FAMILY))
    turns = written(turns, "trie-turns")
    convs = turns.groupBy("conv").agg(F.lit(1).alias("one")).select("conv", base.alias("base"), borrowed.alias("h"))
    first = turns.filter((F.col("pos") < HEADS) & (F.col("conv") == base))
    heads = convs.join(first.withColumnRenamed("conv", "base"), "base").filter("pos < h")
    lengths = first.groupBy(F.col("conv").alias("base")).agg(F.count("*").alias("n"))
    own = turns.withColumns({"h": borrowed, "base": base}).filter("pos >= h").join(lengths, "base", "left")
    shift = F.least(F.col("h"), F.coalesce("n", F.lit(0))) - F.col("h")
    columns = ["conv", "pos", "id", "tokens"]
    rows = own.withColumn("pos", F.col("pos") + shift).select(*columns).unionByName(heads.select(*columns))
    return convs.select("conv"), rows


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by sequence and conversation: members, the least one, and the digest of all."""
    last, members, least, digest = None, 0, 0, None
    names = ["s1", "s2", "n", "members", "least", "sha"]
    types = [pa.int64()] * 5 + [pa.string()]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(zip(*rows, strict=True), types, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=names)

    for batch in batches:
        rows = []
        s1, s2, n, conv = (batch.column(c).to_pylist() for c in ("s1", "s2", "n", "conv"))
        for key, one in zip(zip(s1, s2, n, strict=True), conv, strict=True):
            if key != last:
                if last is not None:
                    rows.append((*last, members, least, digest.hexdigest()))
                last, members, least, digest = key, 1, one, hashlib.sha256(str(one).encode())
            else:
                members += 1
                digest.update(f",{one}".encode())
        if rows:
            yield out(rows)
    if last is not None:
        yield out([(*last, members, least, digest.hexdigest())])


def _sequences(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """``seq`` (the least conversation), its number of turns ``n``, ``members`` and the digest ``sha`` of all.

    The digest is over all members in order, so one task reads them, sorted, without holding them.
    """
    named = rows.groupBy("conv").agg(F.bit_xor("x1").alias("s1"), F.bit_xor("x2").alias("s2"), F.count("*").alias("n"))
    zero = F.lit(0).cast("bigint")
    whole = convs.join(named, "conv", "left").select("conv", *(F.coalesce(c, zero).alias(c) for c in ("s1", "s2", "n")))
    keys = ["s1", "s2", "n"]
    grouped = whole.repartition(*keys).sortWithinPartitions(*keys, "conv")
    kinds = "s1 long, s2 long, n long, members long, least long, sha string"
    return grouped.mapInArrow(_hashed, kinds).select(F.col("least").alias("seq"), "n", "members", "sha")


def _burst(paths: DataFrame, sequences: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """``placed``: the container of each sequence (its prefix ``k1``, ``k2``, the position ``top`` of the prefix's
    last turn, and ``kinds``, its sequences); and the rows of ``paths`` whose prefixes are heads."""
    active = sequences.filter("n > 0").select("seq")
    placed, heads = [], []
    start, step = 0, 1
    while True:
        near = paths.join(active, "seq", "left_semi").filter(F.col("pos").between(start, start + step - 1))
        sizes = near.groupBy("p1", "p2").agg(F.count("*").alias("kinds"), F.sum(F.col("n") - F.col("pos")).alias("size"))
        small = (F.col("kinds") == 1) | (F.col("size") <= CONTAINER)
        sized = written(near.join(sizes, ["p1", "p2"]).withColumn("small", small), "trie-burst")
        first = sized.filter("small").groupBy("seq").agg(
            F.min(F.struct(F.col("pos").alias("top"), F.col("p1").alias("k1"), F.col("p2").alias("k2"), "kinds")).alias("c")
        )
        placed.append(first.select("seq", "c.*"))
        heads.append(sized.filter("NOT small").drop("kinds", "size", "small"))
        start, step = start + step, step * 2
        open_ = sized.filter((F.col("pos") == start - 1) & ~F.col("small") & (F.col("n") > start)).select("seq")
        if open_.isEmpty():
            return reduce(DataFrame.unionByName, placed), heads
        active = open_


NODE = pa.schema(
    [
        *((name, pa.int64()) for name in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children")),
        *((name, pa.int64()) for name in ("n_leaves", "saved_tokens")),
        ("ends_sha256", pa.string()),
        ("q1", pa.int64()),
        ("q2", pa.int64()),
        ("top", pa.bool_()),
    ]
)
NODE_TYPES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long,"
    " ends_sha256 string, q1 long, q2 long, top boolean"
)


def swept(sequences: list[tuple], depth: int) -> list[list]:
    """The nodes of one container, from (turn ids, tokens, members, least conversation, digest) of its sequences.

    All sequences start with the turn of the container's own node, which has ``depth``; nodes come after their parents.
    A node is [least conversation, depth, parent's place, members, children, leaves, saved tokens, digest, own tokens].
    """
    nodes: list[list] = []
    path: list[int] = []
    before: tuple = ()

    def close(length: int) -> None:
        while len(path) > length:
            node = nodes[path.pop()]
            node[5] = node[5] or 1
            node[6] += (node[3] - 1) * node[8]
            if path:
                parent = nodes[path[-1]]
                parent[4] += 1
                parent[5] += node[5]
                parent[6] += node[6]

    for ids, tokens, members, least, digest in sorted(sequences):
        common = 0
        while common < min(len(ids), len(before)) and ids[common] == before[common]:
            common += 1
        close(common)
        for i in range(common, len(ids)):
            parent = path[-1] if path else None
            path.append(len(nodes))
            nodes.append([least, depth + i, parent, 0, 0, 0, 0, NOTHING, tokens[i]])
        for at in path:
            nodes[at][0] = min(nodes[at][0], least)
            nodes[at][3] += members
        nodes[path[-1]][7] = digest
        before = ids
    close(0)
    return nodes


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by container, sequence and position: all nodes below and at the containers' prefixes."""
    key, sequences, parent, depth = None, [], (0, 0), 0
    seq, ids, tokens, rest = None, [], [], ()

    def out() -> pa.RecordBatch:
        nodes = swept([(tuple(i), t, *r) for i, t, r in sequences], depth)
        rows = [
            (n[0], n[1], None if n[2] is None else nodes[n[2]][0], *n[3:8], *parent, n[2] is None) for n in nodes
        ]
        columns = zip(zip(*rows, strict=True), NODE.types, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], schema=NODE)

    names = ["k1", "k2", "seq", "pos", "id", "tokens", "members", "sha", "q1", "q2"]
    for batch in batches:
        for k1, k2, one, pos, turn, count, members, sha, q1, q2 in zip(
            *(batch.column(c).to_pylist() for c in names), strict=True
        ):
            if (k1, k2) != key:
                if key is not None:
                    yield out()
                key, sequences, parent, depth, seq = (k1, k2), [], (q1, q2), pos + 1, None
            if one != seq:
                seq, ids, tokens, rest = one, [], [], (members, one, sha)
                sequences.append((ids, tokens, rest))
            ids.append(turn)
            tokens.append(count)
    if key is not None:
        yield out()


def trie(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """The nodes of the prefix trie of all ``convs``, whose turns are ``rows`` (``conv``, ``pos``, ``id``, ``tokens``)."""
    names = {f"x{i}": F.xxhash64(F.lit(i), F.col("pos"), F.col("id")) for i in (1, 2)}
    rows = written(rows.withColumns(names), "trie-rows")
    sequences = written(_sequences(convs, rows), "trie-sequences")
    own = rows.withColumnRenamed("conv", "seq").join(sequences.select("seq", "n"), "seq")
    own = own.withColumns({"p1": F.col("x1"), "p2": F.col("x2"), "through": F.col("tokens")})
    paths = running(own, "seq", [F.col("pos")], ["p1", "p2"], ["through"]).drop("nth")
    # The name of the prefix that is one turn shorter; the root's is 0, 0.
    paths = paths.withColumns({"q1": F.col("p1").bitwiseXOR(F.col("x1")), "q2": F.col("p2").bitwiseXOR(F.col("x2"))})
    paths = written(paths.drop("x1", "x2"), "trie-paths")
    placed, heads = _burst(paths, sequences)
    placed = written(placed, "trie-placed")
    told = placed.join(sequences.select("seq", "members", "sha"), "seq")
    contained = paths.join(told, "seq").filter("pos >= top")

    several = contained.filter("kinds > 1").repartition("k1", "k2")
    several = several.sortWithinPartitions("k1", "k2", "seq", "pos")
    nodes = several.mapInArrow(_sweep, NODE_TYPES)
    # A container of one sequence: each turn is a node, all with the same members.
    ends = sequences.filter("n > 0").join(paths.withColumn("final", F.col("through")), ["seq", "n"])
    ends = ends.filter("pos = n - 1").select("seq", "final")
    last = F.col("pos") == F.col("n") - 1
    chains = contained.filter("kinds = 1").join(ends, "seq").select(
        F.col("seq").alias("conv_id"),
        (F.col("pos") + 1).alias("depth"),
        F.when(F.col("pos") > F.col("top"), F.col("seq")).alias("parent_conv_id"),
        F.col("members").alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("bigint").alias("n_children"),
        F.lit(1).cast("bigint").alias("n_leaves"),
        ((F.col("members") - 1) * (F.col("final") - F.col("through") + F.col("tokens"))).alias("saved_tokens"),
        F.when(last, F.col("sha")).otherwise(NOTHING).alias("ends_sha256"),
        "q1",
        "q2",
        (F.col("pos") == F.col("top")).alias("top"),
    )
    inner = written(nodes.unionByName(chains), "trie-nodes")
    above = written(_heads(reduce(DataFrame.unionByName, heads), sequences, inner.filter("top")), "trie-heads")
    # Parents of heads and of containers are heads.
    parents = above.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent"))
    columns = [name for name in NODE.names if name not in ("q1", "q2", "top")]
    below = inner.filter("top").unionByName(above.filter("depth > 0").drop("p1", "p2").withColumn("top", F.lit(True)))
    below = below.join(parents, ["q1", "q2"]).withColumn("parent_conv_id", F.col("parent"))
    return reduce(
        DataFrame.unionByName,
        [f.select(*columns) for f in (inner.filter("NOT top"), below, above.filter("depth = 0"))],
    )


def _heads(rows: DataFrame, sequences: DataFrame, tops: DataFrame) -> DataFrame:
    """The nodes of heads, the root included, from their rows and the nodes ``tops`` of all containers.

    With the tokens of a head counted for its least sequence alone, each sum over a subtree is a sum over sequences.
    """
    rows = written(rows.join(sequences.select("seq", "members", "sha"), "seq"), "trie-head-rows")
    least = rows.groupBy("p1", "p2").agg(F.min("seq").alias("least"))
    rows = written(rows.join(least, ["p1", "p2"]), "trie-head-owners")
    # Per sequence: tokens of its heads, those that it owns, and what its container holds below.
    owned = rows.groupBy("seq").agg(
        F.max("through").alias("reach"),
        F.sum(F.when(F.col("least") == F.col("seq"), F.col("tokens")).otherwise(0)).alias("owned"),
    )
    held = tops.select(F.col("conv_id").alias("seq"), "n_leaves", "saved_tokens", F.lit(1).alias("container"))
    zero = F.lit(0).cast("bigint")
    sums = sequences.select("seq", "members", "n", "sha").join(owned, "seq", "left").join(held, "seq", "left")
    sums = sums.fillna(0, ["reach", "owned", "n_leaves", "saved_tokens"])
    told = rows.join(sums.select("seq", "reach", "owned", "n_leaves", "saved_tokens"), "seq")
    rest = F.col("reach") - F.col("through") + F.col("tokens")
    mine = F.col("least") == F.col("seq")
    end = F.col("pos") == F.col("n") - 1
    found = told.groupBy("p1", "p2").agg(
        F.any_value("q1").alias("q1"),
        F.any_value("q2").alias("q2"),
        F.min("seq").alias("conv_id"),
        (F.any_value("pos") + 1).alias("depth"),
        F.sum("members").alias("n_convs"),
        F.sum("n_leaves").alias("n_leaves"),
        (
            F.sum(F.col("members") * rest)
            - F.sum(F.when(mine, rest).otherwise(F.col("owned")))
            + F.sum("saved_tokens")
        ).alias("saved_tokens"),
        F.max(F.when(end, F.col("sha"))).alias("ends_sha256"),
    )
    root = sums.agg(
        zero.alias("p1"),
        zero.alias("p2"),
        zero.alias("q1"),
        zero.alias("q2"),
        F.min("seq").alias("conv_id"),
        zero.alias("depth"),
        F.sum("members").alias("n_convs"),
        F.sum("n_leaves").alias("n_leaves"),
        (F.sum(F.col("members") * F.col("reach")) - F.sum("owned") + F.sum("saved_tokens")).alias("saved_tokens"),
        F.max(F.when(F.col("n") == 0, F.col("sha"))).alias("ends_sha256"),
    ).filter("conv_id IS NOT NULL")
    heads = written(found.unionByName(root), "trie-head-sums")
    children = (
        tops.select("q1", "q2").unionByName(heads.filter("depth > 0").select("q1", "q2"))
        .groupBy(F.col("q1").alias("p1"), F.col("q2").alias("p2"))
        .agg(F.count("*").alias("n_children"))
    )
    return heads.join(children, ["p1", "p2"], "left").select(
        "conv_id",
        "depth",
        F.lit(None).cast("bigint").alias("parent_conv_id"),
        "n_convs",
        F.coalesce("n_children", zero).alias("n_children"),
        # Only a root without children is a leaf.
        F.when(F.col("n_children").isNull(), 1).otherwise(F.col("n_leaves")).cast("bigint").alias("n_leaves"),
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
        "p1",
        "p2",
        "q1",
        "q2",
    )


def op11(conversations: DataFrame) -> DataFrame:
    """All nodes of the prefix trie of rebuilt conversations.

    * Turns are ordered by ``turn``, null first, then by role and text; a null role or text is empty.  Repeated
      rows are turns of their own.  Rows without a ``conv_id`` belong to no conversation and are left out.
    * Only the four named columns are read.  An empty table gives an empty result.
    """
    return trie(*rebuilt(turns_of(conversations)))
