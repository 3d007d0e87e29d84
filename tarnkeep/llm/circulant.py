"""MinHash near-duplicates with circulant signatures.

All coordinates of a signature come from two permutations: the first places the shingles of a
document on a circle, the second one ranks the places.  Coordinate ``k`` is the least rank after the
circle has been turned by ``k`` places, so one table and its shifts replace a permutation per
coordinate.  Bands of coordinates give candidates, and every candidate is confirmed on the full
shingle sets: ``100 * intersection >= percent * union``.

Documents with equal sets are one node.  A node first meets the pivots of its bands; in each band that
is the node with the least hash, so that most bands of a group have the same one.  Rounds of other
pivots follow, those whose pairs were confirmed most often, like the original of many edited copies,
while they find enough links.  Pairs within a component, whose links could not change the
components, are not looked at.  The pairs that are open in the end are all confirmed or refuted: nodes
that share none of their rarest shingles cannot be similar enough and are never paired.  For many
others a pivot is enough, since Jaccard distances obey the triangle inequality, and two sets whose
distances to it differ by more than the allowed distance are refuted by that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tarnkeep.llm.bitmaps import bitmap_of
from tarnkeep.llm.components import components
from tarnkeep.llm.grams import NOT_BLANK, U64, gram_hashes, mixed, set_bits, text_pieces, words_of
from tarnkeep.llm.tables import written

SHINGLE_WORDS = 5
PERCENT = 80
#: Bands and coordinates per band.  Two sets with a similarity of 0.8 share no band with a
#: probability of (1 - 0.8**6)**40, five in a million; at 0.85 it is less than one in 10**8.
BANDS, ROWS = 40, 6
#: A round of pivots is followed by another one if it confirms this share of its pairs.
FRUITFUL = 0.05
#: Counters of the table that orders shingles by how rare they are (8 MB).
COUNTERS = 1 << 20
#: Places on the circle.  Collisions of places only blur the candidates, not the confirmation.
PLACES = 1 << 20
SEED = 20240501

PAIR = ["a1", "a2", "b1", "b2"]


def _ranks() -> np.ndarray:
    """A window on the turned second permutation for every place of the circle."""
    ranks = np.random.default_rng(SEED).permutation(PLACES).astype(np.uint32)
    width = BANDS * ROWS
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([ranks, ranks[:width]]), width)


def _sets(column: pa.Array, words: int) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """Runs of rows with the sorted distinct shingle hashes of each text."""
    for first, last, texts in text_pieces(column):
        found = words_of(texts, NOT_BLANK)
        grams = gram_hashes(found.hashes, words)
        ends = np.cumsum(found.counts)
        starts = ends - found.counts
        sets = []
        for start, count in zip(starts, found.counts, strict=True):
            if count >= words:
                sets.append(np.unique(grams[start : start + count - words + 1]))
            elif count:
                sets.append(gram_hashes(found.hashes[start : start + count], int(count)))
            else:
                sets.append(np.zeros(0, dtype=U64))
        yield first, last, sets


def _keys(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit numbers that name a set: sums over its members under two mixings."""
    one = [mixed(s).sum(dtype=U64) + U64(len(s)) for s in sets]
    two = [mixed(s ^ U64(0xA5A5A5A5A5A5A5A5)).sum(dtype=U64) for s in sets]
    return mixed(np.array(one, dtype=U64)).view(np.int64), np.array(two, dtype=U64).view(np.int64)


def _signed(values: list[np.ndarray]) -> pa.Array:
    lengths = np.zeros(len(values) + 1, dtype=np.int32)
    np.cumsum([len(v) for v in values], out=lengths[1:])
    flat = np.concatenate(values) if values else np.zeros(0, dtype=U64)
    return pa.ListArray.from_arrays(pa.array(lengths), pa.array(flat.view(np.int64)))


def signatures(rows: DataFrame, words: int) -> DataFrame:
    """From ``row`` and ``text``: ``row``, ``n_shingles``, the set's name ``k1``, ``k2``, ``bands``.

    ``bands`` is empty for a set without shingles.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _ranks()
        for batch in batches:
            for first, last, sets in _sets(batch.column("text"), words):
                k1, k2 = _keys(sets)
                bands = []
                for members in sets:
                    if not len(members):
                        bands.append(np.zeros(0, dtype=U64))
                        continue
                    places = ((members >> U64(20)) & U64(PLACES - 1)).astype(np.int64)
                    least = ranks[places[:4096]].min(axis=0)
                    for at in range(4096, len(places), 4096):
                        np.minimum(least, ranks[places[at : at + 4096]].min(axis=0), out=least)
                    grid = least.reshape(BANDS, ROWS).astype(U64)
                    total = np.arange(BANDS, dtype=U64)
                    for j in range(ROWS):
                        total = mixed(total * U64(PLACES) + grid[:, j])
                    bands.append(total)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").slice(first, last - first),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(k1),
                        pa.array(k2),
                        _signed(bands),
                    ],
                    names=["row", "n_shingles", "k1", "k2", "bands"],
                )

    kind = rows.schema["row"].dataType.simpleString()
    return rows.select("row", "text").mapInArrow(
        scan, f"row {kind}, n_shingles long, k1 long, k2 long, bands array<long>"
    )


def _banded(nodes: DataFrame, shared: DataFrame) -> DataFrame:
    """``k1``, ``k2``, ``n`` and ``band`` for the bands of ``shared``, and for some others.

    A bitmap keeps most bands that only one node has from being shuffled.
    """
    several = nodes.sparkSession.sparkContext.broadcast(bitmap_of(shared, F.col("band")))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bands = batch.column("bands")
            values = bands.flatten().to_numpy()
            hit = set_bits(several.value, values.view(U64))
            taken = pa.array(np.repeat(np.arange(len(bands)), np.diff(bands.offsets.to_numpy()))[hit])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name).take(taken) for name in ("k1", "k2", "n")), pa.array(values[hit])],
                names=["k1", "k2", "n", "band"],
            )

    return nodes.select("k1", "k2", "n", "bands").mapInArrow(scan, "k1 long, k2 long, n long, band long")


def _full_sets(rows: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """``k1``, ``k2`` and ``members`` of ``nodes`` (with ``row``, the row to take them from).

    The texts are read again; a bitmap of the wanted rows keeps all others from being shuffled.
    """
    spark = rows.sparkSession
    wanted = spark.sparkContext.broadcast(bitmap_of(nodes, F.xxhash64("row")))
    numbered = rows.select("text", F.xxhash64("row").alias("number"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column("number").to_numpy().view(U64)
            batch = batch.filter(pa.array(set_bits(wanted.value, numbers)))
            for _, _, sets in _sets(batch.column("text"), words):
                k1, k2 = _keys(sets)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1), pa.array(k2), _signed(sets)], names=["k1", "k2", "members"]
                )

    found = numbered.mapInArrow(scan, "k1 long, k2 long, members array<long>")
    found = found.join(nodes.select("k1", "k2"), ["k1", "k2"], "left_semi")
    return found.dropDuplicates(["k1", "k2"])


def _measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs with the sizes of the ``common`` part and of the ``union`` of their full sets."""
    a = sets.select(F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.col("members").alias("am"))
    b = sets.select(F.col("k1").alias("b1"), F.col("k2").alias("b2"), F.col("members").alias("bm"))
    both = pairs.join(a, ["a1", "a2"]).join(b, ["b1", "b2"])
    both = both.withColumn("common", F.size(F.array_intersect("am", "bm")))
    union = F.size("am") + F.size("bm") - F.col("common")
    return both.select(*pairs.columns, "common", union.alias("union"))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    return _measured(pairs, sets).filter(F.col("common") * 100 >= F.col("union") * percent).select(*PAIR)


def _node(one: str, two: str) -> Column:
    return F.struct(F.col(one).alias("k1"), F.col(two).alias("k2"))


def _flipped(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        F.col("b1").alias("a1"), F.col("b2").alias("a2"), F.col("a1").alias("b1"), F.col("a2").alias("b2")
    )


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components so far."""
    left = roots.select(F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.col("root").alias("ra"))
    right = roots.select(F.col("k1").alias("b1"), F.col("k2").alias("b2"), F.col("root").alias("rb"))
    joined = pairs.join(left, ["a1", "a2"], "left").join(right, ["b1", "b2"], "left")
    differ = F.coalesce("ra", _node("a1", "a2")) != F.coalesce("rb", _node("b1", "b2"))
    return joined.filter(differ).select(*PAIR)


def node_links(signed: DataFrame, rows: DataFrame, words: int, percent: int) -> DataFrame:
    """``k1``, ``k2``, least ``row`` of every node (distinct set) and the ``root`` of its component.

    ``signed`` is the written result of :func:`signatures` on ``rows``.
    """
    nodes = (
        signed.filter("n_shingles > 0")
        .groupBy("k1", "k2")
        .agg(
            F.min("row").alias("row"),
            F.any_value("n_shingles").alias("n"),
            F.any_value("bands").alias("bands"),
        )
    )
    nodes = written(nodes, "minhash-nodes")
    draw = F.xxhash64("k1", "k2").alias("draw")
    shared = nodes.select(F.explode("bands").alias("band"), draw).groupBy("band")
    shared = shared.agg(F.count("*").alias("c"), F.min("draw").alias("pivot")).filter("c > 1").drop("c")
    shared = written(shared, "minhash-shared")
    banded = _banded(nodes, shared).select("*", draw)
    members = written(banded.join(shared, "band"), "minhash-members")
    involved = members.select("k1", "k2").distinct()
    sets = written(_full_sets(rows, nodes.join(involved, ["k1", "k2"]), words), "minhash-sets")

    other = [F.col("k1").alias("b1"), F.col("k2").alias("b2"), F.col("n").alias("bn")]
    # Sets of too unequal size cannot be similar enough.
    sized = F.least("n", "bn") * 100 >= F.greatest("n", "bn") * percent
    named = [F.col("k1").alias("a1"), F.col("k2").alias("a2"), "b1", "b2"]
    pivots = members.filter("draw = pivot").select("band", "pivot", *other)
    starred = members.filter("draw <> pivot").join(pivots, ["band", "pivot"]).filter(sized)
    starred = starred.groupBy(*named).agg(F.min("pivot").alias("pivot"))
    starred = written(starred, "minhash-stars")
    best = F.expr("row_number() OVER (PARTITION BY a1, a2 ORDER BY pivot, b1, b2)")
    pairs = written(starred.withColumn("place", best).filter("place = 1").select(*PAIR), "minhash-pairs")
    links = written(_confirmed(pairs, sets, percent), "minhash-links")
    tested, found, tries = pairs, links, 0
    used = pivots.select(F.col("b1").alias("k1"), F.col("b2").alias("k2"), "band")
    alone, number = _node("k1", "k2"), 0
    roots = nodes.select("k1", "k2", alone.alias("root"))
    while True:
        roots = written(_joined(roots, found), "minhash-roots")
        placed = members.select("band", "k1", "k2", "n").join(roots, ["k1", "k2"])
        placed = written(placed, "minhash-placed")
        counts = placed.groupBy("band", "root").agg(F.count("*").alias("c"))
        # In each band the largest component is ``main``; its members need no pairs with each other.
        sizes = counts.groupBy("band").agg(
            F.sum("c").alias("all"),
            F.sum(F.col("c") * F.col("c")).alias("inside"),
            F.max(F.struct("c", "root")).alias("largest"),
        )
        sizes = sizes.filter("all * all > inside")
        sizes = written(sizes.select("band", "all", "inside", F.col("largest.root").alias("main")), "minhash-bands")
        left = sizes.agg(
            F.coalesce(F.sum((F.col("all") * F.col("all") - F.col("inside")) / 2), F.lit(0)).alias("pairs"),
            F.coalesce(F.sum("all"), F.lit(0)).alias("members"),
        ).first()
        if not left["pairs"]:
            break
        # Components only grow, so what is one component in a band now needs no further look.
        placed = written(placed.join(sizes.select("band", "main"), "band"), "minhash-open")
        members = placed
        fruitful = number < 2 or found.count() >= FRUITFUL * tries
        last = number > 0 and (left["pairs"] <= left["members"] or not fruitful)
        known = tested.unionByName(_flipped(tested))
        if number == 0:
            pairs = _apart(starred.select(*PAIR), roots)
        else:
            # Anchors may be hubs of earlier rounds, new pivots may not.
            hubs = _hubs(placed, tested, links, used.limit(0) if last else used)
            right = hubs.select("band", *other, F.col("root").alias("rb"), "rate")
            near = placed.join(right, "band").filter((F.col("k1") != F.col("b1")) | (F.col("k2") != F.col("b2")))
            if last:
                anchors = written(_anchored(near.select(*named, "rate"), hubs, sets), "minhash-anchors")
                pairs = _open_pairs(placed, anchors, sets, sized, percent).select(*named).distinct()
            else:
                used = used.unionByName(hubs.select("k1", "k2", "band"))
                pairs = near.filter(sized & (F.col("root") != F.col("rb"))).select(*named).distinct()
        pairs = written(pairs.join(known, PAIR, "left_anti"), "minhash-pairs")
        found, tries = written(_confirmed(pairs, sets, percent), "minhash-links"), pairs.count()
        tested, links = tested.unionByName(pairs), links.unionByName(found)
        if last:
            roots = _joined(roots, found)
            break
        number += 1
    return nodes.select("k1", "k2", "row").join(roots, ["k1", "k2"])


def _anchored(near: DataFrame, hubs: DataFrame, sets: DataFrame) -> DataFrame:
    """For nodes of open bands the hub with the highest rate, and the distance to it.

    Hubs are their own anchors.
    """
    best = near.groupBy("a1", "a2").agg(F.max(F.struct("rate", "b1", "b2")).alias("hub"))
    pairs = best.select("a1", "a2", "hub.b1", "hub.b2")
    measured = _measured(pairs, sets).select(
        F.col("a1").alias("k1"),
        F.col("a2").alias("k2"),
        _node("b1", "b2").alias("anchor"),
        (1 - F.col("common") / F.col("union")).alias("far"),
    )
    own = hubs.select("k1", "k2", _node("k1", "k2").alias("anchor"), F.lit(0.0).alias("far")).distinct()
    # A node may be a hub and have a hub of a higher rate; the latter serves.
    return measured.unionByName(own.join(measured, ["k1", "k2"], "left_anti"))


def _heads(sets: DataFrame, percent: int) -> DataFrame:
    """``sets`` with ``shingle`` and its ``place``, for the rarest of each, in place of ``members``.

    All sets order their shingles alike, rare ones first.  Two sets that are similar enough have
    ``percent`` of each in common, so each has a common one among its first ``n - need + 1``.  How rare
    a shingle is comes from a table of fixed size; collisions there only change the order.
    """
    spark = sets.sparkSession
    spot = F.col("m").bitwiseAND(F.lit(COUNTERS - 1)).cast("int").alias("spot")
    found = sets.select(F.explode("members").alias("m")).groupBy(spot).agg(F.count("*").alias("c")).toArrow()
    counts = np.zeros(COUNTERS, dtype=np.int64)
    counts[found["spot"].to_numpy()] = found["c"].to_numpy()
    shared = spark.sparkContext.broadcast(counts)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = batch.column("members")
            sizes = np.diff(members.offsets.to_numpy())
            values = members.flatten().to_numpy()
            row = np.repeat(np.arange(len(sizes)), sizes)
            rarity = shared.value[values & (COUNTERS - 1)]
            order = np.lexsort((values, rarity, row))
            place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            heads = sizes - (sizes.astype(np.int64) * percent + 99) // 100 + 1
            first = place < np.repeat(heads, sizes)
            taken = pa.array(row[first])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name).take(taken) for name in names),
                    pa.array(values[order][first]),
                    pa.array(place[first]),
                ],
                names=[*names, "shingle", "place"],
            )

    fields = [field for field in sets.schema.fields if field.name != "members"]
    names = [field.name for field in fields]
    added = [StructField("shingle", LongType()), StructField("place", LongType())]
    return sets.mapInArrow(scan, StructType([*fields, *added]))


def _open_pairs(placed: DataFrame, anchors: DataFrame, sets: DataFrame, sized: Column, percent: int) -> DataFrame:
    """Each pair of nodes of different components that may be similar enough, once.

    Such nodes share one of their rarest shingles, early enough for what follows it to suffice, and
    no anchor refutes them.  Nodes that are open in no band need no pairs with each other.
    """
    nodes = placed.groupBy("k1", "k2").agg(
        F.any_value("n").alias("n"),
        F.any_value("root").alias("root"),
        F.max(F.col("root") != F.col("main")).alias("open"),
    )
    nodes = written(nodes.join(anchors, ["k1", "k2"], "left"), "minhash-rest")
    # One row per node meets its set; the shingles come out of the task that has both.
    rows = written(_heads(sets.join(nodes, ["k1", "k2"]), percent), "minhash-heads")
    right = rows.select(
        "shingle",
        F.col("k1").alias("b1"),
        F.col("k2").alias("b2"),
        F.col("n").alias("bn"),
        F.col("place").alias("bp"),
        F.col("root").alias("rb"),
        F.col("open").alias("ob"),
        F.col("anchor").alias("ab"),
        F.col("far").alias("fb"),
    )
    ordered = (F.col("k1") < F.col("b1")) | ((F.col("k1") == F.col("b1")) & (F.col("k2") < F.col("b2")))
    allowed = 1 - percent / 100 + 1e-9
    refuted = F.coalesce(
        (F.col("anchor") == F.col("ab")) & (F.abs(F.col("far") - F.col("fb")) > allowed), F.lit(False)
    )
    # From the first common shingle on, no more than the shorter rest can be common.
    rest = F.least(F.col("n") - F.col("place"), F.col("bn") - F.col("bp"))
    enough = rest * (100 + percent) >= (F.col("n") + F.col("bn")) * percent
    return (
        rows.filter("open")
        .join(right, "shingle")
        .filter((F.col("root") != F.col("rb")) & (~F.col("ob") | ordered) & sized & enough & ~refuted)
    )


def _joined(roots: DataFrame, found: DataFrame) -> DataFrame:
    """``roots`` after ``found`` links: only the roots that they connect are contracted anew."""
    left = roots.select(F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.col("root").alias("a"))
    right = roots.select(F.col("k1").alias("b1"), F.col("k2").alias("b2"), F.col("root").alias("b"))
    edges = found.join(left, ["a1", "a2"]).join(right, ["b1", "b2"]).select("a", "b")
    merged = components(edges).select(F.col("node").alias("root"), F.col("root").alias("new"))
    renamed = roots.join(merged, "root", "left")
    return renamed.select("k1", "k2", F.coalesce("new", "root").alias("root"))


def _hubs(placed: DataFrame, tested: DataFrame, links: DataFrame, used: DataFrame) -> DataFrame:
    """Of each band the node, not a pivot there before, whose pairs were confirmed most often."""

    def ends(pairs: DataFrame, name: str) -> DataFrame:
        both = pairs.unionByName(_flipped(pairs))
        return both.groupBy(F.col("a1").alias("k1"), F.col("a2").alias("k2")).agg(F.count("*").alias(name))

    rates = ends(tested, "tests").join(ends(links, "hits"), ["k1", "k2"], "left")
    rate = (F.coalesce("hits", F.lit(0)) + 1) / (F.coalesce("tests", F.lit(0)) + 2)
    rated = placed.join(used, ["band", "k1", "k2"], "left_anti").join(rates, ["k1", "k2"], "left")
    order = F.struct(rate.alias("rate"), F.xxhash64("k1", "k2").alias("draw"), "k1", "k2", "n", "root")
    chosen = rated.groupBy("band").agg(F.max(order).alias("best"))
    return written(
        chosen.select("band", "best.rate", "best.k1", "best.k2", "best.n", "best.root"), "minhash-hubs"
    )


def near_duplicates(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = SHINGLE_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """One row per row of ``documents``: ``row``, ``n_shingles`` and ``first``, the first row of its group.

    ``row`` is a struct of (``missing``, ``id``, ``digest``): whether ``key`` is null, ``key``, and the
    SHA-256 of the text.  Groups are the components of the graph of similar documents.

    * Null texts and texts without words have no shingles and are alone in their group.
    * A text of fewer words than a shingle has is one shingle.
    * Rows with equal ids and texts share ``row``; null ids come after all others.
    * An empty table gives an empty result.  Only the two named columns are read, so others may
      have any name.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    row = F.struct(
        F.col(key).isNull().alias("missing"),
        F.col(key).alias("id"),
        F.unhex(F.sha2(content.cast("binary"), 256)).alias("digest"),
    )
    rows = documents.select(row.alias("row"), content.alias("text"))
    signed = written(signatures(rows, words), "minhash-signatures")
    roots = written(node_links(signed, rows, words, percent), "minhash-groups")
    firsts = roots.groupBy("root").agg(F.min("row").alias("first"))
    named = roots.join(firsts, "root").select("k1", "k2", "first")
    return signed.join(named, ["k1", "k2"], "left").select(
        "row", "n_shingles", F.coalesce("first", "row").alias("first")
    )


def deduplicated(
    documents: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS
) -> DataFrame:
    """``documents`` with the first document of each group only; columns unchanged.

    Of repeated rows with one id and text, one stays, also where the text is empty.
    """
    groups = near_duplicates(documents, key, text, words)
    staying = groups.filter("row = first").groupBy("row").agg(F.count("*").alias("copies"))
    staying = written(staying, "minhash-staying").select(
        F.col("row.id").alias("__id"), F.col("row.digest").alias("__digest"), "copies"
    )
    content = F.coalesce(F.col(text), F.lit("")).cast("binary")
    marked = documents.withColumn("__d", F.unhex(F.sha2(content, 256)))
    same = marked[key].eqNullSafe(staying["__id"]) & (marked["__d"] == staying["__digest"])
    joined = marked.join(staying, same)
    repeated = joined.filter("copies > 1").dropDuplicates(["__id", "__digest"])
    return joined.filter("copies = 1").unionByName(repeated).select(*documents.columns)


def op9(documents: DataFrame) -> DataFrame:
    """Shingle counts and components of two-word shingles."""
    groups = near_duplicates(documents, words=2)
    return groups.select(
        F.col("row.id").alias("doc_id"),
        "n_shingles",
        F.col("first.id").alias("component_id"),
        F.col("row.id").eqNullSafe(F.col("first.id")).alias("kept"),
    )
