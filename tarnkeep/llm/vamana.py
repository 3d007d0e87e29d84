"""Approximate nearest neighbours on robust-pruned directed graphs.

Vectors are dealt into shards by a hash, and a directed graph is built over each shard: a greedy
beam search from the medoid proposes neighbours for a batch of vectors, and robust pruning keeps
those to which no kept neighbour is much nearer (by the factor ``ALPHA``), so that edges
point into different directions.  A query runs a beam search in every shard, and the best of all
shards are put together; distances are exact, in double precision.

The number of shards follows from the number of vectors, so a task never holds more than about
``SHARD_ROWS`` of them.  Equal vectors are one point of a graph with the ``k + 1`` smallest ids, of which
no result can ever need more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnkeep.llm.tables import written

K = 10
#: Vectors per shard, queries that visit a shard together.
SHARD_ROWS, QUERY_BLOCK = 8_192, 2_048
#: Edges per vector after pruning, and room for edges back to it until it is pruned again.
DEGREE, ROOM = 28, 44
#: Beam widths for building and for queries, and the relaxation of distances.
BUILD_BEAM, QUERY_BEAM, ALPHA = 40, 96, 1.2
#: Tasks per shard, so that two shards seldom meet in one task.
SPREAD = 3
#: Vectors that are inserted together.
BATCH = 256


def _distances(points: np.ndarray, norms: np.ndarray, queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Squared distances of each query to its own row of ``ids``; -1 gives infinity."""
    found = points[ids]
    products = np.matmul(found, queries[:, :, None])[:, :, 0]
    result = norms[ids] - 2.0 * products + (queries * queries).sum(axis=1)[:, None]
    return np.where(ids < 0, np.inf, np.maximum(result, 0.0))


def beam_search(
    points: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nearest points found for each query, nearest first, with squared distances.

    All queries advance together: each expands its nearest point that it has not expanded yet,
    until every beam holds expanded points only.  Missing places are -1.
    """
    n = len(queries)
    norms = (points * points).sum(axis=1)
    ids = np.full((n, beam), -1, dtype=np.int64)
    far = np.full((n, beam), np.inf)
    done = np.zeros((n, beam), dtype=bool)
    ids[:, 0] = start
    far[:, 0] = _distances(points, norms, queries, ids[:, :1])[:, 0]
    active = np.arange(n)
    while len(active):
        open_far = np.where(done[active] | (ids[active] < 0), np.inf, far[active])
        at = open_far.argmin(axis=1)
        going = np.isfinite(open_far[np.arange(len(active)), at])
        active, at = active[going], at[going]
        if not len(active):
            break
        done[active, at] = True
        new = edges[ids[active, at]]
        new_far = _distances(points, norms, queries[active], new)
        all_ids = np.concatenate([ids[active], new], axis=1)
        all_far = np.concatenate([far[active], new_far], axis=1)
        all_done = np.concatenate([done[active], np.zeros(new.shape, dtype=bool)], axis=1)
        # A point that is already in the beam comes first among its copies, which are dropped.
        order = np.lexsort((~all_done, all_ids), axis=1)
        sorted_ids = np.take_along_axis(all_ids, order, axis=1)
        again = np.zeros(sorted_ids.shape, dtype=bool)
        again[:, 1:] = sorted_ids[:, 1:] == sorted_ids[:, :-1]
        sorted_far = np.take_along_axis(all_far, order, axis=1)
        sorted_far[again] = np.inf
        sorted_ids[again] = -1
        best = np.argsort(sorted_far, axis=1, kind="stable")[:, :beam]
        ids[active] = np.take_along_axis(sorted_ids, best, axis=1)
        far[active] = np.take_along_axis(sorted_far, best, axis=1)
        done[active] = np.take_along_axis(np.take_along_axis(all_done, order, axis=1), best, axis=1)
    return ids, far


def robust_prune(
    points: np.ndarray, own: int, candidates: np.ndarray, degree: int, alpha: float
) -> np.ndarray:
    """At most ``degree`` of ``candidates`` such that none is ``alpha`` times nearer to a kept one."""
    candidates = np.unique(candidates[(candidates >= 0) & (candidates != own)])
    if not len(candidates):
        return candidates
    # Seen from the point itself, so that products of coordinates are as small as the distances are.
    around = points[candidates] - points[own]
    far = (around * around).sum(axis=1)
    order = np.argsort(far, kind="stable")
    candidates, around, far = candidates[order], around[order], far[order]
    norms = (around * around).sum(axis=1)
    between = norms[:, None] + norms[None, :] - 2.0 * (around @ around.T)
    shadowed = (alpha * alpha) * between <= far[None, :]
    alive = np.ones(len(candidates), dtype=bool)
    kept: list[int] = []
    for i in range(len(candidates)):
        if alive[i]:
            kept.append(i)
            if len(kept) == degree:
                break
            alive &= ~shadowed[i]
    return candidates[kept]


def build(points: np.ndarray, seed: int = 7) -> tuple[np.ndarray, int]:
    """Edges (-1 for none) of every point, and the point where searches start.

    Two passes insert all points in batches, first with a factor of 1, then with ``ALPHA``.
    """
    n = len(points)
    random = np.random.default_rng(seed)
    # Distances come from products, which lose digits far from the origin.
    points = points - points.mean(axis=0)
    start = int((points**2).sum(axis=1).argmin())
    edges = np.full((n, ROOM), -1, dtype=np.int64)
    if n == 1:
        return edges, start
    first = random.integers(0, n, size=(n, min(DEGREE, n - 1) // 2 + 1))
    edges[:, : first.shape[1]] = np.where(first == np.arange(n)[:, None], (first + 1) % n, first)
    for alpha in (1.0, ALPHA):
        order = random.permutation(n)
        for at in range(0, n, BATCH):
            batch = order[at : at + BATCH]
            found, _ = beam_search(points, edges, start, points[batch], BUILD_BEAM)
            back: dict[int, list[int]] = {}
            for own, near in zip(batch.tolist(), found, strict=True):
                kept = robust_prune(points, own, np.concatenate([near, edges[own]]), DEGREE, alpha)
                edges[own] = -1
                edges[own, : len(kept)] = kept
                for other in kept.tolist():
                    back.setdefault(other, []).append(own)
            for other, sources in back.items():
                held = edges[other][edges[other] >= 0].tolist()
                more = [x for x in sources if x not in held]
                if len(held) + len(more) <= ROOM:
                    edges[other, len(held) : len(held) + len(more)] = more
                else:
                    kept = robust_prune(points, other, np.array(held + more), DEGREE, alpha)
                    edges[other] = -1
                    edges[other, : len(kept)] = kept
    return edges, start


def _matrix(values: pd.Series) -> np.ndarray:
    return np.array(values.tolist(), dtype=np.float64)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``id``, ``vector`` (doubles) and ``size`` of the rows that take part.

    Vectors that are null, empty or zero, or hold null or non-finite components, do not.
    """
    rows = vectors.select(
        F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("vector")
    ).filter("vector IS NOT NULL AND id IS NOT NULL")
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return rows.filter(finite & F.exists("vector", lambda x: x != 0)).withColumn("size", F.size("vector"))


def graphs(points: DataFrame, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, int]:
    """From ``size``, ``vector`` and ``ids``: the same with ``shard``, ``place``, ``edges`` and ``start``.

    Also the number of tasks that the shards are spread over.  It is given to Spark, which would
    put many shards into one task for their few bytes, though each is much work.
    """
    counts = points.groupBy("size").agg(F.ceil(F.count("*") / shard_rows).alias("shards"))
    tasks = SPREAD * (counts.agg(F.sum("shards")).first()[0] or 1)
    sharded = points.join(counts, "size").withColumn(
        "shard", F.pmod(F.xxhash64("vector"), F.col("shards")).cast("int")
    )

    def graph(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("ids", key=lambda ids: ids.map(lambda x: x[0]), kind="stable")
        edges, start = build(_matrix(rows["vector"]))
        kept = [row[row >= 0] for row in edges]
        return pd.DataFrame(
            {
                "size": rows["size"].to_numpy(),
                "shard": rows["shard"].to_numpy(),
                "place": np.arange(len(rows)),
                "start": start,
                "vector": rows["vector"].to_numpy(),
                "ids": rows["ids"].to_numpy(),
                "edges": kept,
            }
        )

    built = sharded.repartition(tasks, "size", "shard").groupBy("size", "shard").applyInPandas(
        graph,
        "size int, shard int, place long, start long, vector array<double>, ids array<long>,"
        " edges array<long>",
    )
    return built, tasks


def _searched(k: int, beam: int):
    def search(key, nodes: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "vec_id", "score"]
        if not len(nodes) or not len(queries):
            return pd.DataFrame({c: [] for c in columns}).astype(
                {"query_id": "int64", "vec_id": "int64", "score": "float64"}
            )
        nodes = nodes.sort_values("place")
        points, asked = _matrix(nodes["vector"]), _matrix(queries["vector"])
        edges = np.full((len(nodes), ROOM), -1, dtype=np.int64)
        for i, row in enumerate(nodes["edges"]):
            edges[i, : len(row)] = row
        ids, names = nodes["ids"].tolist(), queries["id"].tolist()
        middle = points.mean(axis=0)
        centred = points - middle
        result: list[tuple[int, int, float]] = []
        for at in range(0, len(asked), BATCH):
            block = asked[at : at + BATCH]
            found, _ = beam_search(centred, edges, int(nodes["start"].iloc[0]), block - middle, beam)
            for own, query, near in zip(names[at : at + BATCH], block, found, strict=True):
                near = near[near >= 0]
                far = np.sqrt(((points[near] - query) ** 2).sum(axis=1))
                order = np.argsort(far, kind="stable")
                hits: list[tuple[float, int]] = []
                for i in order:
                    if len(hits) >= k and far[i] > hits[k - 1][0]:
                        break
                    hits.extend((float(far[i]), x) for x in ids[near[i]] if x != own)
                    hits.sort()
                    del hits[k:]
                result.extend((own, x, d) for d, x in hits)
        return pd.DataFrame(result, columns=columns)

    return search


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = K,
    key: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    beam: int = QUERY_BEAM,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` (Euclidean) of the ``k`` nearest found.

    ``queries`` has the columns of ``vectors``, of which a query's own id is never a result.

    * Vectors that are null, empty or zero, or hold null or non-finite components, and rows without
      an id take no part, neither as queries nor as candidates.
    * Only vectors of equal length are compared.  Ties go to the smaller id.
    * Repeated rows (one id, one vector) count once; a query whose id names several vectors is a
      search for each, of which every candidate counts with its nearest.
    * With fewer than ``k`` candidates all are returned; empty tables give an empty result.
    """
    first = F.expr("row_number() OVER (PARTITION BY size, vector ORDER BY id)")
    points = usable(vectors, key, vector).distinct().withColumn("nth", first)
    points = points.filter(F.col("nth") <= k + 1).groupBy("size", "vector")
    points = points.agg(F.array_sort(F.collect_list("id")).alias("ids"))
    built, tasks = graphs(written(points, "vector-points"), shard_rows)
    nodes = written(built, "vector-graphs")
    shards = nodes.select(F.col("size").alias("of"), F.col("shard").alias("at")).distinct()
    asked = usable(queries, key, vector).distinct()
    total = asked.count()
    blocks = max(1, -(-total // QUERY_BLOCK))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    asked = asked.join(shards, F.col("size") == F.col("of"))
    asked = asked.select("id", "vector", "size", F.col("at").alias("shard"), "block")
    nodes = nodes.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    by = ["size", "shard", "block"]
    found = (
        nodes.repartition(tasks * blocks, *by)
        .groupBy(*by)
        .cogroup(asked.repartition(tasks * blocks, *by).groupBy(*by))
        .applyInPandas(_searched(k, beam), "query_id long, vec_id long, score double")
        .groupBy("query_id", "vec_id")
        .agg(F.min("score").alias("score"))
    )
    rank = F.expr("row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)")
    ranked = found.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op7(embeddings: DataFrame) -> DataFrame:
    """The 10 nearest of every vector whose id is divisible by 100."""
    rows = embeddings.select("vec_id", "embedding")
    return nearest(rows, rows.filter("vec_id % 100 = 0"))
