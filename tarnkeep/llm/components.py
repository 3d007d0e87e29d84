"""Connected components of a large graph of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnkeep.llm.tables import written


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node of ``links`` (columns ``a`` and ``b``, any orderable type).

    ``root`` is the least node of the component.  Each round first links every larger neighbour of
    a node to the node's least neighbour (large star), then every smaller one (small star), until
    the links no longer change; the number of rounds grows with the logarithm of the number of
    nodes.  Rounds are written tables, so no lineage grows and no links reach the driver.  A node
    with very many links is only ever grouped by a minimum, which is combined before the shuffle.

    Loops and repeated links are harmless; rows with a null end are left out.
    """
    links = links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = written(links, "links")
    state = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = (
            both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        ).filter("a <> b")
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
        links = written(small.filter("a <> b").distinct(), "links")
        now = links.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
        ).first()
        if now == state:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        state = now
