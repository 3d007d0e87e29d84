"""Mixing sources to target weights by iterative proportional fitting.

Documents are counted by cell (source, language, topic).  The token weights of the cells are raked:
in turn, each margin is scaled to its targets, until nothing moves any more.  A document is then
kept with the probability that its cell needs, decided by the hash of its key.

No document can be kept more than once, so a cell's weight is bounded by its tokens.  Raking works
under that bound: a cell at it counts as it is, and the others are scaled to what it leaves of the
margin.  Targets beyond the tokens of their value are lowered to these beforehand, and the other values
of the margin share what that sets free.

Everything is a plan of Spark's own functions; only cells, never documents, are raked.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnkeep.llm.tables import unit_draw, written

#: Raking ends when a turn through all margins moves less than this share of the mix; turns at most.
MOVED, TURNS = 1e-4, 100
#: Share of all tokens that the mix should have.
FRACTION = 0.8
#: Large sources are damped: a source's target is its tokens to this power.
DAMPING = 0.7
LANGUAGES = {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1}
TOPICS = {"prose": 0.85, "table": 0.05, "noisy": 0.05, "short": 0.05}
SHORT = 300
DIMENSIONS = ("source", "lang", "topic")
#: At most so many cells are one partition, where Spark groups and joins them without exchanges.
FEW = 10_000


def tokens(text: Column) -> Column:
    """The usual estimate of tokens: a quarter of the bytes, rounded up; null has none."""
    return F.coalesce(F.ceil(F.octet_length(text) / 4), F.lit(0)).cast("bigint")


def topic_of(text: Column) -> Column:
    """A coarse topic by layout, for tables without a topic of their own; null is short."""
    body = F.coalesce(text, F.lit(""))
    return (
        F.when(F.octet_length(body) < SHORT, F.lit("short"))
        .when(body.contains(" | "), F.lit("table"))
        .when(body.contains("!!") | body.contains("***"), F.lit("noisy"))
        .otherwise(F.lit("prose"))
    )


def _together(rows: DataFrame) -> tuple[DataFrame, bool]:
    """``rows`` as one partition if they are few, and whether they are.

    Raking takes dozens of small jobs; each exchange in one costs the driver threads and memory for a while.
    """
    few = rows.limit(FEW + 1).count() <= FEW
    return (rows.coalesce(1) if few else rows), few


def _matched(rows: DataFrame, other: DataFrame, name: str, few: bool) -> DataFrame:
    """``rows`` joined with ``other``; both are one partition if ``few``, and stay where they are."""
    if few:
        return rows.join(other.coalesce(1).hint("shuffle_hash"), name).coalesce(1)
    return rows.join(other, name)


def _by_dimension(values: Mapping[str, float]) -> Column:
    chosen = F.lit(None).cast("double")
    for name, value in values.items():
        chosen = F.when(F.col("dimension") == name, F.lit(float(value))).otherwise(chosen)
    return chosen


def _share_of(value: Column) -> Column:
    """The share that the settings give to a language or topic; null where they name none."""
    share = F.lit(None).cast("double")
    for name, shares in (("lang", LANGUAGES), ("topic", TOPICS)):
        for given, own in shares.items():
            share = F.when((F.col("dimension") == name) & (value == given), F.lit(own)).otherwise(share)
    return share


def targets(cells: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """One row per dimension and value: ``tokens``, ``wanted``, ``supply`` and ``target``, as shares of the mix.

    * Sources want their tokens to the power ``DAMPING``.  Named languages and topics that are present divide what the
      others leave, by their shares; others want what they have.
    * ``supply`` is what the value gives if all of it is kept.  The targets are ``wanted`` times one factor
      per dimension, at most ``supply``, and sum to 1.

    The driver sees two sums per dimension at a time.
    """
    listed = [
        F.struct(F.lit(name).alias("dimension"), F.col(name).alias("value"), F.col("tokens")) for name in DIMENSIONS
    ]
    cells, few = _together(cells)
    values = written(
        cells.select(F.explode(F.array(*listed)).alias("v"))
        .groupBy("v.dimension", "v.value")
        .agg(F.sum("v.tokens").alias("tokens"))
        .withColumn("share", F.when(F.col("tokens") > 0, _share_of(F.col("value"))))
        .withColumn("damped", F.pow("tokens", F.lit(DAMPING))),
        "mix-values",
    )
    # There are at most as many values of a dimension as cells.
    values = values.coalesce(1) if few else values
    held = F.when(F.col("share").isNotNull(), F.col("tokens"))
    sums = values.groupBy("dimension").agg(
        F.sum("tokens").alias("total"), F.sum("damped").alias("damped"), F.sum(held).alias("free"), F.sum("share").alias("share")
    )
    known = {row["dimension"]: row for row in sums.collect()}

    def total(column: str) -> Column:
        return _by_dimension({name: known[name][column] or 1 if name in known else 1 for name in DIMENSIONS})

    wanted = (
        F.when(F.col("dimension") == "source", F.col("damped") / total("damped"))
        .when(F.col("share").isNull(), F.col("tokens") / total("total"))
        .otherwise(total("free") / total("total") * F.col("share") / total("share"))
    )
    values = values.select(
        "dimension",
        "value",
        "tokens",
        wanted.alias("wanted"),
        (F.col("tokens") / total("total") / F.lit(fraction)).alias("supply"),
    )
    factors = dict.fromkeys(DIMENSIONS, 1.0)
    while True:
        # Each turn finds at least one more value short of supply, or is the last one.
        scaled = F.col("wanted") * _by_dimension(factors)
        short = scaled >= F.col("supply")
        left = values.groupBy("dimension").agg(
            F.sum(F.when(short, F.col("supply")).otherwise(0.0)).alias("given"),
            F.sum(F.when(short, 0.0).otherwise(F.col("wanted"))).alias("open"),
        )
        found = dict(factors)
        for row in left.collect():
            if row["open"] > 0:
                found[row["dimension"]] = (1.0 - row["given"]) / row["open"]
        if all(abs(found[name] - factors[name]) < 1e-12 for name in DIMENSIONS):
            break
        factors = found
    return values.withColumn("target", F.least(F.col("wanted") * _by_dimension(factors), F.col("supply")))


def targeted(cells: DataFrame, values: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """``cells`` (the dimensions and ``tokens``) with ``weight``, ``bound`` and a target for each dimension.

    The weight is the share of tokens, the bound what the cell gives if all of it is kept.
    """
    cells, few = _together(cells)
    total = cells.agg(F.sum("tokens").alias("t")).first()["t"] or 1
    share = F.col("tokens") / F.lit(total)
    rows = cells.withColumn("weight", share).withColumn("bound", share / F.lit(fraction))
    for name in DIMENSIONS:
        own = values.filter(F.col("dimension") == name)
        own = own.select(F.col("value").alias(name), F.col("target").alias(f"target_{name}"))
        rows = _matched(rows, own, name, few)
    return written(rows, "raked-cells")


def _scaled(cells: DataFrame, name: str, few: bool = False) -> DataFrame:
    """One step of raking: the weights of each value of ``name`` times the factor that its target asks for.

    Too heavy values shrink as a whole; in too light ones the cells below their bounds
    take what those at theirs leave.  Without such cells nothing more can be had.
    """
    full = F.col("weight") >= F.col("bound")
    sums = cells.groupBy(name).agg(
        F.sum(F.least("weight", "bound")).alias("all"),
        F.sum(F.when(full, F.col("bound")).otherwise(0.0)).alias("given"),
        F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open"),
        F.max(f"target_{name}").alias("target"),
    )
    factor = (
        F.when((F.col("all") >= F.col("target")) & (F.col("all") > 0), F.col("target") / F.col("all"))
        .when(F.col("open") > 0, (F.col("target") - F.col("given")) / F.col("open"))
        .otherwise(1.0)
    )
    factors = sums.select(name, factor.alias("factor"))
    scaled = _matched(cells, factors, name, few)
    return scaled.withColumn("weight", F.col("weight") * F.col("factor")).drop("factor")


def raked(cells: DataFrame, turns: int = TURNS, least_move: float = MOVED) -> DataFrame:
    """``cells`` with ``weight`` fitted to ``target_<dimension>`` in turn, and never above ``bound``.

    Sums are grouped, which combines in each task before the shuffle, and joined back, so no
    value's cells meet in one task, unless there are ``FEW`` in all.  Each step is one written table, or each turn if
    cells are few: plans stay small, and a lost executor costs that much.  Where no weights meet all margins, raking ends when they settle; the last
    dimension then fits best.  Values without any weight stay without.
    """
    bounded = F.least("weight", "bound")
    cells, few = _together(cells)
    for _ in range(turns):
        cells = cells.withColumn("before", bounded)
        for name in DIMENSIONS:
            cells = _scaled(cells, name, few)
            if not few:
                cells = written(cells, "raked-cells")
        if few:
            cells = written(cells, "raked-cells").coalesce(1)
        moved = cells.agg(F.sum(F.abs(bounded - F.col("before"))).alias("t")).first()["t"]
        if (moved or 0.0) < least_move:
            break
    return cells.drop("before").withColumn("weight", bounded)


def _celled(documents: DataFrame, text: str) -> DataFrame:
    return documents.select(
        "*",
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("__source"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("__lang"),
        topic_of(F.col(text)).alias("__topic"),
        tokens(F.col(text)).alias("__tokens"),
    )


def _fitted(rows: DataFrame, fraction: float) -> tuple[DataFrame, DataFrame]:
    """The raked cells of ``rows``, and the targets they were raked to."""
    named = [F.col(f"__{name}").alias(name) for name in DIMENSIONS]
    cells = written(rows.groupBy(*named).agg(F.sum("__tokens").alias("tokens")), "cells")
    values = targets(cells, fraction)
    return raked(targeted(cells, values, fraction)), values


def mixed(
    documents: DataFrame, key: str = "doc_id", text: str = "text", fraction: float = FRACTION
) -> DataFrame:
    """All rows of ``documents`` with ``__topic``, ``__tokens``, ``__probability`` and ``__sampled``.

    A cell's probability is its fitted weight over its bound, so the expected tokens have the
    margins that ``targets`` gives, as far as the cells allow (see ``fit``).

    * Null sources and languages are values like others, the same as empty ones.
    * Documents of cells without tokens (null or empty texts only) cost nothing and always stay.
    * Equal keys draw alike, and so do null keys; an empty table gives an empty result.
    """
    rows = _celled(documents, text)
    fitted, _ = _fitted(rows, fraction)
    chances = fitted.select(
        *[F.col(name).alias(f"__{name}") for name in DIMENSIONS],
        F.when(F.col("tokens") == 0, 1.0).otherwise(F.col("weight") / F.col("bound")).alias("__probability"),
    )
    joined = rows.join(chances, [f"__{name}" for name in DIMENSIONS])
    draw = unit_draw(F.coalesce(F.col(key).cast("string"), F.lit("null")), "mix")
    return joined.withColumn("__sampled", draw < F.col("__probability"))


def fit(documents: DataFrame, text: str = "text", fraction: float = FRACTION) -> DataFrame:
    """How well the mix fits: per dimension and value ``wanted``, ``supply``, ``target`` and ``expected``.

    All are shares of the mix.  A ``target`` off ``wanted`` cannot be reached for lack of tokens, an ``expected`` off
    ``target`` because no weights of the cells meet all margins at once.
    """
    cells, values = _fitted(_celled(documents, text), fraction)
    listed = [
        F.struct(F.lit(name).alias("dimension"), F.col(name).alias("value"), F.col("weight")) for name in DIMENSIONS
    ]
    expected = (
        cells.select(F.explode(F.array(*listed)).alias("v"))
        .groupBy("v.dimension", "v.value")
        .agg(F.sum("v.weight").alias("expected"))
    )
    return values.join(expected, ["dimension", "value"]).select(
        "dimension", "value", "tokens", "wanted", "supply", "target", "expected"
    )


def sampled(documents: DataFrame) -> DataFrame:
    """The documents that the mix draws; columns unchanged."""
    return mixed(documents).filter("__sampled").select(*documents.columns)


def op2(documents: DataFrame) -> DataFrame:
    """Cell, tokens, probability (to nine places) and draw of every document."""
    return mixed(documents.select("doc_id", "text", "source", "lang")).select(
        "doc_id",
        F.col("__source").alias("source"),
        F.col("__lang").alias("lang"),
        F.col("__topic").alias("topic"),
        F.col("__tokens").alias("tokens"),
        F.round("__probability", 9).alias("probability"),
        F.col("__sampled").alias("sampled"),
    )


def sql(documents: str = "documents") -> str:
    """Common table expressions of the same in DuckDB SQL; the last one is ``mixed``."""

    def listed(shares: Mapping[str, float]) -> str:
        return ", ".join(f"('{value}', {share!r})" for value, share in shares.items())

    def wanted(name: str, shares: Mapping[str, float]) -> str:
        return f"""
    named_{name} AS (
      SELECT v.value, v.share, m.t FROM (VALUES {listed(shares)}) v(value, share)
      JOIN (SELECT {name} AS value, sum(tokens) AS t FROM cells GROUP BY {name}) m USING (value) WHERE m.t > 0
    ),
    free_{name} AS (SELECT sum(t)::DOUBLE AS t, sum(share) AS share FROM named_{name}),
    wanted_{name} AS (
      SELECT c.value, c.t, CASE WHEN n.value IS NULL THEN c.t / total.t
        ELSE f.t / total.t * n.share / f.share END AS wanted
      FROM (SELECT {name} AS value, sum(tokens)::DOUBLE AS t FROM cells GROUP BY {name}) c
      LEFT JOIN named_{name} n USING (value), total, free_{name} f
    ),"""

    def target(name: str) -> str:
        # Values in the order in which a growing factor exhausts them: the factor is that of the first one not exhausted.
        return f"""
    supply_{name} AS (SELECT value, wanted, w.t / total.t / {FRACTION} AS supply FROM wanted_{name} w, total),
    level_{name} AS (
      SELECT arg_min(factor, own) AS factor FROM (
        SELECT (1 - coalesce(sum(supply) OVER gone, 0)) / sum(wanted) OVER rest AS factor, supply / wanted AS own
        FROM supply_{name} WHERE wanted > 0
        WINDOW gone AS (ORDER BY supply / wanted, value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
          rest AS (ORDER BY supply / wanted, value ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
      ) WHERE factor <= own
    ),
    targets_{name} AS (
      SELECT value, least(wanted * coalesce(factor, 1), supply) AS target FROM supply_{name}, level_{name}
    ),"""

    turn = "(SELECT *, least(weight, bound) AS before FROM turns WHERE moved >= {MOVED} AND turn < {TURNS})".format(
        MOVED=MOVED, TURNS=TURNS
    )
    for name in DIMENSIONS:
        turn = f"""(
        SELECT * EXCLUDE (a, g, o) REPLACE (weight * CASE WHEN a >= target_{name} AND a > 0 THEN target_{name} / a
          WHEN o > 0 THEN (target_{name} - g) / o ELSE 1 END AS weight)
        FROM (SELECT *, sum(least(weight, bound)) OVER v AS a,
          sum(CASE WHEN weight >= bound THEN bound ELSE 0 END) OVER v AS g,
          sum(CASE WHEN weight >= bound THEN 0 ELSE weight END) OVER v AS o
          FROM {turn} WINDOW v AS (PARTITION BY {name})))"""
    return f"""
    celled AS (
      SELECT *, coalesce(source, '') AS c_source, coalesce(lang, '') AS c_lang,
        CASE WHEN strlen(coalesce(text, '')) < {SHORT} THEN 'short' WHEN contains(text, ' | ') THEN 'table'
          WHEN contains(text, '!!') OR contains(text, '***') THEN 'noisy' ELSE 'prose' END AS c_topic,
        ((coalesce(strlen(text), 0) + 3) // 4)::BIGINT AS c_tokens
      FROM {documents}
    ),
    cells AS MATERIALIZED (
      SELECT c_source AS source, c_lang AS lang, c_topic AS topic, sum(c_tokens)::BIGINT AS tokens
      FROM celled GROUP BY ALL
    ),
    total AS (SELECT greatest(sum(tokens), 1)::DOUBLE AS t FROM cells),
    sources AS (SELECT source AS value, pow(sum(tokens)::DOUBLE, {DAMPING}) AS t FROM cells GROUP BY source),
    damped AS (SELECT sum(t) AS t FROM sources),
    wanted_source AS (
      SELECT value, s.t / damped.t AS wanted, c.t FROM sources s
      JOIN (SELECT source AS value, sum(tokens)::DOUBLE AS t FROM cells GROUP BY source) c USING (value), damped
    ),{wanted("lang", LANGUAGES)}{wanted("topic", TOPICS)}{target("source")}{target("lang")}{target("topic")}
    turns AS (
      SELECT c.*, c.tokens / total.t AS weight, c.tokens / total.t / {FRACTION} AS bound,
        s.target AS target_source, l.target AS target_lang, o.target AS target_topic, 0 AS turn, 1.0::DOUBLE AS moved
      FROM cells c JOIN targets_source s ON s.value = c.source JOIN targets_lang l ON l.value = c.lang
      JOIN targets_topic o ON o.value = c.topic, total
      UNION ALL
      SELECT * EXCLUDE (before) REPLACE (turn + 1 AS turn, sum(abs(least(weight, bound) - before)) OVER () AS moved)
      FROM {turn}
    ),
    fitted AS (SELECT * FROM turns WHERE turn = (SELECT max(turn) FROM turns)),
    mixed AS (
      SELECT d.*, CASE WHEN w.tokens = 0 THEN 1.0::DOUBLE ELSE least(w.weight, w.bound) / w.bound END AS probability,
        (('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT + 0.5)
          / {float(1 << 52)} AS draw
      FROM celled d JOIN fitted w ON w.source = c_source AND w.lang = c_lang AND w.topic = c_topic
    )"""


OP2_SQL = f"""
WITH RECURSIVE {sql()}
SELECT doc_id, c_source AS source, c_lang AS lang, c_topic AS topic, c_tokens AS tokens,
  round(probability, 9) AS probability, draw < probability AS sampled
FROM mixed
"""
