"""Secret scans that link the parts of multipart credentials.

Strong findings (assigned passwords and tokens, access identifiers, long hex runs) are always
reported.  Weak candidates (short values, short identifiers, 40-character keys, user names,
endpoints) are reported only when a complementary part lies within reach: an interval join on
(text, bin of positions) finds for every candidate which other classes of parts start at most
``reach`` code points away.

Everything is a plan of Spark's own functions.  Findings depend on the text alone, so equal texts
are searched for partners once, under the SHA-256 of the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnkeep.llm.tables import written

#: Scope of a link: parts whose starts are at most so many code points apart belong together.
REACH = 200

# The base patterns and their least lengths.
ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
ASSIGN_VALUE, ACCESS_LENGTH = 12, 18

# Weak candidates.
SHORT_VALUE, SHORT_ACCESS = 6, 12
KEY40 = r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])"
IDENTIFIER = (
    r"""(?i)(access_?key_?id|client_?id|account_?id|user_?name|user|login)["']?"""
    r"""\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})"""
)
ENDPOINT = r"""(?i)[a-z][a-z0-9+.:-]{1,30}://[^\s"'<>]+"""

#: Kinds in the order of reports, with the class of part each one is.
KINDS = {
    "assign": "secret",
    "access": "identifier",
    "hex": "secret",
    "weak_secret": "secret",
    "weak_access": "identifier",
    "weak_key": "secret",
    "weak_identifier": "identifier",
    "endpoint": "endpoint",
}
BASE = ("assign", "access", "hex")
_BLOCK = 256
_PART = "array<struct<start:int,rank:int,end:int>>"


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once, even where lambdas use it many times."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _running(steps: Column) -> Column:
    """Running sums of an array, in blocks, so that long arrays take no quadratic copying."""

    def inside(block: Column) -> Column:
        return F.aggregate(
            block,
            F.struct(F.lit(0).alias("total"), F.expr("cast(array() as array<int>)").alias("sums")),
            lambda acc, x: F.struct(
                (acc["total"] + x).alias("total"),
                F.concat(acc["sums"], F.array(acc["total"] + x)).alias("sums"),
            ),
        )

    def joined(blocks: Column) -> Column:
        return F.aggregate(
            blocks,
            F.struct(
                F.lit(0).alias("base"), F.expr("cast(array() as array<array<int>>)").alias("all")
            ),
            lambda acc, x: F.struct(
                (acc["base"] + x["total"]).alias("base"),
                F.concat(acc["all"], F.array(F.transform(x["sums"], lambda s: s + acc["base"]))).alias(
                    "all"
                ),
            ),
            lambda acc: F.flatten(acc["all"]),
        )

    def blocks(values: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), F.lit(_BLOCK))
        return F.transform(starts, lambda at: inside(F.slice(values, at, F.lit(_BLOCK))))

    return _let(steps, lambda values: _let(blocks(values), joined))


def _located(text: Column, pattern: str, rank: Callable[[Column, Column], Column]) -> Column:
    """All leftmost matches with code point positions; ``rank(length, group 2 length)`` or null."""
    value = 2 if pattern in (ASSIGN, IDENTIFIER) else 0
    lengths = F.struct(
        F.transform(F.split(text, pattern, -1), F.length).alias("gaps"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length).alias("found"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(value)), F.length).alias(
            "values"
        ),
    )

    def spans(x: Column) -> Column:
        steps = F.zip_with(
            F.slice(x["gaps"], 1, F.size(x["found"])),
            F.concat(F.array(F.lit(0)), x["found"]),
            lambda gap, before: gap + before,
        )
        # zip_with pads the shorter array: the step after the last match is null and left out.
        starts = _running(F.filter(steps, lambda s: s.isNotNull()))
        return F.transform(
            F.arrays_zip(
                starts.alias("start"), x["found"].alias("length"), x["values"].alias("value")
            ),
            lambda m: F.struct(
                m["start"].alias("start"),
                rank(m["length"], m["value"]).alias("rank"),
                (m["start"] + m["length"]).alias("end"),
            ),
        )

    found = F.filter(_let(lengths, spans), lambda part: part["rank"].isNotNull())
    return F.when(text.rlike(pattern), found).otherwise(F.expr(f"cast(array() as {_PART})"))


def _rank(kind: str) -> Column:
    return F.lit(list(KINDS).index(kind))


def parts(text: Column) -> Column:
    """All strong findings and weak candidates of a text, as an array of start, rank and end.

    ``rank`` is the place of the kind in :data:`KINDS`.  Null is read as empty.
    """
    text = F.coalesce(text, F.lit(""))
    assigned = text.contains("=") | text.contains(":")
    none = F.expr(f"cast(array() as {_PART})")
    return F.concat(
        F.when(
            assigned,
            _located(
                text,
                ASSIGN,
                lambda n, value: F.when(value >= ASSIGN_VALUE, _rank("assign")).when(
                    value >= SHORT_VALUE, _rank("weak_secret")
                ),
            ),
        ).otherwise(none),
        F.when(
            text.contains("AKIA"),
            _located(
                text,
                ACCESS,
                lambda n, _: F.when(n >= ACCESS_LENGTH, _rank("access")).when(
                    n >= SHORT_ACCESS, _rank("weak_access")
                ),
            ),
        ).otherwise(none),
        _located(text, HEX, lambda n, _: _rank("hex")),
        _located(text, KEY40, lambda n, _: _rank("weak_key")),
        F.when(
            assigned, _located(text, IDENTIFIER, lambda n, _: _rank("weak_identifier"))
        ).otherwise(none),
        F.when(
            text.contains("://"), _located(text, ENDPOINT, lambda n, _: _rank("endpoint"))
        ).otherwise(none),
    )


def _class(rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in KINDS.values()]), rank + 1)


def linked(found: DataFrame, reach: int = REACH) -> DataFrame:
    """The weak rows of ``found`` (key, start, rank, end) that have their complement within reach.

    A weak secret needs an identifier, a weak identifier needs a secret, and an endpoint needs
    both.  Only the first and last start of each class in a bin as wide as the reach take part in
    the join: the same bin is always within reach, and of the bins beside it only the nearer end
    can decide.  So a text with many parts yields three rows per candidate and class, no pairs.
    """
    found = found.withColumn("class", _class(F.col("rank")))
    found = found.withColumn("bin", F.expr(f"start div {reach}"))
    ends = found.groupBy("key", "class", "bin").agg(
        F.min("start").alias("least"), F.max("start").alias("most")
    )
    weak = found.filter(F.col("rank") >= len(BASE)).withColumn(
        "near", F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1))
    )
    w, e = weak.alias("w"), ends.alias("e")
    pairs = w.join(
        e,
        (F.col("w.key") == F.col("e.key"))
        & (F.col("w.near") == F.col("e.bin"))
        & (F.col("w.class") != F.col("e.class"))
        & (F.col("e.most") >= F.col("w.start") - reach)
        & (F.col("e.least") <= F.col("w.start") + reach),
    )

    def has(name: str) -> Column:
        return F.max(F.when(F.col("e.class") == name, 1).otherwise(0)) == 1

    return (
        pairs.groupBy("w.key", "w.start", "w.rank", "w.end", "w.class")
        .agg(has("secret").alias("secret"), has("identifier").alias("identifier"))
        .filter(
            F.when(F.col("class") == "secret", F.col("identifier"))
            .when(F.col("class") == "identifier", F.col("secret"))
            .otherwise(F.col("secret") & F.col("identifier"))
        )
        .select("key", "start", "rank", "end")
    )


def scanned(documents: DataFrame, text: str = "text", reach: int = REACH) -> DataFrame:
    """All rows and columns of ``documents`` with ``secrets``: array of kind, start and end.

    * Positions are code points, ``end`` not included; ordered by start, then kind, then end.
    * Null and empty texts, and texts without findings, get an empty array.
    * Equal rows get equal results; an empty table gives an empty result; a column named
      ``secrets`` is replaced.
    """
    documents = documents.drop("secrets").withColumn(
        "__key", F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))
    )
    texts = documents.select(F.col("__key").alias("key"), parts(F.col(text)).alias("parts"))
    found = written(texts.select("key", F.inline("parts")).distinct(), "secret-parts")
    kept = found.filter(F.col("rank") < len(BASE)).unionByName(linked(found, reach))
    kinds = F.array(*[F.lit(kind) for kind in KINDS])
    spans = kept.groupBy("key").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("start", "rank", "end"))),
            lambda s: F.struct(
                F.element_at(kinds, s["rank"] + 1).alias("kind"),
                s["start"].alias("start"),
                s["end"].alias("end"),
            ),
        ).alias("secrets")
    )
    none = F.expr("cast(array() as array<struct<kind:string,start:int,end:int>>)")
    joined = documents.join(spans.withColumnRenamed("key", "__key"), "__key", "left")
    return joined.withColumn("secrets", F.coalesce("secrets", none)).drop("__key")


def op10(documents: DataFrame) -> DataFrame:
    """Counts of the base kinds and a digest of all spans, one row per document."""

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint")

    def listed(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    base = F.filter("secrets", lambda s: s["kind"].isin(*BASE))
    return scanned(documents.select("doc_id", "text")).select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("secrets")).alias("spans"),
    )
