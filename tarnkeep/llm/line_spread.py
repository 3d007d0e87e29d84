"""Line dedup by distinct-site spread.

Lines that occur on many distinct sites are boilerplate.  The sites of each line hash are counted by
HyperLogLog sketches that merge by aggregation; lines whose estimate is near the threshold
get an exact distinct count, and only then are lines removed.

Everything is a plan of Spark's own functions.  Lines that one site alone has never reach a sketch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnkeep.llm.tables import written

#: Distinct sites from which on a line is boilerplate.
SITES = 5
#: Size of a sketch as a power of two: a standard error of 1.6 % at 12.
SKETCH = 12
#: Estimates within this share of the threshold, or within one site of it, are counted exactly.
NEAR = 0.1


def _hashes(line: Column) -> list[Column]:
    """128 bits that name a line; white space around it does not matter."""
    line = F.trim(line)
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2")]


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def boilerplate(lines: DataFrame, sites: int = SITES) -> DataFrame:
    """``h1`` and ``h2`` of the lines that at least ``sites`` sites have.

    ``lines`` has ``h1``, ``h2`` and ``site``; a null site counts for nothing.
    """
    key = ["h1", "h2"]
    seen = lines.filter("site IS NOT NULL")
    place = F.xxhash64("site")
    ends = seen.groupBy(*key).agg(F.min(place).alias("lo"), F.max(place).alias("hi"))
    if sites <= 1:
        return ends.select(*key)
    several = written(ends.filter("lo <> hi").select(*key), "lines-on-sites")
    shared = written(seen.join(several, key, "left_semi"), "shared-lines")
    sketched = shared.groupBy(*key).agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", SKETCH)).alias("estimate")
    )
    margin = max(1.0, NEAR * sites)
    sketched = written(sketched, "line-sketches")
    near = sketched.filter((F.col("estimate") - sites).between(-margin, margin)).select(*key)
    exact = shared.join(near, key, "left_semi").select(*key, "site").distinct()
    exact = exact.groupBy(*key).agg(F.count("*").alias("n")).filter(F.col("n") >= sites)
    sure = sketched.filter(F.col("estimate") > sites + margin)
    return sure.select(*key).unionByName(exact.select(*key))


def cleaned(
    documents: DataFrame, text: str = "text", site: str = "source", sites: int = SITES
) -> DataFrame:
    """All rows and columns of ``documents`` with cross-site boilerplate lines taken out of ``text``.

    Adds ``n_lines`` and ``n_removed``.

    * Lines are separated by line feeds and compared without the blanks around them; blank lines
      are never removed.
    * A null text stays null, with no lines; a text of which every line is removed becomes empty.
    * Lines of rows without a site count for no site, but are removed like others.
    * Repeated rows are treated alike; an empty table gives an empty result; columns with the names
      of the added ones are replaced.
    """
    documents = documents.drop("n_lines", "n_removed")
    split = documents.select(
        _digest(F.col(text)).alias("digest"),
        F.col(site).cast("string").alias("site"),
        F.posexplode(F.split(F.col(text), "\n", -1)).alias("place", "line"),
    ).filter(F.trim("line") != "")
    lines = split.select("digest", "site", "place", *_hashes(F.col("line")))
    found = written(boilerplate(lines.select("h1", "h2", "site"), sites), "boilerplate")
    removed = (
        lines.join(found, ["h1", "h2"], "left_semi")
        .select("digest", "place")
        .distinct()
        .groupBy(F.col("digest").alias("__digest"))
        .agg(F.array_sort(F.collect_list("place")).alias("__places"))
    )
    marked = documents.withColumn("__digest", _digest(F.col(text)))
    joined = marked.join(removed, "__digest", "left")
    # Between two removed places lies a run of kept lines, so the work follows the lines.
    kept = F.expr(
        f"""element_at(transform(array(named_struct('lines', split(`{text}`, '\\n', -1), 'gone', __places)),
          x -> array_join(flatten(zip_with(
            concat(array(0), transform(x.gone, p -> p + 1)), concat(x.gone, array(size(x.lines))),
            (first, last) -> slice(x.lines, first + 1, last - first))), '\\n')), 1)"""
    )
    count = F.when(F.col(text).isNull(), 0).otherwise(F.size(F.split(F.col(text), "\n", -1)))
    return (
        joined.withColumn("n_lines", count.cast("bigint"))
        .withColumn("n_removed", F.coalesce(F.array_size("__places"), F.lit(0)).cast("bigint"))
        .withColumn(text, F.when(F.col("__places").isNull(), F.col(text)).otherwise(kept))
        .drop("__digest", "__places")
    )


def op3(documents: DataFrame) -> DataFrame:
    """Lines, removed lines and a digest of the text that stays, one row per document."""
    rows = cleaned(documents.select("doc_id", "text", "source"))
    text = F.coalesce("text", F.lit("")).cast("binary")
    return rows.select("doc_id", "n_lines", "n_removed", F.sha2(text, 256).alias("kept_sha256"))


OP3_SQL = f"""
WITH lines AS (
  SELECT doc_id, source, place, line FROM (
    SELECT doc_id, source, unnest(parts) AS line, generate_subscripts(parts, 1) AS place
    FROM (SELECT doc_id, source, string_split(text, chr(10)) AS parts FROM documents)
  )
),
spread AS (
  SELECT trim(line) AS line FROM lines WHERE trim(line) <> ''
  GROUP BY trim(line) HAVING count(DISTINCT source) >= {SITES}
),
marked AS (
  SELECT l.doc_id, l.place, l.line, s.line IS NOT NULL AS gone
  FROM lines l LEFT JOIN spread s ON trim(l.line) = s.line
),
kept AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
    string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone) AS text
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id)
"""
