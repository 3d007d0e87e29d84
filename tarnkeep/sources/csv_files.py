"""CSV scans: typed for loading, all-text for the schema gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from tarnkeep.sources.csv_records import (
    SEPARATORS,
    csv_profile,
    csv_records,
    fields_of,
    headers_of,
    options_of,
)


def sniff_separator(spark: SparkSession, path: str) -> str:
    """The candidate by which all records have as many fields as the header; a comma if none occurs in it.

    If several candidates fit, or some occur but none fits (line breaks in quotes, ragged lines), that is an error:
    name the separator then.
    """
    return _chosen(_plain_records(spark, path), path, None)[1]


def _chosen(records: DataFrame, path: str, sep: str | None) -> tuple[str, str, dict[str, str]]:
    """The header, the separator (given or told) and the column types of some records, from one scan of them."""
    first = records.orderBy("file", "block", "seq").first()
    if first is None:
        raise ValueError(f"{path} has no header")
    header = first.record
    tried = [sep] if sep else [s for s in SEPARATORS if len(fields_of(header, s)) > 1] or [SEPARATORS[0]]
    profile = csv_profile(records, tried, header)
    fitting = [one for one in tried if profile[one] is not None]
    if sep and not fitting:
        return header, sep, dict.fromkeys(fields_of(header, sep), "string")  # reading them will say what is wrong
    if len(fitting) != 1:
        raise ValueError(f"the separator of {path} cannot be told, it may be any of {fitting or tried}")
    return header, fitting[0], profile[fitting[0]]


def _schema(types: dict[str, str]) -> StructType:
    return StructType([StructField(name, _parse_datatype_string(kind)) for name, kind in types.items()])


def _plain_records(spark: SparkSession, path: str) -> DataFrame:
    """Lines as records, for files without line breaks in quotes; header lines are not told from others."""
    lines = spark.read.text(path).select(
        F.col("value").alias("record"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
    )
    return lines.filter(F.trim("record") != "")


def typed_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    sep: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Header row, typed columns, empty fields (quoted or not) as null.

    Give a ``schema`` and ``sep`` for anything large: what is not given is told from all records, in one more scan that
    looks at all separators, columns and types together.  Whole numbers become ``bigint``, so that a target made from
    one file has room for the values of the next; digits with leading zeros stay text.  The header is checked
    against the schema and a value that does not fit its type fails the query rather than turning into null.
    ``multi_line`` is needed for line breaks inside quotes; the records are then cut apart first (see
    :mod:`tarnkeep.sources.csv_records`), for which the lines are written once.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if multi_line:
        return _typed_records(csv_records(spark, path, sep or "".join(SEPARATORS)), path, schema, sep)
    if schema is None or sep is None:
        _, sep, types = _chosen(_plain_records(spark, path), path, sep)
        schema = schema or _schema(types)
    reader = spark.read.option("header", True).option("mode", "FAILFAST").options(**options_of(sep))
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def _typed_records(records: DataFrame, path: str, schema: StructType | None, sep: str | None) -> DataFrame:
    """The rows of ``records``, checked as Spark's reader checks files."""
    if schema is None or sep is None:
        _, sep, types = _chosen(records, path, sep)
        schema = schema or _schema(types)
    heads = headers_of(records)
    for row in heads.select("record").distinct().limit(2).collect():
        if [name.lower() for name in fields_of(row.record, sep)] != [name.lower() for name in schema.names]:
            raise ValueError(f"a header in {path} does not fit the schema: {row.record}")
    places = records.groupBy("file").agg(F.min(F.struct("block", "seq")).alias("head"))
    rows = records.join(places, "file").filter(F.struct("block", "seq") != F.col("head"))
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)
    parsed = F.from_csv("record", fields, {**options_of(sep), "mode": "FAILFAST"})
    return rows.select(parsed.alias("row")).select("row.*")


def raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Names from the header, every column a string; files with other headers fail the query."""
    return spark.read.option("header", True).option("enforceSchema", False).csv(path)
