"""Schemas as rows: field lists, drift between two of them, approval state, cast."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from tarnkeep.functions.casts import strict_cast

PATHS = "path string, parent string, type_text string"
FIELDS = "position int, column_name string, type_text string, nullable boolean"

# File names in a schema registry.
APPROVED_ENDING = ".json"
BOOTSTRAP_ENDING = "_InitialLoad.json"


def schema_fields(spark: SparkSession, schema: StructType) -> DataFrame:
    """One row per top-level field; of repeated names the last one counts."""
    rows = {
        field.name: (position, field.name, str(field.dataType), field.nullable)
        for position, field in enumerate(schema.fields)
    }
    return spark.createDataFrame(list(rows.values()), FIELDS)


def schema_drift(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """All differences between two field lists, by exact name.

    ``kind`` is ``missing``, ``unexpected`` or ``type``.  Column order, top-level nullability
    and metadata do not count; nested ones do as far as the type text shows them.
    """
    sides = expected.select("column_name", F.col("type_text").alias("expected")).join(
        actual.select("column_name", F.col("type_text").alias("actual")), "column_name", "full"
    )
    kind = (
        F.when(F.col("actual").isNull(), "missing")
        .when(F.col("expected").isNull(), "unexpected")
        .when(F.col("expected") != F.col("actual"), "type")
    )
    return (
        sides.select("column_name", kind.alias("kind"), "expected", "actual")
        .filter(F.col("kind").isNotNull())
        .orderBy("kind", "column_name")
    )


def _paths(kind: DataType, path: str, parent: str | None, nullable: bool) -> Iterator[tuple]:
    """The path, its parent, and the type of ``kind`` and of all that it holds.

    What holds others is named by its kind alone, since they have rows of their own.  Within others a place that
    must not be null says so, as the text of a whole type would.
    """
    needed = "" if parent is None or nullable else " not null"
    if isinstance(kind, StructType):
        text = "struct"
        inner = [(f.dataType, f"{path}.{f.name}", f.nullable) for f in {f.name: f for f in kind}.values()]
    elif isinstance(kind, ArrayType):
        text, inner = "array", [(kind.elementType, f"{path}[]", kind.containsNull)]
    elif isinstance(kind, MapType):
        text = "map"
        inner = [(kind.keyType, f"{path}{{key}}", False), (kind.valueType, f"{path}{{value}}", kind.valueContainsNull)]
    else:
        text, inner = str(kind), []
    yield path, parent, text + needed
    for one, at, may_be_null in inner:
        yield from _paths(one, at, path, may_be_null)


def schema_paths(spark: SparkSession, schema: StructType) -> DataFrame:
    """One row per column and per place within it: ``a``, ``a.b`` in a struct, ``a[]`` in an array, ``a{key}`` and
    ``a{value}`` in a map; of repeated names the last one counts."""
    columns = {field.name: field for field in schema}.values()
    rows = [row for f in columns for row in _paths(f.dataType, f.name, None, True)]
    return spark.createDataFrame(rows, PATHS)


def path_drift(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """All differences between two lists of paths, as :func:`schema_drift` gives those of columns.

    A place is reported where its parent is in both lists and of the same kind: of a struct that is missing or has become
    a text there is one row, and of a struct with one renamed field a missing and an unexpected one.
    """
    both = expected.alias("e").join(actual.alias("a"), "path", "full")
    different = both.select(
        "path",
        F.coalesce("e.parent", "a.parent").alias("parent"),
        F.col("e.type_text").alias("expected"),
        F.col("a.type_text").alias("actual"),
    ).filter(~F.equal_null("expected", "actual"))
    reported = different.select(F.col("path").alias("above"), F.col("expected").alias("e"), F.col("actual").alias("a"))
    # The same kind with another nullness still holds the same places.
    kinds = [F.regexp_replace(F.coalesce(side, F.lit("")), " not null$", "") for side in ("e", "a")]
    reported = reported.filter(kinds[0] != kinds[1]).select("above")
    topmost = different.join(reported, different["parent"] == reported["above"], "left_anti")
    kind = (
        F.when(F.col("actual").isNull(), "missing").when(F.col("expected").isNull(), "unexpected").otherwise("type")
    )
    return topmost.select(F.col("path").alias("column_name"), kind.alias("kind"), "expected", "actual").orderBy(
        "kind", "column_name"
    )


def cast_to(frame: DataFrame, schema: StructType) -> DataFrame:
    """Columns by name, cast to the approved types, in the approved order.

    A value that does not fit, or a null in a field that must not be null, fails the query
    while it is written; neither needs a pass of its own.
    """

    def cast(field):
        value = strict_cast(frame.sparkSession, F.col(f"`{field.name}`"), field.dataType)
        if not field.nullable:
            refusal = F.raise_error(F.lit(f"null in non-nullable field {field.name}"))
            value = F.when(value.isNotNull(), value).otherwise(refusal.cast(field.dataType))
        return value.alias(field.name)

    return frame.select(*[cast(field) for field in schema])


def rejected_rows(frame: DataFrame, schema: StructType) -> DataFrame:
    """Rows that ``cast_to`` would refuse, unchanged, with the names of the bad columns."""

    def bad(field):
        value = F.col(f"`{field.name}`")
        unfit = value.isNotNull() & value.try_cast(field.dataType).isNull()
        if not field.nullable:
            unfit = unfit | value.isNull()
        return F.when(unfit, field.name)

    reasons = F.array_compact(F.array(*[bad(field) for field in schema]))
    return frame.withColumn("bad_columns", reasons).filter(F.size("bad_columns") > 0)


def approval_states(tables: DataFrame, files: DataFrame) -> DataFrame:
    """``approved``, ``review`` (only a bootstrap schema) or ``missing`` for every table.

    ``tables`` has ``schema_name`` and ``table_name``; ``files`` lists the registry with
    ``schema_name`` and ``file_name``.  An approved file outranks a bootstrap one.
    """
    name = F.col("file_name")
    bootstrap = F.endswith(name, F.lit(BOOTSTRAP_ENDING))
    ending = F.when(bootstrap, len(BOOTSTRAP_ENDING)).otherwise(len(APPROVED_ENDING))
    found = (
        files.filter(F.endswith(name, F.lit(APPROVED_ENDING)))
        .select(
            "schema_name",
            F.substr(name, F.lit(1), F.length(name) - ending).alias("table_name"),
            bootstrap.alias("is_bootstrap"),
        )
        .groupBy("schema_name", "table_name")
        .agg(F.bool_and("is_bootstrap").alias("only_bootstrap"))
    )
    state = (
        F.when(F.col("only_bootstrap").isNull(), "missing")
        .when(F.col("only_bootstrap"), "review")
        .otherwise("approved")
    )
    return tables.join(found, ["schema_name", "table_name"], "left").select(
        "schema_name", "table_name", state.alias("state")
    )
