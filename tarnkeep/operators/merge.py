"""Keyed merge as an anti join and a union."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from tarnkeep.functions.casts import strict_cast


def conform(source: DataFrame, schema: StructType) -> DataFrame:
    """Columns by name, in the order and the types of ``schema``.

    A missing or an extra column is an error, and so is a value that does not fit or would lose
    digits or its time.
    """
    missing = sorted(set(schema.names) - set(source.columns))
    extra = sorted(set(source.columns) - set(schema.names))
    if missing or extra:
        raise ValueError(f"source does not fit the target: missing {missing}, extra {extra}")
    spark = source.sparkSession
    return source.select(
        *[
            strict_cast(
                spark,
                F.col(f"`{field.name}`"),
                field.dataType,
                source.schema[field.name].dataType,
            ).alias(field.name)
            for field in schema
        ]
    )


def _orderable(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return all(_orderable(field.dataType) for field in kind)
    if isinstance(kind, ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, (MapType, VariantType))


def last_per_key(source: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """One row per key, the greatest by ``order_by``; rows with a null key all stay.

    Each task keeps one row per key before the shuffle.  Equal order values are settled by
    the other columns that have an order (maps have none), so a re-run gives the same row.
    """
    rest = [
        field.name
        for field in source.schema
        if field.name not in order_by and _orderable(field.dataType)
    ]
    row = F.struct(*source.columns)
    greatest = F.max_by(row, F.struct(*order_by, *rest)).alias("row")
    known = source.filter(F.col(key).isNotNull()).groupBy(key).agg(greatest)
    return known.select(*[f"row.{name}" for name in source.columns]).unionAll(
        source.filter(F.col(key).isNull())
    )


def merge_rows(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Target after the merge: all source rows and the target rows whose key is not in it.

    A null key equals nothing, so null-key rows of both sides stay.  Adaptive execution picks the
    join from real sizes.  Where both sides are shuffled, the null-key rows of the target, which
    would all land in one partition, are spread by the number of the scan task that read them.
    """
    spread = "spread_of_null_keys"

    def spreaded(frame: DataFrame) -> DataFrame:
        return frame.withColumn(
            spread, F.when(F.col(key).isNull(), F.spark_partition_id()).otherwise(-1)
        )

    keys = spreaded(source.select(key))
    kept = spreaded(target).join(keys, [key, spread], "left_anti").drop(spread)
    return source.unionByName(kept)
