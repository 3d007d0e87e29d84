"""A digest of the rows of a frame that depends on their content, not on their order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

#: Seeds of the two 64-bit hashes that a row has.
SEEDS = (1, 2)


def _told_apart(value: Column, kind: DataType) -> Column:
    """``value`` in a form whose hash tells a null from its absence, at any depth."""
    if isinstance(kind, StructType):
        inner = [_told_apart(value[field.name], field.dataType) for field in kind]
    elif isinstance(kind, ArrayType):
        inner = [F.transform(value, lambda one: _told_apart(one, kind.elementType))]
    elif isinstance(kind, MapType):
        entry = StructType().add("key", kind.keyType).add("value", kind.valueType)
        inner = [F.transform(F.map_entries(value), lambda one: _told_apart(one, entry))]
    elif isinstance(kind, VariantType):
        inner = [F.to_json(value)]
    else:
        inner = [value]
    return F.struct(value.isNull().alias("absent"), *(part.alias(f"part{i}") for i, part in enumerate(inner)))


def content_measures(frame: DataFrame) -> list[Column]:
    """Aggregates that together with the number of rows are the digest of ``frame``.

    Each row has two 64-bit hashes over all its columns in the order of their names, and the digest has the sum of
    each: rows in another order, in other files or tasks, give the same; another value, a value moved to another
    row, a lost or a repeated row do not.  Sums of parts can be added.
    """
    columns = [
        _told_apart(F.col(f"`{name}`"), frame.schema[name].dataType) for name in sorted(frame.columns)
    ]
    # 38 digits hold the sum of 10**18 rows.
    return [
        F.coalesce(F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)")), F.lit(0)).alias(f"digest{seed}")
        for seed in SEEDS
    ]


def content_digest(frame: DataFrame | None) -> dict[str, object]:
    """``rows`` and the digest of ``frame``, from one scan; nothing is shuffled but one row per task."""
    if frame is None:
        return {"rows": 0, **{f"digest{seed}": 0 for seed in SEEDS}}
    return frame.agg(F.count(F.lit(1)).alias("rows"), *content_measures(frame)).first().asDict()


def added(one: dict[str, object], other: dict[str, object]) -> dict[str, object]:
    """The digest of both frames' rows together."""
    return {name: one[name] + other[name] for name in one}
