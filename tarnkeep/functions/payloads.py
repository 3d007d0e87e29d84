"""Reading service replies that arrive as JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_STRICT = {"columnNameOfCorruptRecord": "unreadable", "allowSingleQuotes": "false"}

def reply_object(body: Column, field: str) -> Column:
    """Struct with one ``variant`` field, or null if ``body`` is not one JSON object.

    ``from_json`` on the bare body stops at the closing brace and accepts anything after it;
    inside a wrapper object the trailing text becomes a syntax error.
    """
    wrapped = F.concat(F.lit('{"reply":'), body, F.lit("}"))
    parsed = F.from_json(wrapped, f"reply struct<{field}:variant>, unreadable string", _STRICT)
    return parsed.getField("reply")


def text_or(value: Column, default: str) -> Column:
    """Text of a variant; ``default`` if the field is absent, null if it is a JSON null."""
    return (
        F.when(value.isNull(), F.lit(default))
        .when(F.is_variant_null(value), F.lit(None).cast("string"))
        .otherwise(F.try_variant_get(value, "$", "string"))
    )
