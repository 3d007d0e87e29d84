"""Name rules: environment suffixes, workspace and item patterns, path pieces."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Item naming rules.
WAREHOUSE_NAME = r"^WH_[^_]+_[^_]+$"
ENDPOINT_NAME = r"^LH_[^_]+_[^_]+$"
WAREHOUSE_TYPE = "Warehouse"
ENDPOINT_TYPE = "SQLEndpoint"


def env_suffix(name: Column) -> Column:
    """``_`` and the text after the last ``_`` of a name, or the empty string."""
    return F.when(
        F.contains(name, F.lit("_")),
        F.concat(F.lit("_"), F.substring_index(name, "_", -1)),
    ).otherwise("")


def workspace_pattern(domains: Sequence[str], suffix: str) -> str:
    """Regular expression for ``WS_<domain><suffix>``.

    Domains are patterns themselves and stay as they are; the suffix is plain text.
    """
    return rf"^WS_({'|'.join(domains)}){re.escape(suffix)}$"


def matches(name: Column, pattern: str) -> Column:
    """True where the start-anchored ``pattern`` matches, ignoring case."""
    return name.rlike(f"(?iu)^(?:{pattern})")


def last_segment(path: Column) -> Column:
    """The part of a path after its last ``/``."""
    return F.substring_index(path, "/", -1)


def without_prefix(path: Column, prefix: Column) -> Column:
    """``path`` with one leading ``prefix`` cut off, if it is there."""
    return F.when(
        F.startswith(path, prefix), F.substr(path, F.length(prefix) + 1)
    ).otherwise(path)


def pad_to(text: Column, width: int) -> Column:
    """Left-justify to ``width``; longer text is kept whole (``rpad`` alone would cut it)."""
    return F.when(F.length(text) < width, F.rpad(text, width, " ")).otherwise(text)
