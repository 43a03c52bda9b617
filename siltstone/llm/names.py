"""Names for helper columns that no input column has."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spare_prefix(df: DataFrame) -> str:
    """Underscores that no column of ``df`` begins with."""
    prefix = "__"
    while any(c.startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix
