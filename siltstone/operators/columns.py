"""Column-set helpers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` itself, or ValueError naming the columns it lacks."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return df


def union_by_name(frames: Sequence[DataFrame], fill_missing: bool = False) -> DataFrame:
    """Union of any number of frames, matched by column name."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill_missing), frames)


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a costly column so that later filters on it do not repeat the work.

    Spark pushes a filter below the projection it reads from and evaluates the
    column's expression in both places, once per mention. A one-row generator
    yields the same rows and is not crossed.
    """
    return df.select("*", F.stack(F.lit(1), value).alias(name))
