"""One row per key.

``row_number() = 1`` lets Spark keep only the best row per key inside each map
task before the shuffle (WindowGroupLimit), so a hot key costs one row per
task, not its whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _best(df: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(window)).filter("_place = 1").drop("_place")


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the highest ``order`` columns per key, nulls last.

    End ``order`` in a unique column, or equal rows are picked at random.
    """
    return _best(df, keys, [F.col(c).desc_nulls_last() for c in order])


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the lowest ``order`` columns per key, nulls last."""
    return _best(df, keys, [F.col(c).asc_nulls_last() for c in order])
