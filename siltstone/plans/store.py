"""The store of routed texts, by route and by the day a file arrived."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.merge import append, fresh, unseen
from siltstone.plans.gold import on_days
from siltstone.schemas import DOMAINS, PARTITION, Lake

_DAY = PARTITION["routed_files"]


def _of_days(spark: SparkSession, lake: Lake, files: DataFrame) -> DataFrame:
    """The stored files that arrived on a day of ``files``; other folders are not read.

    The days go through the driver: a batch has no more of them than the store has folders.
    """
    days = [r[0] for r in files.select(_DAY).distinct().collect() if r[0] is not None]
    return fresh(spark, lake.routed).filter(on_days(_DAY, days, lake.grain))


def store_texts(spark: SparkSession, lake: Lake, texts: DataFrame, claimed: DataFrame) -> None:
    """Append the ``texts`` that are not stored yet.

    ``claimed(etag, arrival_date)`` is where to take the etags from. A file keeps its day when
    it is claimed again, so copies are looked for among the files of these days only.
    """
    part = lake.partition("routed_files")
    stored = _of_days(spark, lake, claimed)
    new = unseen(
        lake.dated(texts, "routed_files"),
        stored,
        ["etag"],
        stable=[part],
        candidates=lake.dated(claimed, "routed_files"),
    )
    append(new, lake.routed, part)


def stored_texts(spark: SparkSession, lake: Lake, files: DataFrame) -> DataFrame:
    """Texts of ``files(etag, arrival_date)`` on their way to silver.

    Only the folders of their days are read. A file that is not there, since two runs claimed
    it on two days, is looked up in the others.
    """
    wanted = files.select("etag").distinct()
    on_route = F.col("route").isin(*DOMAINS)
    near = _of_days(spark, lake, files).filter(on_route).join(wanted, "etag", "left_semi")
    missing = wanted.join(near.select("etag"), "etag", "left_anti")
    if missing.isEmpty():
        return near
    far = fresh(spark, lake.routed).filter(on_route).join(missing, "etag", "left_semi")
    return near.unionByName(far)
