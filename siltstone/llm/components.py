"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.session import scratch_path


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Point each node's larger (or other smaller) neighbours at its least neighbour."""
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        found = both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b")
    else:  # a < b: a node's smaller neighbours and itself
        least = edges.groupBy("b").agg(F.min("a").alias("m"))
        found = edges.join(least, "b").select(F.col("m").alias("a"), F.col("a").alias("b"))
        found = found.union(least.select(F.col("m").alias("a"), "b"))
    return found.filter("a < b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (``a, b``), labelled by its least node.

    Rounds go on until the edges no longer change; each is written to the shared folder,
    which cuts the lineage. A hub's edges meet its single row in a join, which adaptive
    execution splits. Self links and repeated links do no harm; nulls are dropped.
    """
    spark = links.sparkSession
    path = scratch_path(spark, "components")
    edges = (
        links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    seen, turn = None, 0
    while True:
        edges.write.parquet(f"{path}/{turn}")
        edges = spark.read.schema("a bigint, b bigint").parquet(f"{path}/{turn}")
        mark = edges.select(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if mark == seen or not mark[0]:
            break
        seen, turn = mark, turn + 1
        edges = _stars(_stars(edges, large=True), large=False)
    heads = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(heads)
