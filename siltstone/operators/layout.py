"""Clustered rewrite of a table: rows close in several columns share files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.merge import fresh, overwrite_partitions, publish
from siltstone.schemas import CLUSTER_BY, CLUSTERED, SILVER, Lake
from siltstone.session import cut_lineage

SAMPLE_ROWS = 4096


def bucket_bounds(
    df: DataFrame, columns: Sequence[str], bits: int, sample_rows: int = SAMPLE_ROWS
) -> dict[str, list]:
    """At most ``2**bits - 1`` cut points per column, from one sample of bounded size.

    A count sets the rate at which each task keeps rows by a hash of their position, so
    all tasks together pass on about four samples, however many they are.
    """
    scale = 1 << 40
    kept = int(scale * min(1.0, 4 * sample_rows / max(df.count(), 1)))
    draw = F.xxhash64(F.monotonically_increasing_id())
    marked = df.select(*columns, draw.alias("_draw"))
    thin = marked.filter(F.pmod("_draw", F.lit(scale)) < kept)
    drawn = thin.orderBy("_draw").limit(sample_rows).drop("_draw").collect()
    parts = 2**bits
    bounds = {}
    for position, column in enumerate(columns):
        values = sorted(row[position] for row in drawn if row[position] is not None)
        cuts = {values[len(values) * i // parts] for i in range(1, parts)} if values else set()
        bounds[column] = sorted(cuts)
    return bounds


def bucket_of(column: Column, bounds: list, data_type: str) -> Column:
    """Number of bounds at or below the value; null counts as the lowest.

    Nested conditions halve the bounds, which stays within generated code.
    """

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        reached = column >= F.lit(bounds[middle]).cast(data_type)
        return F.when(reached, between(middle + 1, high)).otherwise(between(low, middle))

    return F.when(column.isNull(), 0).otherwise(between(0, len(bounds)))


def interleaved(buckets: Sequence[Column], bits: int) -> Column:
    """Z-value: the bits of all bucket numbers, taken in turn from the lowest."""
    z = F.lit(0).cast("bigint")
    width = len(buckets)
    for position, bucket in enumerate(buckets):
        for bit in range(bits):
            picked = F.shiftright(bucket, bit).bitwiseAND(F.lit(1)).cast("bigint")
            z = z.bitwiseOR(F.shiftleft(picked, bit * width + position))
    return z


def z_value(df: DataFrame, columns: Sequence[str], bits: int = 6) -> Column:
    """Z-value column over ``columns``; draws one sample of ``df``."""
    types = dict(df.dtypes)
    bounds = bucket_bounds(df, columns, bits)
    buckets = [bucket_of(F.col(c), bounds[c], types[c]) for c in columns]
    return interleaved(buckets, bits)


def clustered(
    df: DataFrame, columns: Sequence[str], files: int, partition: str | None = None, bits: int = 6
) -> DataFrame:
    """``df`` range-partitioned and sorted by partition column and z-value.

    The clustering columns and a per-row hash come after the z-value, so rows
    that share one z-value, or even one key, still spread over several tasks.
    """
    lead = [partition] if partition else []
    spread = F.xxhash64(F.monotonically_increasing_id())
    marked = df.withColumns({"_z": z_value(df, columns, bits), "_spread": spread})
    order = [*lead, "_z", *columns]
    return (
        marked.repartitionByRange(files, *order, "_spread")
        .sortWithinPartitions(*order)
        .drop("_z", "_spread")
    )


def _only_partition(rows: DataFrame, partition: str, where: str) -> None:
    """Refuse a predicate that reads anything but the partition column."""
    kind = dict(rows.dtypes)[partition]
    alone = rows.sparkSession.createDataFrame([], f"`{partition}` {kind}")
    try:
        alone.filter(where).schema
    except AnalysisException as error:
        raise ValueError(f"{where!r} must be a predicate on {partition} alone") from error


def _layout(rows: DataFrame, part: str) -> DataFrame:
    """One row per partition of a table: the write that made its files, their number and rows.

    Reads no column but the partition's, so a Parquet scan takes the counts from the footers.
    Spark names files by position and write; where several writes made them, or files came
    under other names, ``job`` is null.
    """
    name = F.col("_metadata.file_name")
    write = F.regexp_extract(name, r"^part-[0-9]+-([0-9a-f-]{36})", 1)
    files = rows.groupBy(F.col(part).alias("part"), name.alias("file")).agg(
        F.first(write).alias("write"), F.count("*").alias("rows")
    )
    one = (F.min("write") == F.max("write")) & (F.min("write") != "")
    return files.groupBy("part").agg(
        F.when(one, F.min("write")).alias("job"), F.count("*").alias("files"), F.sum("rows").alias("rows")
    )


def _in_parts(part: str, values: Sequence) -> Column:
    named = F.col(part).isin([v for v in values if v is not None])
    return named | F.col(part).isNull() if None in values else named


def maintain(spark: SparkSession, lake: Lake = Lake(), files: int = 200) -> dict[str, int]:
    """Cluster what was written since the last call; returns the partitions rewritten, by table.

    ``control.clustered`` has the write that left a partition clustered. A partition whose files
    are all of that write is left alone; any other, with new, replaced or lacking files, is
    rewritten, with its share of ``files`` by rows. It is recorded only if its files are then of
    one write: a partition that got rows meanwhile is taken again by the next call, and so is
    all of a call that died. One call at a time.
    """
    done = {}
    for name, columns in CLUSTER_BY.items():
        table = lake.silver(name) if name in SILVER else lake.gold(name)
        done[name] = _maintain_table(spark, lake, table, name, columns, files)
    return done


def _maintain_table(
    spark: SparkSession, lake: Lake, table: str, name: str, columns: Sequence[str], files: int
) -> int:
    part = lake.partition(name)
    state = fresh(spark, lake.clustered).filter(F.col("name") == name).drop("name")
    now = _layout(fresh(spark, table), part)
    same = F.col("job").eqNullSafe(F.col("old_job")) & (F.col("files") == F.col("old_files"))
    old = state.select(F.col("part").alias("old"), F.col("job").alias("old_job"), F.col("files").alias("old_files"))
    marked = now.join(old, F.col("part").eqNullSafe(F.col("old")), "left")
    marked = marked.withColumn("clean", F.coalesce(same & F.col("job").isNotNull(), F.lit(False))).collect()
    todo = [r for r in marked if not r.clean]  # no more rows than the table has partitions
    if not todo:
        return 0
    where = _in_parts(part, [r.part for r in todo])
    share = sum(r.rows for r in todo) / sum(r.rows for r in marked)
    rows = fresh(spark, table).filter(where)
    overwrite_partitions(clustered(rows, columns, max(1, round(files * share)), part), table)

    made = _layout(fresh(spark, table).filter(where), part).filter("job IS NOT NULL")
    kept = state.filter(~F.coalesce(_in_parts("part", [r.part for r in todo]), F.lit(False)))
    others = fresh(spark, lake.clustered).filter(F.col("name") != name)
    own = kept.unionByName(made.drop("rows")).withColumn("name", F.lit(name))
    publish(cut_lineage(others.unionByName(own).select(*CLUSTERED)), lake.clustered, "name")
    return len(todo)


def cluster_table(
    spark: SparkSession,
    table: str,
    columns: Sequence[str],
    files: int,
    partition: str | None = None,
    where: str | None = None,
    bits: int = 6,
) -> None:
    """Rewrite ``table`` clustered by ``columns``.

    A partitioned table gets its partitions replaced in place; ``where`` may
    limit that to some of them and must be a predicate on the partition column
    alone, or rows of the touched partitions would be lost; any other is refused.
    Any other table is written as a copy that is then swapped in; a swap that was
    broken off is undone by the next call.
    """
    copy, old = f"{table}__clustered", f"{table}__old"
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(old):
        spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
    rows = fresh(spark, table)
    if partition:
        if where:
            _only_partition(rows, partition, where)
        rows = rows.filter(where) if where else rows
        overwrite_partitions(clustered(rows, columns, files, partition, bits), table)
        spark.catalog.refreshTable(table)
        return
    if where:
        raise ValueError("only a partitioned table can be rewritten in part")
    spark.sql(f"DROP TABLE IF EXISTS {copy}")
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    clustered(rows, columns, files, bits=bits).write.format("parquet").saveAsTable(copy)
    spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {copy} RENAME TO {table}")
    spark.sql(f"DROP TABLE {old}")
