"""Insert-only merge, and tables replaced as a whole, on plain parquet."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from siltstone.operators.rank import first_by


def unseen(
    rows: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    stable: Sequence[str] = (),
    candidates: DataFrame | None = None,
) -> DataFrame:
    """``rows`` whose key is not in ``target``.

    The target's keys are first cut down to those at hand. For a small batch
    Spark broadcasts its keys and the target is scanned without a shuffle; for a
    large one both sides shuffle once on the key and the second join reuses that
    layout.

    ``stable`` names columns that never change for a key, such as a partition
    column; they let Spark prune the target's partitions. ``candidates`` is
    where to take the keys from if ``rows`` is costly to compute twice.
    """
    on = [*keys, *stable]
    at_hand = (rows if candidates is None else candidates).select(*on).distinct()
    known = target.select(*on).join(at_hand, on, "left_semi").distinct()
    return rows.join(known, on, "left_anti")


def insert_new(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    stable: Sequence[str] = (),
) -> DataFrame:
    """The rows an insert-only merge would add: first row per new key.

    ``order`` decides between copies of a key inside ``source``. A null key
    equals nothing, so rows with one are all inserted.
    """
    null_key = " OR ".join(f"`{k}` IS NULL" for k in keys)
    keyed = source.filter(f"NOT ({null_key})")
    once = first_by(keyed, keys, order)
    new = unseen(once, target, keys, stable, candidates=keyed)
    return new.unionByName(source.filter(null_key))


def spread(df: DataFrame, partition: str | None) -> DataFrame:
    """Let AQE size the write tasks: small slices merged, large ones split.

    One partition value may hold any share of the rows, so the rows are not
    tied to one task per value.
    """
    return df.hint("rebalance", partition) if partition else df.hint("rebalance")


@contextmanager
def _with_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


_SMALL_TASKS = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "4k"}
#: Tables are read more often than written.
_PACKED = {"spark.sql.parquet.compression.codec": "zstd"}


def _insert(verb: str, df: DataFrame, table: str, partition: str | None, settings: dict[str, str]) -> None:
    """Write ``df`` by column name.

    A write to date partitions costs by its files more than by its bytes, so AQE may make
    small tasks, as many as there are cores. Rows of a date still meet in one task unless
    they are many: the number of files stays the same.
    """
    rows = df
    settings = settings | _PACKED
    if partition:
        settings = settings | _SMALL_TASKS
        rows = spread(df, partition)
    with _with_conf(df.sparkSession, settings):
        df.sparkSession.sql(f"INSERT {verb} {table} BY NAME SELECT * FROM {{rows}}", rows=rows)


_MODE = "spark.sql.sources.partitionOverwriteMode"


def append(df: DataFrame, table: str, partition: str | None = None) -> None:
    """Append by column name."""
    _insert("INTO", df if partition else spread(df, None), table, partition, {})


def overwrite(df: DataFrame, table: str, partition: str | None = None) -> None:
    """Replace all rows of a table; columns are matched by name, not by position."""
    rows = df if partition else spread(df, None)
    _insert("OVERWRITE TABLE", rows, table, partition, {_MODE: "static"})


def overwrite_partitions(df: DataFrame, table: str, partition: str | None = None) -> None:
    """Replace the partitions that ``df`` has rows for and leave the others.

    New files are staged and moved in at the end, so ``df`` may read ``table``.
    ``partition`` lets AQE size the tasks; leave it out to keep the layout.
    """
    _insert("OVERWRITE TABLE", df, table, partition, {_MODE: "dynamic"})


_VERSION = "__v_"


def location(spark: SparkSession, table: str) -> str:
    """Folder that ``table`` reads now."""
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").collect()
    return next(r.data_type for r in rows if r.col_name == "Location").rstrip("/")


def publish(df: DataFrame, table: str, partition: str | None = None, laid_out: bool = False) -> None:
    """Replace all rows of a published table at once; ``df`` may read it.

    ``laid_out`` says that ``df`` reads a table of the same partitions row by row: its tasks
    hold few of them each, so the rows are written where they are read, without a shuffle.

    The rows are written to a folder of their own; then the table's location is set to it,
    which is one change in the catalog. Until then, and if the write dies, readers get the
    old rows. Old versions stay for those who still read them: see ``expire_versions``.
    """
    spark = df.sparkSession
    home, _, name = location(spark, table).rpartition("/")
    path = f"{home}/{name.split(_VERSION)[0]}{_VERSION}{uuid.uuid4().hex}"
    columns = spark.table(table).columns
    rows = df.select(*columns)
    writer = (rows if laid_out else spread(rows, partition)).write
    with _with_conf(spark, _PACKED | (_SMALL_TASKS if partition else {})):
        (writer.partitionBy(partition) if partition else writer).parquet(path)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)


def drop_folders(spark: SparkSession, table: str, partition: str, values: Sequence) -> None:
    """Remove partitions of a published table that hold no row any more."""
    here = location(spark, table)
    for value in values:
        _remove(spark, f"{here}/{partition}={value}")
    spark.catalog.refreshTable(table)


def expire_versions(spark: SparkSession, table: str, hours: float = 168) -> int:
    """Remove versions of a published table written more than ``hours`` ago, but not the present one."""
    here = location(spark, table)
    home, _, name = here.rpartition("/")
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(home)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    limit = jvm.java.lang.System.currentTimeMillis() - int(hours * 3600 * 1000)
    own = name.split(_VERSION)[0]
    gone = 0
    for status in system.listStatus(folder):
        found = status.getPath().getName()
        version = found == own or found.startswith(own + _VERSION)
        if version and found != name and status.getModificationTime() < limit:
            system.delete(status.getPath(), True)
            gone += 1
    return gone


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def fresh(spark: SparkSession, table: str) -> DataFrame:
    """``table`` with a new file listing, so appends of other sessions are seen."""
    spark.catalog.refreshTable(table)
    return spark.table(table)
