"""The ledger as tables: a log by day, and a snapshot of what older days came to.

``fold`` publishes the newest transition of every etag before a day, files that still wait
or have later rows apart from those that are done. Readers take the snapshot and the days since; whoever writes after a
fold writes to a day that is not in it, whatever clock the run goes by.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.text import utc_day
from siltstone.operators import ledger as L
from siltstone.operators.merge import append, fresh, publish
from siltstone.schemas import LEDGER, Lake

#: States from which a file can still go on.
OPEN = (L.IN_PROGRESS, L.VALIDATED, L.IN_SILVER)


def folded_to(spark: SparkSession, lake: Lake) -> date | None:
    """The first day that is not in the snapshot; all its rows have it."""
    row = fresh(spark, lake.ledger_snapshot).select("folded_to").first()
    return row and row.folded_to


def _since(spark: SparkSession, lake: Lake, day: date | None) -> DataFrame:
    log = fresh(spark, lake.ledger)
    column = F.col(lake.partition("file_ledger"))
    # rows that came without a day are never folded
    return log if day is None else log.filter((column >= F.lit(day)) | column.isNull())


def ledger_log(spark: SparkSession, lake: Lake, waiting: bool = False) -> DataFrame:
    """Transitions that give the same current state as the whole log.

    With ``waiting`` files are left out that were done, without later rows, when the snapshot
    was made: enough to find the files that wait, as rows written since then are newer.
    """
    day = folded_to(spark, lake)
    tail = _since(spark, lake, day).select(*LEDGER)
    if day is None:
        return tail
    held = fresh(spark, lake.ledger_snapshot)
    return (held.filter("is_open") if waiting else held).select(*LEDGER).unionByName(tail)


def record(spark: SparkSession, lake: Lake, rows: DataFrame) -> None:
    """Append transitions to the log, under the day of ``updated_at`` or the first not folded."""
    day = folded_to(spark, lake)
    first = F.lit(day).cast("date")
    dated = rows.withColumn("log_date", F.greatest(utc_day(F.col("updated_at")), first))
    append(lake.dated(dated, "file_ledger"), lake.ledger, lake.partition("file_ledger"))


def fold(spark: SparkSession, lake: Lake, before: date) -> bool:
    """Publish a snapshot of all days before ``before``; False if it holds them already.

    Reads the last snapshot and the days since only. ``before`` should lie so far back that
    every run that began earlier is over. By months it is the first day of its month.
    """
    day = folded_to(spark, lake)
    if lake.grain == "month":
        before = before.replace(day=1)
    if day is not None and before <= day:
        return False
    column = F.col(lake.partition("file_ledger"))
    rows = _since(spark, lake, day).filter(column < F.lit(before)).select(*LEDGER)
    if day is not None:
        rows = rows.unionByName(fresh(spark, lake.ledger_snapshot).select(*LEDGER))
    later = _since(spark, lake, before).select("etag").distinct().withColumn("later", F.lit(True))
    state = L.current(rows).join(later, "etag", "left")
    marks = {"folded_to": F.lit(before), "is_open": F.col("status").isin(*OPEN) | F.coalesce("later", F.lit(False))}
    publish(state.withColumns(marks), lake.ledger_snapshot, "is_open")
    return True
