"""Silver to gold."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators import star
from siltstone.operators.changes import take, untaken
from siltstone.operators.merge import drop_folders, fresh, overwrite_partitions, publish
from siltstone.operators.rank import latest_by
from siltstone.schemas import GOLD, Lake, partition_column
from siltstone.session import cut_lineage, instant, scratch_path

GOLD_CONSUMER = "gold"


def refresh_gold(spark: SparkSession, lake: Lake = Lake()) -> None:
    """Rebuild the star schema; orders come last, as they read the payments.

    Every table is written aside and published when whole; readers never see a part of it.
    """
    _publish_users(spark, star.latest_users(fresh(spark, lake.silver("user_events"))), lake)
    # payments keep their date, so they lie as they lie in silver
    payments = star.fact_payments(fresh(spark, lake.silver("payment_events")))
    _publish(payments, "fact_payments", lake, laid_out=True)
    orders = star.fact_orders(fresh(spark, lake.silver("order_events")), fresh(spark, lake.gold("fact_payments")))
    _publish(orders, "fact_orders", lake)


def _publish(rows: DataFrame, name: str, lake: Lake, laid_out: bool = False) -> None:
    publish(lake.dated(rows, name), lake.gold(name), lake.partition(name), laid_out)


def _publish_users(spark: SparkSession, latest: DataFrame, lake: Lake) -> None:
    """Both user tables from one computation."""
    publish(latest, lake.user_latest)
    publish(fresh(spark, lake.user_latest).select(*GOLD["dim_users"]), lake.gold("dim_users"))


def touched_days(*events: DataFrame) -> list[date]:
    """Event dates of inserted rows: what an update has to look at. One entry per day."""
    days = events[0].select("event_date")
    for more in events[1:]:
        days = days.unionByName(more.select("event_date"))
    return sorted(r[0] for r in days.distinct().collect() if r[0] is not None)


def units(days: Iterable[date], grain: str) -> list[date]:
    """The partition values that hold ``days``."""
    return sorted({d.replace(day=1) if grain == "month" else d for d in days})


def on_days(column: str, days: Iterable[date], grain: str = "day") -> Column:
    """Whether a row lies in a partition of one of ``days``; one predicate, so that partitions are pruned.

    ``column`` is the date; by months its partition column is asked. Runs of days become ranges.
    """
    values = units(days, grain)
    if not values:
        return F.lit(False)
    name = partition_column(column, grain)
    runs: list[list[date]] = []
    for day in values:
        if runs and day - runs[-1][-1] == timedelta(days=1):
            runs[-1].append(day)
        else:
            runs.append([day])
    single = [f"DATE '{r[0]}'" for r in runs if len(r) == 1]
    parts = [f"`{name}` BETWEEN DATE '{r[0]}' AND DATE '{r[-1]}'" for r in runs if len(r) > 1]
    if single:
        parts.append(f"`{name}` IN ({', '.join(single)})")
    return F.expr(" OR ".join(parts))


def changed_orders(
    order_events: DataFrame,
    payment_events: DataFrame,
    existing: DataFrame,
    payments: DataFrame,
    days: Iterable[date],
    grain: str = "day",
) -> DataFrame:
    """Rows of ``fact_orders`` that events of the touched ``days`` change, with ``old_date``.

    Of the events only the partitions of those days are read. ``payments`` is the whole
    ``fact_payments``; two of its columns are read for orders that are new.
    """
    days = list(days)
    recent = star.fact_payments(payment_events.filter(on_days("event_date", days, grain)))
    orders = order_events.filter(on_days("event_date", days, grain))
    return star.merged_orders(existing, orders, payments, recent, on_days("order_date", days, grain))


def changed_users(user_events: DataFrame, latest: DataFrame, days: Iterable[date], grain: str = "day") -> DataFrame:
    """``latest`` (a row per user with its event) after the events of the touched ``days``."""
    recent = star.latest_users(user_events.filter(on_days("event_date", days, grain)))
    return latest_by(latest.unionByName(recent), ["user_id"], ["event_ts", "event_id"])


def update_gold(spark: SparkSession, days: Iterable[date], lake: Lake = Lake()) -> None:
    """Bring gold forward after inserts that touched the event dates ``days``, late ones or new.

    Silver is read in the partitions of those days only. Their payments replace their
    partitions. Changed orders are found first and kept aside; then the partitions of their
    old and new dates are written, and those left empty are removed. A run that died may be
    run again: it finds what is not yet in place.
    """
    days = list(days)
    if not days:
        return
    payments = fresh(spark, lake.silver("payment_events"))
    recent = star.fact_payments(payments.filter(on_days("event_date", days, lake.grain)))
    overwrite_partitions(lake.dated(recent, "fact_payments"), lake.gold("fact_payments"))  # laid out as in silver

    aside = scratch_path(spark, "changed-orders")
    changed_orders(
        fresh(spark, lake.silver("order_events")),
        payments,
        fresh(spark, lake.gold("fact_orders")),
        fresh(spark, lake.gold("fact_payments")),
        days,
        lake.grain,
    ).write.parquet(aside)
    _replace_orders(spark, spark.read.parquet(aside), lake)

    users = fresh(spark, lake.silver("user_events"))
    _publish_users(spark, changed_users(users, fresh(spark, lake.user_latest), days, lake.grain), lake)


def catch_up_gold(
    spark: SparkSession, lake: Lake = Lake(), as_of: datetime | str | None = None, consumer: str = GOLD_CONSUMER
) -> list[date]:
    """``update_gold`` for all dates that silver runs logged since the last time; returns them.

    Entries are recorded as taken when gold is in place. A run that dies takes none, so the
    next one starts from the same entries, whoever wrote them.
    """
    entries = cut_lineage(untaken(spark, lake, consumer))
    days = touched_days(entries)
    update_gold(spark, days, lake)
    take(spark, lake, consumer, entries, instant(as_of))
    return days


def _replace_orders(spark: SparkSession, changed: DataFrame, lake: Lake) -> None:
    table, part = lake.gold("fact_orders"), lake.partition("fact_orders")
    dates = changed.select(F.explode(F.array("order_date", "old_date")).alias("day")).distinct()
    dates = [r[0] for r in dates.collect() if r[0] is not None]  # days, however many orders
    if not dates:
        return
    there = fresh(spark, table).filter(on_days("order_date", dates, lake.grain))
    kept = there.select(*GOLD["fact_orders"]).join(changed.select("order_id"), "order_id", "left_anti")
    aside = scratch_path(spark, "orders")
    lake.dated(kept.unionByName(changed.drop("old_date")), "fact_orders").write.parquet(aside)
    rows = spark.read.parquet(aside)
    overwrite_partitions(rows, table, part)
    filled = {r[0] for r in rows.select(part).distinct().collect()}
    drop_folders(spark, table, part, [u for u in units(dates, lake.grain) if u not in filled])
