"""Star schema from the silver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.text import utc_day
from siltstone.operators.rank import latest_by
from siltstone.schemas import GOLD, USER_LATEST

# Fixed value: the payment status that counts as paid.
PAID = "payment_success"
_ORDER_REST = [c for c in GOLD["fact_orders"] if c != "order_id"]


def latest_users(user_events: DataFrame) -> DataFrame:
    """Latest attributes per user with the event they come from; ``event_id`` settles equal times."""
    narrow = user_events.select(*USER_LATEST)
    return latest_by(narrow, ["user_id"], ["event_ts", "event_id"])


def dim_users(user_events: DataFrame) -> DataFrame:
    """Latest attributes per user."""
    return latest_users(user_events).select(*GOLD["dim_users"])


def fact_payments(payment_events: DataFrame) -> DataFrame:
    """One row per payment attempt."""
    return payment_events.select(
        "payment_id",
        "order_id",
        F.col("amount").alias("payment_amount"),
        "currency",
        F.col("status").alias("payment_status"),
        utc_day(F.col("event_ts")).alias("payment_date"),
    )


def payment_summary(payments: DataFrame) -> DataFrame:
    """Per order, whether any attempt succeeded."""
    paid = F.coalesce(F.col("payment_status") == PAID, F.lit(False))
    return payments.groupBy("order_id").agg(F.bool_or(paid).alias("is_paid"))


def fact_orders(order_events: DataFrame, payments: DataFrame) -> DataFrame:
    """Latest state per order with its paid flag.

    Both join sides hold one row per order and are already hashed on
    ``order_id``, so the join adds no shuffle and cannot skew.
    """
    narrow = order_events.select(
        "order_id", "user_id", "amount", "currency", "status", "event_ts", "event_id"
    )
    latest = latest_by(narrow, ["order_id"], ["event_ts", "event_id"])
    return latest.join(payment_summary(payments), "order_id", "left").select(
        "order_id",
        "user_id",
        F.col("amount").alias("order_amount"),
        "currency",
        F.col("status").alias("order_status"),
        F.coalesce("is_paid", F.lit(False)).alias("is_paid_flag"),
        utc_day(F.col("event_ts")).alias("order_date"),
    )


def merged_orders(
    existing: DataFrame, order_events: DataFrame, payments: DataFrame, touched: DataFrame, on_days: Column
) -> DataFrame:
    """What touched days change in ``fact_orders``: new rows, each with ``old_date``.

    ``order_events`` and ``touched`` payments are those of the touched days, ``on_days`` says
    whether an existing row's date is one of them. Such a row's event is among the events
    read, so the best of them replaces it; any other row competes by its date, which cannot
    be equal. An order's flag holds on; one new to the table looks up all ``payments``.
    """
    old = existing.select(
        "order_id", *(F.col(c).alias(f"old_{c}") for c in _ORDER_REST), on_days.alias("on_days")
    )
    found = latest_by(
        order_events.select(
            "order_id", "user_id", "amount", "currency", "status", "event_ts", "event_id"
        ),
        ["order_id"],
        ["event_ts", "event_id"],
    ).select(
        "order_id",
        "user_id",
        F.col("amount").alias("order_amount"),
        "currency",
        F.col("status").alias("order_status"),
        utc_day(F.col("event_ts")).alias("order_date"),
        F.lit(True).alias("found"),
    )
    fresh_paid = payment_summary(touched).filter("is_paid")
    both = found.join(old, "order_id", "full").join(fresh_paid, "order_id", "left")
    new = both.filter("found AND old_order_date IS NULL").select("order_id")
    earlier = payments.filter(F.col("payment_status") == PAID).join(new, "order_id", "left_semi")
    earlier = earlier.groupBy("order_id").agg(F.lit(True).alias("was_paid"))
    # a row left behind by a run that died stands beside its successor: the later date counts
    both = latest_by(both, ["order_id"], ["old_order_date"])
    wins = F.col("found") & (
        F.col("old_order_date").isNull() | F.col("on_days") | (F.col("order_date") > F.col("old_order_date"))
    )
    wins = F.coalesce(wins, F.lit(False))
    paid = F.coalesce("old_is_paid_flag", F.lit(False)) | F.coalesce("is_paid", "was_paid", F.lit(False))
    picked = [
        (paid if c == "is_paid_flag" else F.when(wins, F.col(c)).otherwise(F.col(f"old_{c}"))).alias(c)
        for c in _ORDER_REST
    ]
    rows = both.join(earlier, "order_id", "left").select(
        "order_id", *picked, *(F.col(f"old_{c}") for c in _ORDER_REST)
    )
    same = F.lit(True)
    for c in _ORDER_REST:
        same = same & F.col(c).eqNullSafe(F.col(f"old_{c}"))
    kept = rows.filter(F.col("order_date").isNotNull() & ~same)
    return kept.select("order_id", *_ORDER_REST, F.col("old_order_date").alias("old_date"))
