"""The log of touched dates: what gold knows of silver whatever dies in between."""

from datetime import date

import pytest

from conftest import AS_OF, container, event, texts
from siltstone.operators import changes
from siltstone.operators.merge import append, fresh
from siltstone.plans import gold, silver
from siltstone.plans.gold import GOLD_CONSUMER, catch_up_gold, refresh_gold
from siltstone.plans.silver import run_silver_batch
from siltstone.schemas import GOLD, Lake
from siltstone.session import instant


def at(day, n, domain="order_events", **payload):
    made = event(n, domain, event_ts=f"2024-01-{day:02}T10:00:00Z", ingest_ts=f"2024-01-{day:02}T10:00:05Z")
    made["payload"].update(payload)
    return made


FIRST = [
    container([at(1, 1, order_id="a"), at(2, 2, order_id="b")]),
    container([at(1, 3, "user_events", user_id="u1")], n=2, domain="user_events"),
]
SECOND = [
    container([at(9, 4, order_id="a", status="order_paid")], n=3),
    container([at(5, 5, "payment_events", order_id="b")], n=4, domain="payment_events"),
    container([at(7, 6, "user_events", user_id="u1", country="PT")], n=5, domain="user_events"),
]


def contents(spark, lake):
    rows = {t: fresh(spark, lake.gold(t)).select(*GOLD[t]).collect() for t in GOLD}
    return {t: sorted(map(tuple, r), key=repr) for t, r in rows.items()}


def refreshed(spark, lake):
    refresh_gold(spark, lake)
    return contents(spark, lake)


def test_catches_up_after_a_dead_driver(spark, any_lake):
    lake = any_lake
    run_silver_batch(spark, texts(spark, FIRST), lake, AS_OF)
    assert catch_up_gold(spark, lake, AS_OF) == [date(2024, 1, 1), date(2024, 1, 2)]
    assert len(contents(spark, lake)["fact_orders"]) == 2
    run_silver_batch(spark, texts(spark, SECOND[:1]), lake, AS_OF)  # and no gold run after it
    run_silver_batch(spark, texts(spark, SECOND), lake, AS_OF)
    assert catch_up_gold(spark, lake, AS_OF) == [date(2024, 1, d) for d in (5, 7, 9)]
    got = contents(spark, lake)
    assert got == refreshed(spark, lake)
    assert got["fact_orders"] == [
        ("a", "u1", got["fact_orders"][0][2], "USD", "order_paid", False, date(2024, 1, 9)),
        ("b", "u1", got["fact_orders"][1][2], "USD", "order_created", True, date(2024, 1, 2)),
    ]
    assert got["dim_users"] == [("u1", "a@b", "PT")]
    assert catch_up_gold(spark, lake, AS_OF) == []


def test_gold_that_dies_takes_nothing(spark, lake, monkeypatch):
    run_silver_batch(spark, texts(spark, FIRST), lake, AS_OF)
    catch_up_gold(spark, lake, AS_OF)
    run_silver_batch(spark, texts(spark, SECOND), lake, AS_OF)
    with monkeypatch.context() as broken:
        broken.setattr(gold, "_replace_orders", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            catch_up_gold(spark, lake, AS_OF)
    assert len(catch_up_gold(spark, lake, AS_OF)) == 3
    got = contents(spark, lake)
    assert got == refreshed(spark, lake)


def test_run_that_dies_before_the_log_writes_it_when_run_again(spark, lake, monkeypatch):
    with monkeypatch.context() as broken:
        broken.setattr(silver, "log_changes", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_silver_batch(spark, texts(spark, FIRST), lake, AS_OF)
    assert fresh(spark, lake.silver("order_events")).count() == 2
    assert fresh(spark, lake.metrics).count() == 0  # not reported, so the batch comes again
    assert catch_up_gold(spark, lake, AS_OF) == []
    run_silver_batch(spark, texts(spark, FIRST), lake, AS_OF)  # inserts nothing
    assert len(catch_up_gold(spark, lake, AS_OF)) == 2
    assert contents(spark, lake) == refreshed(spark, lake)


def test_entries_written_meanwhile_stay(spark, lake):
    def log(day):
        rows = spark.createDataFrame([("order_events", date(2024, 1, day))], "domain string, event_date date")
        changes.log_changes(spark, lake, rows, instant(AS_OF))

    log(1)
    seen = spark.createDataFrame(changes.untaken(spark, lake, GOLD_CONSUMER).collect())
    log(1)  # the same date, by another run
    changes.take(spark, lake, GOLD_CONSUMER, seen, instant(AS_OF))
    assert changes.untaken(spark, lake, GOLD_CONSUMER).count() == 1
    assert changes.untaken(spark, lake, "other").count() == 2


def test_old_entries_are_forgotten_when_all_have_taken_them(spark, any_lake):
    lake = any_lake
    rows = spark.createDataFrame([("order_events", date(2024, 1, 1))], "domain string, event_date date")
    for day in ("2024-02-01", "2024-03-31", "2024-05-02"):
        changes.log_changes(spark, lake, rows, instant(f"{day}T00:00:00Z"))
    assert changes.forget_changes(spark, lake, "2024-05-01", [GOLD_CONSUMER]) == 0
    old = changes.untaken(spark, lake, GOLD_CONSUMER).filter("log_date < DATE '2024-03-01'")
    changes.take(spark, lake, GOLD_CONSUMER, old, instant(AS_OF))
    assert changes.forget_changes(spark, lake, "2024-05-01", [GOLD_CONSUMER, "other"]) == 0
    assert changes.forget_changes(spark, lake, "2024-05-01", [GOLD_CONSUMER]) == 1
    assert changes.untaken(spark, lake, GOLD_CONSUMER).count() == 2


def test_dates_of_rejected_events_are_not_logged(spark, lake):
    bad = container([at(3, 1), event(2, source=None, event_ts="2024-01-20T00:00:00Z", ingest_ts="2024-01-20T00:00:00Z")])
    run_silver_batch(spark, texts(spark, [bad]), lake, AS_OF)
    assert [r.event_date for r in fresh(spark, lake.changes).collect()] == [date(2024, 1, 3)]


def test_grain(spark):
    with pytest.raises(ValueError, match="grain"):
        Lake(grain="week")
    days = [date(2024, 1, 31), date(2024, 2, 1), date(2024, 2, 2), date(2024, 4, 5)]
    rows = spark.sql("SELECT explode(sequence(DATE '2024-01-01', DATE '2024-05-01')) AS event_date")
    rows = rows.selectExpr("event_date", "trunc(event_date, 'month') AS event_month")
    got = [r.event_date for r in rows.filter(gold.on_days("event_date", days)).collect()]
    assert got == days
    months = rows.filter(gold.on_days("event_date", days, "month")).select("event_month").distinct().collect()
    assert sorted(r.event_month for r in months) == [date(2024, 1, 1), date(2024, 2, 1), date(2024, 4, 1)]
    assert rows.filter(gold.on_days("event_date", [])).count() == 0


def test_months_are_pruned(spark, any_lake):
    table = any_lake.silver("order_events")
    df = spark.table(table).filter(gold.on_days("event_date", [date(2024, 1, 5)], any_lake.grain))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({any_lake.partition('order_events')}" in text


def test_append_needs_the_partition_column(spark, any_lake):
    rows = spark.createDataFrame([("p", "o", date(2024, 3, 9))], "payment_id string, order_id string, payment_date date")
    rows = rows.selectExpr(
        "*", "CAST(1 AS DECIMAL(10,2)) AS payment_amount", "'USD' AS currency", "'payment_success' AS payment_status"
    )
    append(any_lake.dated(rows, "fact_payments"), any_lake.gold("fact_payments"), any_lake.partition("fact_payments"))
    assert [r.payment_date for r in fresh(spark, any_lake.gold("fact_payments")).collect()] == [date(2024, 3, 9)]
