from datetime import date

import pytest

from siltstone.operators import star
from siltstone.operators.merge import append
from siltstone.plans import gold
from siltstone.plans.gold import refresh_gold, touched_days, update_gold
from siltstone.queries import feeds
from siltstone.schemas import GOLD, PARTITION, SILVER


def orders(spark, rows):
    """(event_id, order_id, event_ts, status, amount)"""
    df = spark.createDataFrame(rows, "event_id string, order_id string, t string, status string, amount double")
    return df.selectExpr(
        "event_id", "order_id", "CAST(t AS TIMESTAMP) AS event_ts", "CAST(t AS DATE) AS event_date",
        "status", "CAST(amount AS DECIMAL(10,2)) AS amount", "'u' AS user_id", "'USD' AS currency",
    )


def payments(spark, rows):
    """(order_id, status)"""
    df = spark.createDataFrame(rows, "order_id string, status string")
    return df.selectExpr(
        "'p' AS payment_id", "order_id", "status", "CAST(1 AS DECIMAL(10,2)) AS amount",
        "'USD' AS currency", "TIMESTAMP '2024-01-05 00:00:00' AS event_ts",
    )


def test_fact_orders(spark):
    events = orders(
        spark,
        [
            ("1", "none", "2024-01-01 00:00:00", "order_created", 1.0),
            ("2", "failed", "2024-01-01 00:00:00", "order_created", 2.0),
            ("3", "paid", "2024-01-01 00:00:00", "order_created", 3.0),
            ("4", "paid", "2024-01-02 00:00:00", "order_paid", 4.0),
            ("5", "tie", "2024-01-01 00:00:00", "order_created", 5.0),
            ("6", "tie", "2024-01-01 00:00:00", "order_paid", 6.0),
            ("7", "odd", "2024-01-01 00:00:00", "order_created", 7.0),
        ],
    )
    paid = payments(
        spark,
        [
            ("failed", "payment_failed"), ("paid", "payment_failed"), ("paid", "payment_success"),
            ("tie", "payment_inprogress"), ("odd", None), ("unknown", "payment_success"),
        ],
    )
    rows = star.fact_orders(events, star.fact_payments(paid)).collect()
    got = {r.order_id: (r.order_status, float(r.order_amount), r.is_paid_flag) for r in rows}
    assert got == {
        "none": ("order_created", 1.0, False),
        "failed": ("order_created", 2.0, False),
        "paid": ("order_paid", 4.0, True),
        "tie": ("order_paid", 6.0, False),
        "odd": ("order_created", 7.0, False),
    }
    assert str(next(r.order_date for r in rows if r.order_id == "paid")) == "2024-01-02"


def test_columns(spark):
    sf = "/root/testdata/sf0.001"
    assert set(star.dim_users(feeds.user_events(spark, sf)).columns) == set(GOLD["dim_users"])
    paid = star.fact_payments(feeds.payment_events(spark, sf))
    assert set(paid.columns) == set(GOLD["fact_payments"])


# Some months of orders; the registered queries take all days.
SPAN = "event_date < DATE '1995-05-01' OR event_date >= DATE '2023-01-01'"


@pytest.fixture
def loaded(spark, lake):
    sf = "/root/testdata/sf0.001"

    def load(keep):
        frames = []
        for domain in SILVER:
            rows = getattr(feeds, domain)(spark, sf).filter(f"({SPAN}) AND ({keep})").select(*SILVER[domain])
            append(rows, lake.silver(domain), PARTITION[domain])
            frames.append(rows)
        return touched_days(*frames)

    return load


def contents(spark, lake):
    spark.catalog.refreshTable(lake.gold("fact_orders"))
    return {t: sorted(map(tuple, spark.table(lake.gold(t)).collect()), key=repr) for t in GOLD}


LATE = "pmod(xxhash64(event_id), 3) = 0"


@pytest.mark.parametrize("first, then", [
    ("event_date < DATE '1995-03-15'", "event_date >= DATE '1995-03-15'"),
    (f"NOT {LATE}", LATE),
])
def test_update_equals_refresh(spark, lake, loaded, first, then):
    loaded(first)
    refresh_gold(spark, lake)
    before = contents(spark, lake)
    days = loaded(then)
    update_gold(spark, days, lake)
    updated = contents(spark, lake)
    update_gold(spark, days, lake)  # once more changes nothing
    assert updated == contents(spark, lake)
    refresh_gold(spark, lake)
    assert updated == contents(spark, lake)
    assert updated != before
    assert all(updated.values())


def small_lake(spark, lake, rows, paid):
    full = orders(spark, rows).selectExpr(
        "*", "'f' AS file_id", "'order_events' AS domain", "'w' AS source_system", "event_ts AS created_at",
        "'order_events' AS event_type", "'app' AS source", "event_ts AS ingest_ts",
    )
    append(full.select(*SILVER["order_events"]), lake.silver("order_events"), "event_date")
    pays = payments(spark, [(o, s) for o, s, _ in paid]).selectExpr("* EXCEPT (event_ts)")
    times = spark.createDataFrame([(o, t) for o, _, t in paid], "o string, t string")
    pays = pays.join(times, pays.order_id == times.o).selectExpr(
        "*", "CAST(t AS TIMESTAMP) AS event_ts", "CAST(t AS DATE) AS event_date", "'f' AS file_id",
        "'payment_events' AS domain", "'w' AS source_system", "CAST(t AS TIMESTAMP) AS created_at",
        "concat(order_id, t) AS event_id", "'payment_events' AS event_type", "'app' AS source",
        "CAST(t AS TIMESTAMP) AS ingest_ts",
    )
    append(pays.select(*SILVER["payment_events"]), lake.silver("payment_events"), "event_date")
    return touched_days(full, pays)


def orders_now(spark, lake):
    spark.catalog.refreshTable(lake.gold("fact_orders"))
    rows = spark.table(lake.gold("fact_orders")).collect()
    return sorted((r.order_id, r.order_status, r.is_paid_flag, str(r.order_date)) for r in rows)


def test_moves_late_events_and_early_payments(spark, lake):
    days = small_lake(
        spark, lake,
        [("a1", "a", "2024-01-01 10:00:00", "order_created", 1.0), ("b1", "b", "2024-01-03 10:00:00", "order_created", 1.0)],
        [("c", "payment_success", "2024-01-02 00:00:00")],
    )
    refresh_gold(spark, lake)
    assert len(days) == 3
    days = small_lake(
        spark, lake,
        [
            ("a2", "a", "2024-01-05 10:00:00", "order_paid", 1.0),  # moves and leaves its old day empty
            ("b0", "b", "2024-01-02 10:00:00", "late", 1.0),  # older than the row in gold
            ("c1", "c", "2024-01-04 10:00:00", "order_created", 1.0),  # paid before it was seen
        ],
        [("b", "payment_success", "2024-01-06 00:00:00")],
    )
    update_gold(spark, days, lake)
    want = [
        ("a", "order_paid", False, "2024-01-05"),
        ("b", "order_created", True, "2024-01-03"),
        ("c", "order_created", True, "2024-01-04"),
    ]
    assert orders_now(spark, lake) == want
    update_gold(spark, [], lake)
    assert orders_now(spark, lake) == want


def test_payments_are_written_where_they_are_read(spark, lake, monkeypatch):
    seen = {}

    def stop(df, table, *rest, **options):
        seen["layout"] = (*rest, *options.values())
        raise InterruptedError

    real = gold.publish
    monkeypatch.setattr(gold, "publish", lambda df, table, *r, **o: (stop if "fact_payments" in table else real)(df, table, *r, **o))
    with pytest.raises(InterruptedError):
        refresh_gold(spark, lake)
    assert seen["layout"][-1] is True
    monkeypatch.setattr(gold, "overwrite_partitions", stop)
    with pytest.raises(InterruptedError):
        update_gold(spark, [date(2024, 1, 1)], lake)
    assert seen["layout"] == ()
