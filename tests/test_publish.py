"""Tables that are replaced at once: readers see the old rows or the new ones."""

import pytest
from pyspark.sql import functions as F

from siltstone.operators.merge import expire_versions, fresh, location, overwrite_partitions, publish
from siltstone.plans import gold
from siltstone.queries import feeds

SF = "/root/testdata/sf0.001"


def payments(spark, amount, days=3):
    return spark.range(30).selectExpr(
        "'p' || id AS payment_id", "'o' || id AS order_id", f"CAST({amount} AS DECIMAL(10,2)) AS payment_amount",
        "'USD' AS currency", "'payment_failed' AS payment_status",
        f"DATE '2024-01-01' + CAST(id % {days} AS INT) AS payment_date",
    )


def amounts(spark, table):
    rows = fresh(spark, table).groupBy("payment_amount").count().collect()
    return {float(r.payment_amount): r["count"] for r in rows}


@pytest.mark.parametrize("partition", ["payment_date"])
def test_a_job_that_dies_midway_leaves_the_old_rows(spark, lake, partition):
    table = lake.gold("fact_payments")
    publish(payments(spark, 1), table, partition)
    assert amounts(spark, table) == {1.0: 30}
    dies = F.when(F.col("payment_id") == "p29", F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("currency"))
    with pytest.raises(Exception, match="lost"):
        publish(payments(spark, 2).withColumn("currency", dies), table, partition)
    assert amounts(spark, table) == {1.0: 30}
    publish(payments(spark, 2), table, partition)
    assert amounts(spark, table) == {2.0: 30}


def test_readers_keep_the_version_they_opened(spark, lake):
    table = lake.gold("fact_payments")
    publish(payments(spark, 1), table, "payment_date")
    opened = fresh(spark, table)
    assert opened.count() == 30
    publish(payments(spark, 2, days=5), table, "payment_date")
    assert opened.filter("payment_amount = 1").count() == 30
    assert amounts(spark, table) == {2.0: 30}


def test_own_rows_may_be_read(spark, lake):
    table = lake.gold("fact_payments")
    publish(payments(spark, 1), table, "payment_date")
    twice = fresh(spark, table)
    publish(twice.withColumn("payment_amount", (F.col("payment_amount") + 1).cast("decimal(10,2)")), table, "payment_date")
    assert amounts(spark, table) == {2.0: 30}
    one_day = fresh(spark, table).filter("payment_date = DATE '2024-01-02'")
    overwrite_partitions(one_day.limit(1), table, "payment_date")
    assert amounts(spark, table) == {2.0: 21}


def test_no_rows(spark, lake):
    table = lake.gold("fact_payments")
    publish(payments(spark, 1), table, "payment_date")
    publish(payments(spark, 1).filter("FALSE"), table, "payment_date")
    assert fresh(spark, table).count() == 0
    publish(fresh(spark, lake.gold("dim_users")), lake.gold("dim_users"))
    assert fresh(spark, lake.gold("dim_users")).count() == 0


def test_old_versions_expire(spark, lake):
    table = lake.gold("fact_payments")
    for amount in (1, 2, 3):
        publish(payments(spark, amount), table, "payment_date")
    assert expire_versions(spark, table) == 0  # none is a week old
    assert expire_versions(spark, table, hours=-1) == 3  # the first folder was the table's own
    assert amounts(spark, table) == {3.0: 30}
    assert "__v_" in location(spark, table)


def test_refresh_that_dies_leaves_whole_tables(spark, lake, monkeypatch):
    from siltstone.operators.merge import append

    rows = feeds.payment_events(spark, SF).filter("event_date < DATE '1995-02-01'")
    append(rows.select(*fresh(spark, lake.silver("payment_events")).columns), lake.silver("payment_events"), "event_date")
    gold.refresh_gold(spark, lake)
    before = fresh(spark, lake.gold("fact_payments")).count()
    bad = feeds.payment_events(spark, SF).filter("event_date >= DATE '1995-02-01' AND event_date < DATE '1995-03-01'")
    append(bad.select(*fresh(spark, lake.silver("payment_events")).columns), lake.silver("payment_events"), "event_date")
    with monkeypatch.context() as broken:
        whole = gold.star.fact_payments
        dies = F.raise_error(F.lit("lost")).cast("string")
        broken.setattr(gold.star, "fact_payments", lambda e: whole(e).withColumn("currency", F.when(F.rand() > 0.9, dies).otherwise("x")))
        with pytest.raises(Exception, match="lost"):
            gold.refresh_gold(spark, lake)
    assert fresh(spark, lake.gold("fact_payments")).count() == before > 0
    gold.refresh_gold(spark, lake)
    assert fresh(spark, lake.gold("fact_payments")).count() > before
