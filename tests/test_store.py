"""The routed store by day of arrival."""

import json

import pytest
from conftest import container, event, table_rows
from pyspark.sql import functions as F

from siltstone.operators import ledger as L
from siltstone.operators.ledger_store import ledger_log
from siltstone.plans.intake import run_intake
from siltstone.plans.silver import run_pending
from siltstone.plans.store import stored_texts
from siltstone.schemas import Lake, create_tables
from siltstone.session import scratch_path

DAYS = ("2024-05-30T23:59:59Z", "2024-05-31T00:00:00Z", "2024-06-01T12:00:00Z")


def files(spark, *numbers):
    rows = [
        (f"s3://lake/raw/order_{n}.json", f"t{n}", json.dumps(container([event(n)], n))) for n in numbers
    ]
    return spark.createDataFrame(rows, "file_path string, etag string, value string")


def waiting(spark, lake, *etags):
    wanted = F.col("etag").isin(*etags)
    held = L.current(ledger_log(spark, lake)).filter(wanted)
    return held.select("etag", F.to_date("created_at").alias("arrival_date"))


def folders(df):
    return {part for path in df.inputFiles() for part in path.split("/") if part.startswith("arrival_")}


def test_day_is_that_of_the_first_claim(spark, lake):
    for n, now in enumerate(DAYS):
        run_intake(spark, files(spark, n), lake, now)
    run_intake(spark, files(spark, 0, 1, 2), lake, "2024-06-02T00:00:00Z")
    got = {(r.etag, str(r.arrival_date), r.route) for r in table_rows(spark, lake.routed)}
    assert got == {
        ("t0", "2024-05-30", "order_events"), ("t1", "2024-05-31", "order_events"), ("t2", "2024-06-01", "order_events"),
    }


def test_only_folders_of_the_batch_are_read(spark, lake):
    for n, now in enumerate(DAYS):
        run_intake(spark, files(spark, n, 10 + n), lake, now)
    texts = stored_texts(spark, lake, waiting(spark, lake, "t1", "t11"))
    assert {r.etag for r in texts.collect()} == {"t1", "t11"}
    assert folders(texts) == {"arrival_date=2024-05-31"}
    plan = texts._jdf.queryExecution().executedPlan().toString()
    assert "arrival_date" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]


def test_by_months(spark):
    path = scratch_path(spark, "lake")
    lake = Lake(prefix=f"m{path[-10:]}_", grain="month")
    create_tables(spark, lake, location=path)
    for n, now in enumerate(DAYS):
        run_intake(spark, files(spark, n), lake, now)
    texts = stored_texts(spark, lake, waiting(spark, lake, "t2"))
    assert [r.etag for r in texts.collect()] == ["t2"] and folders(texts) == {"arrival_month=2024-06-01"}
    assert run_pending(spark, "r", lake, "2024-06-02T00:00:00Z", limit=None).count() == 3


def test_reclaimed_file_keeps_its_day(spark, lake):
    """A run dies after it stored the text; the next one claims the file on another day."""
    from siltstone.plans import intake

    record, calls = intake.record, []

    def dies_second(*args):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("driver gone")
        record(*args)

    intake.record = dies_second
    try:
        with pytest.raises(RuntimeError):
            run_intake(spark, files(spark, 1), lake, DAYS[0])
    finally:
        intake.record = record
    run_intake(spark, files(spark, 1), lake, DAYS[2])
    assert [str(r.arrival_date) for r in table_rows(spark, lake.routed)] == ["2024-05-30"]
    assert run_pending(spark, "r", lake, DAYS[2]).count() == 1


def test_text_under_another_day_is_found(spark, lake):
    run_intake(spark, files(spark, 1), lake, DAYS[0])
    run_intake(spark, files(spark, 2), lake, DAYS[2])
    elsewhere = spark.createDataFrame([("t1", "2024-06-01"), ("t2", "2024-06-01")], "etag string, day string")
    wanted = elsewhere.select("etag", F.col("day").cast("date").alias("arrival_date"))
    assert sorted(r.etag for r in stored_texts(spark, lake, wanted).collect()) == ["t1", "t2"]
    undated = wanted.select("etag", F.lit(None).cast("date").alias("arrival_date"))
    assert sorted(r.etag for r in stored_texts(spark, lake, undated).collect()) == ["t1", "t2"]
    assert stored_texts(spark, lake, wanted.limit(0)).count() == 0


def test_empty_texts(spark, lake):
    run_intake(spark, files(spark, 1).limit(0), lake, DAYS[0])
    assert table_rows(spark, lake.routed) == []
