"""The folded ledger says what the whole log says."""

import random
import re
from datetime import date, datetime, timedelta, timezone

import pytest

from conftest import AS_OF
from siltstone.operators import ledger as L
from siltstone.operators.ledger_store import fold, folded_to, ledger_log, record
from siltstone.operators.merge import fresh
from siltstone.schemas import LEDGER, Lake, create_tables, ddl
from siltstone.session import instant, scratch_path
from test_plans import plan

STATES = [L.IN_PROGRESS, L.VALIDATED, L.REJECTED, L.IN_SILVER, "SUCCESS(SILVER)"]


@pytest.fixture(params=["day", "month"])
def dated_lake(spark, request):
    path = scratch_path(spark, "lake")
    lake = Lake(prefix=f"l{path[-12:]}_", grain=request.param)
    create_tables(spark, lake, location=path)
    return lake


def entry(etag, status, seq, day):
    time = datetime(2024, 1, 1, 12, tzinfo=timezone.utc) + timedelta(days=day)
    return (etag, f"p/{etag}", status, 0, time, time, 0, None, seq)


def add(spark, lake, rows):
    record(spark, lake, spark.createDataFrame(rows, ddl(LEDGER)))


def state(df):
    return sorted(map(tuple, L.current(df).select(*LEDGER).collect()))


def names(df):
    return sorted(r.etag for r in df.collect())


def test_folded_log_is_the_whole_log(spark, dated_lake):
    lake, rng, seq = dated_lake, random.Random(5), {}
    for step in range(3):
        rows = []
        for _ in range(30):
            etag = f"t{rng.randrange(12)}"
            seq[etag] = seq.get(etag, 0) + 1
            # also days that a fold has passed already: a run whose clock is behind
            rows.append(entry(etag, rng.choice(STATES), seq[etag], rng.randrange(90)))
        add(spark, lake, rows)
        fold(spark, lake, date(2024, 1, 1) + timedelta(days=35 * (step + 1)))
        whole, folded = fresh(spark, lake.ledger), ledger_log(spark, lake)
        assert state(whole) == state(folded)
        late = instant("2030-01-01T00:00:00Z")
        for as_of in (None, late):
            offered = L.pending(ledger_log(spark, lake, waiting=True), None, as_of)
            assert names(offered) == names(L.pending(whole, None, as_of))
    assert whole.count() == 90 and folded.count() < 90


def test_days_in_the_snapshot_are_not_read(spark, dated_lake):
    lake = dated_lake
    assert folded_to(spark, lake) is None and ledger_log(spark, lake).count() == 0
    add(spark, lake, [entry("old", L.VALIDATED, 1, 0), entry("done", L.REJECTED, 1, 0), entry("new", L.VALIDATED, 1, 70)])
    assert fold(spark, lake, date(2024, 2, 1)) and folded_to(spark, lake) == date(2024, 2, 1)
    column = lake.partition("file_ledger")
    assert re.search(rf"PartitionFilters: \[[^\]]*{column}#\d+ >= ", plan(ledger_log(spark, lake)))
    assert names(ledger_log(spark, lake, waiting=True)) == ["new", "old"]
    # the folded day's log is not needed any more
    spark.sql(f"ALTER TABLE {lake.ledger} DROP PARTITION ({column} = DATE '2024-01-01')")
    assert names(L.current(ledger_log(spark, lake))) == ["done", "new", "old"]
    assert not fold(spark, lake, date(2024, 2, 1)) and not fold(spark, lake, date(2024, 1, 15))


def test_rows_without_a_day_stay_in_the_log(spark, dated_lake):
    lake = dated_lake
    rows = spark.createDataFrame([entry("t", L.VALIDATED, 1, 0)[:5] + (None, 0, None, 1)], ddl(LEDGER))
    record(spark, lake, rows)
    add(spark, lake, [entry("u", L.VALIDATED, 1, 0)])
    fold(spark, lake, date(2024, 3, 1))
    assert names(ledger_log(spark, lake)) == ["t", "u"]
    add(spark, lake, [entry("t", L.REJECTED, 2, 0)])  # before the fold's day
    fold(spark, lake, date(2024, 4, 1))
    assert state(fresh(spark, lake.ledger)) == state(ledger_log(spark, lake))
    assert names(L.pending(ledger_log(spark, lake, waiting=True), None, instant(AS_OF))) == ["u"]
