import json

import pytest

from conftest import AS_OF, container, event, silver_rows, table_rows, texts
from siltstone.operators import validation as V
from siltstone.operators import ledger as L
from siltstone.plans.intake import run_intake
from siltstone.operators.validation import accepted, check_files
from siltstone.plans.silver import drain_pending, run_pending, run_silver_batch
from siltstone.schemas import Lake, create_tables
from siltstone.session import instant, scratch_path

DOCUMENTS = [
    container([event(1), event(2, source=None), event(3)]),
    container([event(1, ingest_ts="2024-01-01T10:00:09+00:00"), event(4)], n=2),
    container([event(5, "user_events")], n=3, domain="user_events"),
    container([event(6, "payment_events")], n=4, domain="payment_events"),
    container([], n=5),
]


def ids(spark, lake, domain="order_events"):
    return sorted(r.event_id for r in silver_rows(spark, lake, domain))


@pytest.mark.parametrize("hold", ["cache", "table"])
def test_batch_and_rerun(spark, lake, hold):
    batch = texts(spark, DOCUMENTS)
    metrics = run_silver_batch(spark, batch, lake, AS_OF, hold=hold)
    assert {r.etag: r.file_status for r in metrics.collect()} == {
        "t0": "PARTIAL_SUCCESS(SILVER)", "t1": "SUCCESS(SILVER)", "t2": "SUCCESS(SILVER)",
        "t3": "SUCCESS(SILVER)", "t4": "FAILED(SILVER)",
    }
    assert ids(spark, lake) == ["e1", "e3", "e4"]
    assert ids(spark, lake, "user_events") == ["e5"]
    assert ids(spark, lake, "payment_events") == ["e6"]
    first = next(r for r in silver_rows(spark, lake, "order_events") if r.event_id == "e1")
    assert first.file_id == "f1"  # the earlier ingest of two copies
    assert len(table_rows(spark, lake.rejected)) == 2

    run_silver_batch(spark, batch, lake, AS_OF, hold=hold)
    assert ids(spark, lake) == ["e1", "e3", "e4"]
    assert len(table_rows(spark, lake.rejected)) == 4  # audit rows are appended each time
    metric_rows = len(table_rows(spark, lake.metrics))
    run_silver_batch(spark, batch, lake, AS_OF, hold=hold, once_per_file=True)
    assert len(table_rows(spark, lake.rejected)) == 4
    assert len(table_rows(spark, lake.metrics)) == metric_rows


def test_rejections_lost_in_a_commit_are_added(spark, lake):
    from siltstone.operators.merge import append

    batch = texts(spark, [container([event(1, source=None), event(1, source=None), event(3, source=None)])])
    whole = Lake(prefix=lake.prefix + "w_")
    create_tables(spark, whole, location=scratch_path(spark, "lake"))
    run_silver_batch(spark, batch, whole, AS_OF)
    stored = spark.table(whole.rejected)
    part = stored.filter("event_id = 'e1'").limit(1)
    append(part, lake.rejected, "rejection_date")
    for _ in range(2):
        run_silver_batch(spark, batch, lake, AS_OF, once_per_file=True)
        assert sorted(r.event_id for r in table_rows(spark, lake.rejected)) == ["e1", "e1", "e3"]


def test_delivered_twice_counts_once(spark, lake):
    files = raw_files(spark, [("order_1.json", container([event(1), event(2, source=None)]))] * 2)
    assert run_intake(spark, files, lake, AS_OF).count() == 1
    assert len(table_rows(spark, lake.routed)) == 1
    metrics = run_pending(spark, "run-1", lake, AS_OF).collect()
    assert [m.total_events for m in metrics] == [2]
    assert len(table_rows(spark, lake.rejected)) == 1


def test_days_do_not_depend_on_the_sessions_zone(spark, lake):
    batch = texts(spark, [
        container([event(1, event_ts="2024-01-01T02:00:00Z", ingest_ts="2024-01-01T02:00:01Z"),
                   event(2, event_ts="2024-01-01T23:30:00", ingest_ts="2024-01-01T23:30:01"),
                   event(3, event_ts="2024-01-02", ingest_ts="2024-01-02 00:00:01+00:00")]),
    ])
    before = spark.conf.get("spark.sql.session.timeZone")
    for zone in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            rows = accepted(check_files(batch, instant("2024-01-02T00:00:02Z")), "order_events").collect()
        finally:
            spark.conf.set("spark.sql.session.timeZone", before)
        days = sorted((r.event_id, str(r.event_date)) for r in rows)
        assert days == [("e1", "2024-01-01"), ("e2", "2024-01-01"), ("e3", "2024-01-02")], zone


def test_drain(spark, lake):
    files = [(f"order_{i:02}.json", container([event(i)], n=i)) for i in range(7)]
    run_intake(spark, raw_files(spark, files), lake, AS_OF)
    assert drain_pending(spark, "run", lake, limit=3, as_of=AS_OF) == 3
    assert len(ids(spark, lake)) == 7
    assert drain_pending(spark, "run", lake, limit=3, as_of=AS_OF) == 0


def test_later_batch_adds_only_new_events(spark, lake):
    run_silver_batch(spark, texts(spark, [container([event(1)])]), lake, AS_OF)
    run_silver_batch(spark, texts(spark, [container([event(1), event(2)], n=9)]), lake, AS_OF)
    assert ids(spark, lake) == ["e1", "e2"]


def test_stable_dates(spark, lake):
    batch = texts(spark, DOCUMENTS)
    for _ in range(2):
        run_silver_batch(spark, batch, lake, AS_OF, stable_dates=True)
    assert ids(spark, lake) == ["e1", "e3", "e4"]


def test_unexpected_field_stops_before_any_write(spark, lake):
    bad = event(1)
    bad["payload"]["extra"] = 1
    with pytest.raises(Exception, match="extra"):
        run_silver_batch(spark, texts(spark, [container([bad])]), lake, AS_OF)
    assert ids(spark, lake) == [] and table_rows(spark, lake.rejected) == []
    with pytest.raises(ValueError):
        run_silver_batch(spark, texts(spark, []), lake, AS_OF, hold="memory")


def raw_files(spark, documents):
    rows = [
        (f"s3://b/raw/{name}", d if isinstance(d, str) else json.dumps(d)) for name, d in documents
    ]
    return spark.createDataFrame(rows, "file_path string, value string")


def states(spark, lake):
    spark.catalog.refreshTable(lake.ledger)
    return {
        r.file_path.split("/")[-1]: (r.status, r.run_id)
        for r in L.current(spark.table(lake.ledger)).collect()
    }


def test_intake_to_silver(spark, lake):
    good = container([event(1)])
    files = raw_files(
        spark,
        [
            ("order_1.json", good),
            ("order_2.json", good),  # same content, second name
            ("order_3.json", '{"cut'),
            ("other_4.json", container([event(2)], n=2)),
        ],
    )
    passed = run_intake(spark, files, lake, AS_OF).collect()
    assert [r.file_path for r in passed] == ["s3://b/raw/order_1.json"]
    assert states(spark, lake) == {
        "order_1.json": ("VALIDATED", None),
        "order_3.json": ("REJECTED", None),
        "other_4.json": ("REJECTED", None),
    }
    assert {r.route for r in table_rows(spark, lake.routed)} == {"order_events", "rejected", "unrouted"}

    assert run_intake(spark, files, lake, AS_OF).collect() == []
    assert len(table_rows(spark, lake.routed)) == 3

    run_pending(spark, "run-1", lake, AS_OF)
    assert states(spark, lake)["order_1.json"] == ("SUCCESS(SILVER)", "run-1")
    assert ids(spark, lake) == ["e1"]
    assert run_pending(spark, "run-2", lake, AS_OF).collect() == []


def test_dead_claim_is_taken_over_after_its_lease(spark, lake):
    from siltstone.operators.merge import append
    from siltstone.session import instant

    files = raw_files(spark, [("order_1.json", container([event(1)]))])
    etag = files.selectExpr("md5(value) AS etag", "file_path")
    append(L.claim(etag, spark.table(lake.ledger), instant(AS_OF)), lake.ledger)
    assert run_intake(spark, files, lake, AS_OF).collect() == []
    assert len(run_intake(spark, files, lake, "2024-06-01T00:01:00+00:00").collect()) == 1
    assert states(spark, lake)["order_1.json"][0] == "VALIDATED"


def test_failed_batch_waits_again(spark, lake):
    bad = event(1)
    bad["payload"]["extra"] = 1
    run_intake(spark, raw_files(spark, [("order_1.json", container([bad]))]), lake, AS_OF)
    with pytest.raises(Exception, match="extra"):
        run_pending(spark, "run-1", lake, AS_OF)
    assert states(spark, lake)["order_1.json"] == ("VALIDATED", None)
    run_pending(spark, "run-2", lake, AS_OF, on_unexpected="reject")
    assert states(spark, lake)["order_1.json"] == ("FAILED(SILVER)", "run-2")


def test_batch_size(spark, lake):
    files = [(f"order_{i:02}.json", container([event(i)], n=i)) for i in range(12)]
    run_intake(spark, raw_files(spark, files), lake, AS_OF)
    assert run_pending(spark, "run-1", lake, AS_OF, limit=10).count() == 10
    assert run_pending(spark, "run-2", lake, AS_OF, limit=10).count() == 2
    assert len(ids(spark, lake)) == 12


LATER = "2024-06-01T01:00:00+00:00"


def started(spark, lake, run_id, as_of=AS_OF, **options):
    from siltstone.operators.merge import append

    log = spark.table(lake.ledger)
    rows = L.start_silver(log, L.pending(log, None, instant(as_of)), run_id, instant(as_of), **options)
    append(spark.createDataFrame(rows.collect(), rows.schema), lake.ledger)


def test_dead_silver_run_is_taken_over_after_its_lease(spark, lake):
    good = container([event(1), event(2, source=None)])
    run_intake(spark, raw_files(spark, [("order_1.json", good)]), lake, AS_OF)
    started(spark, lake, "dead")
    run_silver_batch(spark, spark.table(lake.routed), lake, AS_OF)  # it got as far as this
    assert run_pending(spark, "early", lake, "2024-06-01T00:59:59+00:00").collect() == []
    assert states(spark, lake)["order_1.json"] == ("IN_PROGRESS(SILVER)", "dead")
    assert drain_pending(spark, "next", lake, as_of=LATER) == 1
    row = L.current(spark.table(lake.ledger)).first()
    assert (row.status, row.run_id, row.retry_count) == ("PARTIAL_SUCCESS(SILVER)", "next-0", 1)
    assert ids(spark, lake) == ["e1"]
    assert len(table_rows(spark, lake.rejected)) == len(table_rows(spark, lake.metrics)) == 1


def test_late_report_of_a_run_that_lost_its_files_does_not_count(spark, lake):
    from siltstone.plans.silver import finish_silver

    run_intake(spark, raw_files(spark, [("order_1.json", container([event(1)]))]), lake, AS_OF)
    started(spark, lake, "slow")
    started(spark, lake, "second", LATER)
    etag = table_rows(spark, lake.routed)[0].etag
    late = spark.createDataFrame([(etag, "FAILED(SILVER)", "slow")], "etag string, status string, run_id string")
    finish_silver(spark, late, "slow", lake, LATER)
    assert states(spark, lake)["order_1.json"] == ("IN_PROGRESS(SILVER)", "second")
    done = spark.createDataFrame([(etag, "SUCCESS(SILVER)", "second")], "etag string, status string, run_id string")
    finish_silver(spark, done, "second", lake, LATER)
    assert states(spark, lake)["order_1.json"] == ("SUCCESS(SILVER)", "second")


def test_two_runs_that_start_at_once_share_no_file(spark, lake):
    from siltstone.operators.merge import append

    run_intake(spark, raw_files(spark, [(f"order_{i}.json", container([event(i)], n=i)) for i in range(3)]), lake, AS_OF)
    log = spark.table(lake.ledger)
    batch = L.pending(log, None)
    frames = [L.start_silver(log, batch, run, instant(AS_OF)) for run in ("r1", "r2")]
    rows = [r for frame in frames for r in frame.collect()]
    append(spark.createDataFrame(rows, frames[0].schema), lake.ledger)
    log = spark.table(lake.ledger)
    batch = log.select("etag").distinct()
    mine = [{r.etag for r in L.held(log, batch, run).collect()} for run in ("r1", "r2")]
    assert not mine[0] & mine[1] and len(mine[0] | mine[1]) == 3


def test_lease_length(spark, lake):
    run_intake(spark, raw_files(spark, [("order_1.json", container([event(1)]))]), lake, AS_OF)
    started(spark, lake, "dead", lease_seconds=60)
    assert run_pending(spark, "soon", lake, "2024-06-01T00:01:00+00:00").count() == 1


def test_fields_are_read_as_the_payloads_json(spark):
    odd = ["1", "-0.001", "100.0", "1e2", "12345678901234567890.123", "123456789012345678901234567890", "true", "null",
           '"1E+2"', '" 5 "', '"a\\u00e9\\n\\"b\\ud83d"', '"{}"', "{}", '{"b": 1.0, "a": [1, 2.50]}', "[1e2, null]",
           "0.12499999999999999999", "99999999.994999999999999"]
    names = ("order_id", "user_id", "amount", "currency", "status")
    payloads = ["{" + ",".join(f'"{n}": {v}' for n in names) + "}" for v in odd]
    rows = [(v, f'{{"events": [{{"payload": {p}}}]}}') for v, p in zip(odd, payloads)]
    files = spark.createDataFrame(rows, "etag string, value string")
    events = V.parse_containers(files).selectExpr("etag", "explode(events) AS event", "'order_events' AS event_type")
    events = events.selectExpr("*", "event.payload AS payload", "from_json(to_json(event.payload), 'map<string,string>') AS was")
    read = V.read_payload(events)
    for r in read.collect():
        assert [r[n] for n in names if n != "amount"] == [r.was[n] for n in names if n != "amount"], r.etag
    money = read.selectExpr("etag", "amount", "CASE WHEN try_cast(was['amount'] AS double) >= 0 "
                            "THEN try_cast(was['amount'] AS decimal(10,2)) END AS want")  # fmt: skip
    assert all(r.amount == r.want for r in money.collect())
