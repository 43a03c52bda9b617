"""One case per rejection code, and what the raw JSON holds."""

import json

import pytest

from conftest import AS_OF, DROP, container, event, texts
from siltstone.operators import validation as V
from siltstone.operators.metrics import file_metrics
from siltstone.session import instant


def judge(spark, documents, on_unexpected="reject"):
    return V.check_files(texts(spark, documents), instant(AS_OF), on_unexpected)


def reasons(spark, documents):
    return [r.reason for r in judge(spark, documents).orderBy("etag", "event_id").collect()]


GOOD = [event()]


def payload(domain="order_events", **over):
    body = dict(event(domain=domain)["payload"])
    body.update(over)
    return {k: v for k, v in body.items() if v is not DROP}


CASES = {
    "good order": (container(GOOD), None),
    "no file id": (container(GOOD, file_id=None), "MISSING_FILE_ID"),
    "no domain": (container(GOOD, domain=None), "MISSING_DOMAIN"),
    "no source system": (container(GOOD, source_system=DROP), "MISSING_SOURCE_SYSTEM"),
    "no creation time": (container(GOOD, created_at=None), "MISSING_CREATION_TIME"),
    "bad creation time": (container(GOOD, created_at="yesterday"), "MISSING_CREATION_TIME"),
    "null events": (container(None), "EMPTY_EVENTS"),
    "empty events": (container([]), "EMPTY_EVENTS"),
    "events no list": (container("text"), "EMPTY_EVENTS"),
    "two container codes": (container([], file_id=None), "MISSING_FILE_ID,EMPTY_EVENTS"),
    "no event id": (container([event(event_id=None)]), "MISSING_EVENT_ID"),
    "no event type": (container([event(event_type=DROP)]), "MISSING_EVENT_TYPE"),
    "no event time": (container([event(event_ts=None)]), "MISSING_EVENT_TIMESTAMP"),
    "bad event time": (container([event(event_ts="noon")]), "MISSING_EVENT_TIMESTAMP"),
    "time without date": (container([event(event_ts="12:30")]), "MISSING_EVENT_TIMESTAMP"),
    "no source": (container([event(source=None)]), "MISSING_SOURCE"),
    "no ingest time": (container([event(ingest_ts=None)]), "MISSING_INGEST_TIMESTAMP"),
    "ingest first": (
        container([event(ingest_ts="2024-01-01T09:59:59+00:00")]),
        "INGEST BEFORE EVENT_TIMESTAMP",
    ),
    "ingest in another zone": (container([event(ingest_ts="2024-01-01T12:00:05+02:00")]), None),
    "future": (
        container([event(event_ts="2024-07-01T00:00:00Z", ingest_ts="2024-07-02T00:00:00Z")]),
        "EVENT_TIMESTAMP_IN_FUTURE",
    ),
    "two envelope codes": (
        container([event(event_id=None, source=None)]),
        "MISSING_EVENT_ID,MISSING_SOURCE",
    ),
    "mismatch": (container([event(event_type="user_events")]), "DOMAIN_EVENT_TYPE_MISMATCH"),
    "unknown type": (
        container([event(domain="foo_events")], domain="foo_events"),
        "INVALID_EVENT_TYPE",
    ),
    "payload null": (container([event(payload=None)]), "PAYLOAD_IS_NULL"),
    "payload absent": (container([event(payload=DROP)]), "PAYLOAD_IS_NULL"),
    "payload string": (container([event(payload="text")]), "PAYLOAD_IS_A_STRING"),
    "payload string like an object": (container([event(payload="{}")]), "PAYLOAD_IS_A_STRING"),
    "payload list": (container([event(payload=[1])]), "PAYLOAD_IS_INVALID"),
    "payload number": (container([event(payload=5)]), "PAYLOAD_IS_INVALID"),
    "extra field": (container([event(payload=payload(extra=1))]), "UNEXPECTED_FIELD"),
    "order without user": (container([event(payload=payload(user_id=DROP))]), "MISSING_USER_ID"),
    "order without order": (container([event(payload=payload(order_id=None))]), "MISSING_ORDER_ID"),
    "negative amount": (container([event(payload=payload(amount=-1))]), "INVALID AMOUNT"),
    "just negative": (container([event(payload=payload(amount=-0.001))]), "INVALID AMOUNT"),
    "text amount": (container([event(payload=payload(amount="ten"))]), "INVALID AMOUNT"),
    "no amount": (container([event(payload=payload(amount=DROP))]), "INVALID AMOUNT"),
    "large amount": (container([event(payload=payload(amount=123456789))]), "INVALID AMOUNT"),
    "true amount": (container([event(payload=payload(amount=True))]), "INVALID AMOUNT"),
    "NaN amount": (container([event(payload=payload(amount="NaN"))]), "INVALID AMOUNT"),
    "zero amount": (container([event(payload=payload(amount=0))]), None),
    "numeric text amount": (container([event(payload=payload(amount="12.5"))]), None),
    "all order codes": (
        container([event(payload={"amount": -1})]),
        "MISSING_USER_ID,MISSING_ORDER_ID,INVALID AMOUNT",
    ),
    "user without id": (
        container(
            [event(domain="user_events", payload=payload("user_events", user_id=DROP))],
            domain="user_events",
        ),
        "MISSING_USER_ID",
    ),
    "payment codes": (
        container([event(domain="payment_events", payload={})], domain="payment_events"),
        "MISSING_PAYMENT_ID,MISSING_ORDER_ID,INVALID AMOUNT",
    ),
    "field of another domain": (
        container([event(payload=payload(payment_id="p"))]),
        "UNEXPECTED_FIELD",
    ),
    "envelope before type": (
        container([event(event_type="user_events", source=None)]),
        "MISSING_SOURCE",
    ),
    "type before payload": (
        container([event(event_type="user_events", payload=None)]),
        "DOMAIN_EVENT_TYPE_MISMATCH",
    ),
    "not json": (
        '{"file_id": "f',
        "MISSING_FILE_ID,MISSING_DOMAIN,MISSING_SOURCE_SYSTEM,MISSING_CREATION_TIME,EMPTY_EVENTS",
    ),
}


def test_every_code(spark):
    names = list(CASES)
    rows = judge(spark, [CASES[n][0] for n in names]).collect()
    got = {names[int(r.etag[1:])]: r.reason for r in rows}
    assert got == {n: CASES[n][1] for n in names}


def test_one_bad_event_leaves_the_others(spark):
    """A stray list element or payload never changes how its neighbours are read."""
    mixed = container([1, event(1), event(2, payload="x"), None])
    got = {r.event_id: r.reason for r in judge(spark, [mixed, container([event(3)], n=2)]).collect()}
    assert got["e1"] is None and got["e3"] is None
    assert got["e2"] == "PAYLOAD_IS_A_STRING"
    assert got[None].startswith("MISSING_EVENT_ID,MISSING_EVENT_TYPE")


def test_unexpected_field_can_fail_the_batch(spark):
    document = container([event(payload=payload(surprise=1))])
    with pytest.raises(Exception, match="unexpected payload fields in order_events: surprise"):
        judge(spark, [document], "fail").collect()


def test_unexpected_field_of_a_rejected_event_does_not_fail(spark):
    document = container([event(source=None, payload=payload(surprise=1))])
    rows = judge(spark, [document], "fail").collect()
    assert [r.reason for r in rows] == ["MISSING_SOURCE"]


def test_unknown_policy(spark):
    with pytest.raises(ValueError):
        judge(spark, [container(GOOD)], "ignore")


def test_raw_json_by_stage(spark):
    documents = {
        "container": container([], extra=7),
        "envelope": container([event(source=None)]),
        "type": container([event(event_type="user_events")]),
        "null": container([event(payload=None)]),
        "string": container([event(payload="text")]),
        "other": container([event(payload=[1, 2])]),
        "domain": container([event(payload={"order_id": "o"})]),
    }
    rows = V.rejections(judge(spark, list(documents.values()))).collect()
    raw = {list(documents)[int(r.etag[1:])]: r.raw_event_json for r in rows}
    assert json.loads(raw["container"]) == documents["container"]
    assert json.loads(raw["envelope"])["event_id"] == "e1"
    assert list(json.loads(raw["type"])) == [
        "event_id", "event_type", "source", "event_ts", "ingest_ts", "payload",
    ]
    assert raw["null"] is None
    assert raw["string"] == "text"
    assert raw["other"] == "[1,2]"
    assert json.loads(raw["domain"]) == {"order_id": "o"}


def test_rejection_record(spark):
    import hashlib

    rows = V.rejections(judge(spark, [container([event(event_id=None), event(2, source=None)])]))
    got = {r.event_id: r for r in rows.collect()}
    assert got["e2"].reject_hash == hashlib.sha256(b"t0|e2").hexdigest()
    assert got[None].reject_hash == hashlib.sha256(b"t0").hexdigest()
    assert str(got["e2"].rejection_date) == "2024-06-01"
    assert got["e2"].event_type == "order_events" and got["e2"].file_id == "f1"


def test_file_metrics(spark):
    documents = [
        container([event(1), event(2)]),
        container([event(1), event(2, source=None)]),
        container([event(1, source=None)]),
        container([]),
        container([event(1), event(2), event(3)], file_id=None),
        "garbage",
    ]
    got = {r.etag: tuple(r)[1:] for r in file_metrics(judge(spark, documents)).collect()}
    assert got == {
        "t0": (2, 0, 2, "SUCCESS(SILVER)"),
        "t1": (2, 1, 1, "PARTIAL_SUCCESS(SILVER)"),
        "t2": (1, 1, 0, "FAILED(SILVER)"),
        "t3": (0, 0, 0, "FAILED(SILVER)"),
        "t4": (3, 3, 0, "FAILED(SILVER)"),
        "t5": (0, 0, 0, "FAILED(SILVER)"),
    }


def test_accepted_columns(spark):
    from siltstone.schemas import SILVER

    judged = judge(spark, [container([event()])])
    row = V.accepted(judged, "order_events").collect()[0]
    assert list(row.asDict()) == list(SILVER["order_events"])
    assert str(row.amount) == "10.50" and str(row.event_date) == "2024-01-01"
    with pytest.raises(ValueError):
        V.accepted(judged, "foo_events")


def test_numbers_as_ids_become_text(spark):
    judged = judge(spark, [container([event(payload=payload(order_id=5))])])
    assert V.accepted(judged, "order_events").first().order_id == "5"
