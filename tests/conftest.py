from __future__ import annotations

import json
import os
import sys
import uuid

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(__file__)]

from siltstone.schemas import Lake, create_tables
from siltstone.session import local_session, scratch_path

AS_OF = "2024-06-01T00:00:00+00:00"


@pytest.fixture(scope="session")
def spark():
    return local_session(8, shuffle_partitions=4)


@pytest.fixture
def lake(spark):
    path = scratch_path(spark, "lake")
    lake = Lake(prefix=f"t{uuid.uuid4().hex[:10]}_")
    create_tables(spark, lake, location=path)
    return lake


@pytest.fixture(params=["day", "month"])
def any_lake(spark, request):
    path = scratch_path(spark, "lake")
    lake = Lake(prefix=f"t{path[-10:]}_", grain=request.param)
    create_tables(spark, lake, location=path)
    return lake


def event(n=1, domain="order_events", **over):
    payload = {
        "user_events": {"user_id": f"u{n}", "email": "a@b", "country": "IN", "device": "ios"},
        "order_events": {
            "order_id": f"o{n}", "user_id": "u1", "amount": 10.5, "currency": "USD",
            "status": "order_created",
        },
        "payment_events": {
            "payment_id": f"p{n}", "order_id": "o1", "amount": 3, "currency": "USD",
            "status": "payment_success",
        },
    }.get(domain, {})
    base = {
        "event_id": f"e{n}",
        "event_type": domain,
        "source": "app",
        "event_ts": "2024-01-01T10:00:00+00:00",
        "ingest_ts": "2024-01-01T10:00:05+00:00",
        "payload": payload,
    }
    base.update(over)
    return {k: v for k, v in base.items() if v is not DROP}


DROP = object()


def container(events, n=1, domain="order_events", **over):
    base = {
        "file_id": f"f{n}",
        "domain": domain,
        "source_system": "web",
        "created_at": "2024-01-01T09:00:00+00:00",
        "events": events,
    }
    base.update(over)
    return {k: v for k, v in base.items() if v is not DROP}


def texts(spark, documents):
    """Documents (dicts or text) to ``etag, value`` with etags t0, t1, ..."""
    rows = [
        (f"t{i}", d if isinstance(d, str) or d is None else json.dumps(d, indent=2))
        for i, d in enumerate(documents)
    ]
    return spark.createDataFrame(rows, "etag string, value string")


def silver_rows(spark, lake, domain):
    spark.catalog.refreshTable(lake.silver(domain))
    return spark.table(lake.silver(domain)).collect()


def table_rows(spark, name):
    spark.catalog.refreshTable(name)
    return spark.table(name).collect()
