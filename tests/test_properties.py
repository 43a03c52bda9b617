"""Invariants over generated batches."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import AS_OF, DROP, container, event, texts
from siltstone.operators import validation as V
from siltstone.operators.metrics import file_metrics
from siltstone.plans.silver import one_per_event
from siltstone.schemas import DOMAINS
from siltstone.session import instant

FAULTS = [
    {},
    {"event_id": None},
    {"source": DROP},
    {"event_ts": "never"},
    {"event_type": "user_events"},
    {"payload": None},
    {"payload": "text"},
    {"payload": {"order_id": "o", "amount": -1}},
    {"ingest_ts": "2023-01-01T00:00:00Z"},
]
events = st.builds(
    lambda n, fault: event(n, **fault), st.integers(1, 6), st.sampled_from(FAULTS)
)
documents = st.lists(
    st.builds(
        lambda evs, over: container(evs, **over),
        st.lists(events, max_size=4),
        st.sampled_from([{}, {}, {}, {"file_id": None}, {"domain": "payment_events"}]),
    ),
    min_size=1,
    max_size=4,
)
few = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@few
@given(documents)
def test_every_event_ends_on_exactly_one_side(spark, docs):
    judged = V.check_files(texts(spark, docs), instant(AS_OF), "reject")
    sent = sum(len(d["events"]) for d in docs)
    taken = sum(V.accepted(judged, d).count() for d in DOMAINS)
    refused = judged.filter("reason IS NOT NULL").groupBy().sum("weight").first()[0] or 0
    assert taken + refused == sent
    totals = file_metrics(judged).collect()
    assert len(totals) == len(docs)
    assert sum(r.total_events for r in totals) == sent
    assert sum(r.valid_events for r in totals) == taken


@few
@given(documents)
def test_order_of_files_does_not_matter(spark, docs):
    def result(batch):
        judged = V.check_files(batch, instant(AS_OF), "reject")
        return sorted(map(tuple, one_per_event(V.accepted(judged, "order_events")).collect()), key=repr)

    batch = texts(spark, docs)
    assert result(batch) == result(batch.orderBy("etag", ascending=False))
