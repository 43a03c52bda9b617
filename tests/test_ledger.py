from conftest import AS_OF
from siltstone.operators import ledger as L
from siltstone.schemas import LEDGER, ddl
from siltstone.session import instant

NOW = 1717200000


def log(spark, rows):
    """(etag, status, lease, retry, seq) to log rows."""
    return spark.createDataFrame(
        [(e, f"p/{e}", s, lease, None, None, retry, None, seq) for e, s, lease, retry, seq in rows], ddl(LEDGER)
    )


def files(spark, *etags):
    return spark.createDataFrame([(e, f"p/{e}") for e in etags], "etag string, file_path string")


STATES = [
    ("done", "IN_PROGRESS", NOW, 0, 1),
    ("done", "VALIDATED", NOW, 0, 2),
    ("bad", "REJECTED", NOW, 0, 1),
    ("leased", "IN_PROGRESS", NOW + 1, 0, 1),
    ("expired", "IN_PROGRESS", NOW, 2, 1),
    ("loading", "IN_PROGRESS(SILVER)", NOW, 0, 3),
]


def test_decisions(spark):
    wanted = files(spark, "new", "done", "bad", "leased", "expired", "loading")
    got = L.decide(wanted, log(spark, STATES), instant(AS_OF)).collect()
    assert {r.etag: r.decision for r in got} == {
        "new": "CLAIM", "done": "SKIP_DONE", "bad": "SKIP_DONE", "leased": "SKIP_LEASED",
        "expired": "RECLAIM", "loading": "SKIP_OTHER",
    }


def test_claims(spark):
    got = {r.etag: r for r in L.claim(files(spark, "new", "expired", "done"), log(spark, STATES), instant(AS_OF)).collect()}
    assert set(got) == {"new", "expired"}
    assert (got["new"].retry_count, got["new"].seq) == (0, 1)
    assert (got["expired"].retry_count, got["expired"].seq) == (3, 2)
    assert {r.lease_expiry for r in got.values()} == {NOW + 60}
    assert list(got["new"].asDict()) == list(LEDGER)


def test_same_content_under_two_names(spark):
    twice = spark.createDataFrame([("t", "p/b"), ("t", "p/a")], "etag string, file_path string")
    got = L.claim(twice, log(spark, []), instant(AS_OF)).collect()
    assert [r.file_path for r in got] == ["p/a"]


def test_transition_needs_the_expected_state(spark):
    updates = spark.createDataFrame(
        [("done", "IN_PROGRESS(SILVER)"), ("leased", "IN_PROGRESS(SILVER)")], "etag string, status string"
    )
    got = L.transition(log(spark, STATES), updates, "VALIDATED", instant(AS_OF)).collect()
    assert [(r.etag, r.status, r.seq) for r in got] == [("done", "IN_PROGRESS(SILVER)", 3)]


def test_results_and_pending(spark):
    metrics = spark.createDataFrame([("loading", "SUCCESS(SILVER)")], "etag string, file_status string")
    got = L.transition(log(spark, STATES), L.file_results(metrics, "r9"), L.IN_SILVER, instant(AS_OF)).collect()
    assert [(r.etag, r.status, r.run_id, r.seq) for r in got] == [("loading", "SUCCESS(SILVER)", "r9", 4)]
    waiting = log(spark, [(f"e{i:02}", "VALIDATED", NOW, 0, 1) for i in range(12)])
    assert [r.etag for r in L.pending(waiting, 10).collect()] == [f"e{i:02}" for i in range(10)]
    assert L.pending(waiting, None).count() == 12
