"""Notifications, classification, routing and the ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators import files as I
from siltstone.operators import ledger as L
from siltstone.queries import feeds
from siltstone.queries.registry import query
from siltstone.session import instant, scratch_path
from siltstone.sources.files import with_etags, write_routed


@query(
    "notification_unnest",
    """SELECT 'lake' AS bucket, 'raw/order_' || o_orderkey || '_' || i || '.json' AS key,
      md5(o_orderkey || ':' || i) AS etag
    FROM (SELECT o_orderkey, unnest(range(o_orderkey % 4)) AS i FROM orders)""",
)
def notification_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with none to three object records each."""
    records = (
        "transform(slice(array(0, 1, 2), 1, CAST(o_orderkey % 4 AS INT)), i -> struct(struct("
        "struct('lake' AS name) AS bucket, "
        "struct('raw/order_' || o_orderkey || '_' || i || '.json' AS key, "
        "md5(o_orderkey || ':' || i) AS eTag) AS object) AS s3))"
    )
    messages = feeds.load(spark, sf_dir, "orders").selectExpr(
        f"to_json(named_struct('Records', {records})) AS body"
    )
    return I.unnest_notifications(messages)


@query(
    "message_decode",
    "SELECT 's3://lake/validated/' || event_id || '.json' AS file_path, "
    "md5('file ' || event_id) AS etag FROM events",
)
def message_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = feeds.load(spark, sf_dir, "events").selectExpr(
        "'s3://lake/validated/' || event_id || '.json' AS file_path",
        "md5('file ' || event_id) AS etag",
    )
    return I.decode_messages(I.encode_messages(files))


@query(
    "file_classify",
    f"""WITH {feeds.SQL_DAMAGE} SELECT file_path, etag, route,
      CASE WHEN route IN ('rejected', 'unrouted') THEN 'REJECTED' ELSE 'VALIDATED' END AS status
    FROM damaged""",
)
def file_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = I.classify_files(feeds.damaged_documents(spark, sf_dir))
    return classified.select("file_path", "etag", "route", "status")


@query("routed_sink", f"WITH {feeds.SQL_DAMAGE} SELECT file_path, etag, route FROM damaged")
def routed_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written by route and read back."""
    path = scratch_path(spark, "routed")
    write_routed(I.classify_files(feeds.damaged_documents(spark, sf_dir)), path)
    return spark.read.parquet(path).select("file_path", "etag", "route")


@query(
    "etag_map_join",
    "SELECT 's3a://lake/raw/' || o_orderkey || '.json' AS file_path, o_orderpriority AS value, "
    "md5('file ' || o_orderkey) AS etag FROM orders",
)
def etag_map_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files read under ``s3a``, listed under ``s3`` and listed twice."""
    orders = feeds.load(spark, sf_dir, "orders")
    texts = orders.selectExpr(
        "'s3a://lake/raw/' || o_orderkey || '.json' AS file_path", "o_orderpriority AS value"
    )
    listed = orders.selectExpr(
        "explode(array('s3', 's3n')) AS scheme", "o_orderkey"
    ).selectExpr(
        "scheme || '://lake/raw/' || o_orderkey || '.json' AS file_path",
        "md5('file ' || o_orderkey) AS etag",
    )
    return with_etags(texts, listed)


# --- ledger: customers as files, state by key ------------------------------------------

NOW = "2024-06-01T00:00:00+00:00"
_NOW = 1717200000

# Transitions planted per customer: 0 none, 1 leased, 2 lease expired, 3 validated,
# 4 rejected, 5 in silver. The same text in both engines.
_STEPS = "CASE c_custkey % 6 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 1 WHEN 5 THEN 3 ELSE 2 END"
_LOG = {
    "etag": "md5('cust ' || c_custkey)",
    "file_path": "'s3://lake/raw/user_' || c_custkey || '.json'",
    "status": "CASE WHEN step = 1 THEN 'IN_PROGRESS' WHEN step = 3 THEN 'IN_PROGRESS(SILVER)' "
    "WHEN c_custkey % 6 = 4 THEN 'REJECTED' ELSE 'VALIDATED' END",
    "lease_expiry": f"CAST({_NOW} + CASE WHEN c_custkey % 6 = 1 THEN 30 ELSE -(c_custkey % 5) END AS BIGINT)",
    "created_at": "TIMESTAMP '2024-05-01 00:00:00' + (c_custkey % 1000) * INTERVAL '1' MINUTE",
    "updated_at": "TIMESTAMP '2024-05-02 00:00:00' + step * INTERVAL '1' HOUR",
    "retry_count": "CAST(c_custkey % 3 AS INT)",
    "run_id": "CASE WHEN step = 3 THEN 'run-0' END",
    "seq": "CAST(step AS BIGINT)",
}

_SQL_LOG = f"""
ledger AS (
  SELECT {", ".join(f"{sql} AS {name}" for name, sql in _LOG.items())}
  FROM (SELECT c_custkey, unnest(range(1, {_STEPS} + 1)) AS step FROM customer)),
current AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY etag ORDER BY seq DESC) AS rn
  FROM ledger) WHERE rn = 1),
arrived AS (
  SELECT md5('cust ' || c_custkey) AS etag, 's3://lake/a/' || c_custkey AS file_path FROM customer),
decided AS (
  SELECT a.etag, a.file_path, c.created_at, c.retry_count, c.seq,
    CASE WHEN c.status IS NULL THEN 'CLAIM'
         WHEN c.status IN ('VALIDATED', 'REJECTED') THEN 'SKIP_DONE'
         WHEN c.status = 'IN_PROGRESS' AND c.lease_expiry > {_NOW} THEN 'SKIP_LEASED'
         WHEN c.status = 'IN_PROGRESS' THEN 'RECLAIM' ELSE 'SKIP_OTHER' END AS decision
  FROM arrived a LEFT JOIN current c ON a.etag = c.etag)"""


def ledger_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = feeds.load(spark, sf_dir, "customer").selectExpr(
        "c_custkey", f"explode(slice(array(1L, 2L, 3L), 1, {_STEPS})) AS step"
    )
    return steps.selectExpr(*[f"{sql} AS {name}" for name, sql in _LOG.items()])


def arrived_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file arrives under two names."""
    return feeds.load(spark, sf_dir, "customer").selectExpr(
        "md5('cust ' || c_custkey) AS etag", "explode(array('b', 'a')) AS folder", "c_custkey"
    ).selectExpr("etag", "'s3://lake/' || folder || '/' || c_custkey AS file_path")


@query("ledger_current", f"WITH {_SQL_LOG} SELECT * FROM current")
def ledger_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.plain(L.current(ledger_log(spark, sf_dir)))


@query("ledger_decide", f"WITH {_SQL_LOG} SELECT etag, file_path, decision FROM decided")
def ledger_decide(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = L.decide(arrived_files(spark, sf_dir), ledger_log(spark, sf_dir), instant(NOW))
    return decided.select("etag", "file_path", "decision")


@query(
    "ledger_claim",
    f"""WITH {_SQL_LOG} SELECT etag, file_path, 'IN_PROGRESS' AS status,
      CAST({_NOW + 60} AS BIGINT) AS lease_expiry,
      coalesce(created_at, TIMESTAMP '2024-06-01 00:00:00') AS created_at,
      TIMESTAMP '2024-06-01 00:00:00' AS updated_at,
      CAST(coalesce(retry_count + 1, 0) AS INTEGER) AS retry_count, CAST(NULL AS VARCHAR) AS run_id,
      CAST(coalesce(seq, 0) + 1 AS BIGINT) AS seq
    FROM decided WHERE decision IN ('CLAIM', 'RECLAIM')""",
)
def ledger_claim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.plain(
        L.claim(arrived_files(spark, sf_dir), ledger_log(spark, sf_dir), instant(NOW))
    )


@query(
    "ledger_start",
    f"""WITH {_SQL_LOG} SELECT * REPLACE ('IN_PROGRESS(SILVER)' AS status,
      TIMESTAMP '2024-06-01 00:00:00' AS updated_at, seq + 1 AS seq)
    FROM current WHERE status = 'VALIDATED'""",
)
def ledger_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files are to start; only those waiting do."""
    log = ledger_log(spark, sf_dir)
    updates = arrived_files(spark, sf_dir).select("etag").distinct()
    updates = updates.withColumn("status", F.lit(L.IN_SILVER))
    return feeds.plain(L.transition(log, updates, L.VALIDATED, instant(NOW)))


@query(
    "ledger_finish",
    f"""WITH {_SQL_LOG} SELECT c.* REPLACE (
      CASE WHEN c_nationkey % 3 = 0 THEN 'FAILED(SILVER)' ELSE 'SUCCESS(SILVER)' END AS status,
      TIMESTAMP '2024-06-01 00:00:00' AS updated_at, 'run-7' AS run_id, seq + 1 AS seq)
    FROM current c JOIN customer ON etag = md5('cust ' || c_custkey)
    WHERE status = 'IN_PROGRESS(SILVER)'""",
)
def ledger_finish(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = feeds.load(spark, sf_dir, "customer").selectExpr(
        "md5('cust ' || c_custkey) AS etag",
        "CASE WHEN c_nationkey % 3 = 0 THEN 'FAILED(SILVER)' ELSE 'SUCCESS(SILVER)' END AS file_status",
    )
    results = L.file_results(metrics, "run-7")
    log = ledger_log(spark, sf_dir)
    return feeds.plain(L.transition(log, results, L.IN_SILVER, instant(NOW)))


@query(
    "file_results",
    "SELECT md5('cust ' || c_custkey) AS etag, c_mktsegment AS status, 'run-7' AS run_id FROM customer",
)
def file_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = feeds.load(spark, sf_dir, "customer").selectExpr(
        "md5('cust ' || c_custkey) AS etag", "c_mktsegment AS file_status"
    )
    return L.file_results(metrics, "run-7")


@query(
    "pending_top_n",
    f"""WITH {_SQL_LOG} SELECT * FROM current WHERE status = 'VALIDATED'
    ORDER BY created_at, etag LIMIT 10""",
)
def pending_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.plain(L.pending(ledger_log(spark, sf_dir), 10))
