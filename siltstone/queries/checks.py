"""Container, envelope and payload checks, rejections and file metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import payload as P
from siltstone.operators import metrics as M
from siltstone.operators import validation as V
from siltstone.operators.columns import union_by_name
from siltstone.operators.ledger import reported_results as reported
from siltstone.plans.silver import one_per_event
from siltstone.queries import feeds
from siltstone.queries.registry import query
from siltstone.schemas import CONTRACT, DOMAINS, SILVER
from siltstone.session import instant


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.check_files(feeds.documents(spark, sf_dir), instant(feeds.AS_OF), "reject")


_W = f"WITH {feeds.SQL_JUDGED}"

_HEADER = "etag, file_id, domain, source_system, created_at"


@query(
    "container_rejections",
    f"{_W} SELECT {_HEADER}, n_events AS weight, container_reason FROM containers "
    "WHERE container_reason IS NOT NULL",
)
def container_rejections(spark: SparkSession, sf_dir: str) -> DataFrame:
    containers = V.judge_containers(V.parse_containers(feeds.documents(spark, sf_dir)))
    bad = V.open_events(containers.filter("container_reason IS NOT NULL"))
    return feeds.plain(
        bad.select(
            "etag", "file_id", "domain", "source_system", "created_at", "weight", "container_reason"
        )
    )


@query(
    "accepted_containers",
    f"{_W} SELECT {_HEADER}, n_events FROM containers WHERE container_reason IS NULL",
)
def accepted_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    containers = V.judge_containers(V.parse_containers(feeds.documents(spark, sf_dir)))
    return feeds.plain(
        containers.filter("container_reason IS NULL").select(
            "etag",
            "file_id",
            "domain",
            "source_system",
            "created_at",
            F.size("events").cast("bigint").alias("n_events"),
        )
    )


@query(
    "opened_events",
    f"{_W} SELECT etag, event_id, event_type, source, event_ts, ingest_ts, kind AS payload_kind "
    "FROM typed",
)
def opened_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the good containers, one row each, with text times parsed."""
    from siltstone.functions.text import iso_instant

    containers = V.judge_containers(V.parse_containers(feeds.documents(spark, sf_dir)))
    events = V.read_payload(V.open_events(containers.filter("container_reason IS NULL")))
    kind = (
        F.when(F.col("payload_kind") != "other", F.col("payload_kind"))
        .when(P.as_text(F.col("payload")).startswith("["), "array")
        .otherwise("number")
    )
    return feeds.plain(
        events.select(
            "etag",
            "event_id",
            "event_type",
            "source",
            iso_instant(F.col("event_ts_text")).alias("event_ts"),
            iso_instant(F.col("ingest_ts_text")).alias("ingest_ts"),
            kind.alias("payload_kind"),
        )
    )


def _rejected_with(pattern: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = V.rejections(judged(spark, sf_dir)).filter(F.col("rejection_reason").rlike(pattern))
        return rows.select("etag", "event_id", "event_type", "rejection_reason")

    return run


def _stage_sql(stage: str, where: str = "TRUE") -> str:
    return (
        f"{_W} SELECT etag, event_id, event_type, reason AS rejection_reason FROM judged "
        f"WHERE reason IS NOT NULL AND reason = {stage} AND {where}"
    )


query("envelope_rejections", _stage_sql("envelope_reason"))(
    _rejected_with(
        "^(MISSING_(EVENT_ID|EVENT_TYPE|EVENT_TIMESTAMP|SOURCE|INGEST_TIMESTAMP)|INGEST|EVENT_T)"
        "(?!_SYSTEM)"
    )
)
query("domain_mismatch", _stage_sql("type_reason", "reason LIKE 'DOMAIN%'"))(
    _rejected_with("^DOMAIN_EVENT_TYPE_MISMATCH$")
)
query("invalid_event_type", _stage_sql("type_reason", "reason LIKE 'INVALID%'"))(
    _rejected_with("^INVALID_EVENT_TYPE$")
)
query("domain_rejections", _stage_sql("domain_reason"))(
    _rejected_with("^(MISSING_(USER|PAYMENT|ORDER)_ID|INVALID AMOUNT)")
)


@query(
    "payload_contract",
    f"""{_W} SELECT etag, event_id, reason AS rejection_reason,
      CASE kind WHEN 'string' THEN 'text' WHEN 'array' THEN '[1,2]' WHEN 'number' THEN '5' END AS raw
    FROM judged WHERE reason IS NOT NULL AND reason = payload_reason""",
)
def payload_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.rejections(judged(spark, sf_dir)).filter(
        F.col("rejection_reason").rlike("^(PAYLOAD_|UNEXPECTED_)")
    )
    whole = F.col("rejection_reason") == "UNEXPECTED_FIELD"
    return rows.select(
        "etag",
        "event_id",
        "rejection_reason",
        F.when(~whole, F.col("raw_event_json")).alias("raw"),
    )


@query(
    "rejection_records",
    f"""{_W} SELECT file_id, domain, source_system, created_at, etag, event_id, event_type,
      reason AS rejection_reason, reason <> 'PAYLOAD_IS_NULL' AS has_raw,
      TIMESTAMP '2030-01-01 00:00:00' AS rejection_ts, DATE '2030-01-01' AS rejection_date,
      sha256(concat_ws('|', etag, event_id)) AS reject_hash
    FROM judged WHERE reason IS NOT NULL""",
)
def rejection_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.rejections(judged(spark, sf_dir))
    return feeds.plain(
        rows.withColumn("has_raw", F.col("raw_event_json").isNotNull()).drop("raw_event_json")
    )


@query(
    "reject_hash",
    f"{_W} SELECT sha256(concat_ws('|', etag, event_id)) AS reject_hash, count(*) AS n "
    "FROM judged WHERE reason IS NOT NULL GROUP BY 1",
)
def reject_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.rejections(judged(spark, sf_dir))
    return rows.groupBy("reject_hash").agg(F.count(F.lit(1)).alias("n"))


def _accepted(domain: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return feeds.plain(V.accepted(judged(spark, sf_dir), domain))

    return run


def _deduped(domain: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return feeds.plain(one_per_event(V.accepted(judged(spark, sf_dir), domain)))

    return run


def silver_columns(domain: str) -> str:
    return ", ".join(list(SILVER[domain]))


def silver_sql(domain: str, columns: str = "") -> str:
    """Accepted events of a domain, first delivery per event id."""
    rest = [c for c in list(SILVER[domain]) if c not in ("ingest_ts", "file_id", "event_id")]
    order = ", ".join(f"{c} NULLS LAST" for c in ["ingest_ts", "file_id", *rest])
    return (
        f"SELECT {columns or silver_columns(domain)} FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY event_id ORDER BY {order}) AS rn "
        f"FROM judged WHERE reason IS NULL AND event_type = '{domain}') WHERE rn = 1"
    )


for _domain in DOMAINS:
    query(
        f"accepted_{_domain}",
        f"{_W} SELECT {silver_columns(_domain)} FROM judged "
        f"WHERE reason IS NULL AND event_type = '{_domain}'",
    )(_accepted(_domain))
    query(f"first_delivery_{_domain}", f"{_W} {silver_sql(_domain)}")(_deduped(_domain))


# --- counts per file ---------------------------------------------------------------

# File states.
METRICS_SQL = """
metrics AS (
  SELECT etag, CAST(sum(weight) AS BIGINT) AS total_events,
    CAST(sum(CASE WHEN reason IS NOT NULL THEN weight ELSE 0 END) AS BIGINT) AS rejected_events
  FROM judged GROUP BY etag),
file_metrics AS (
  SELECT *, total_events - rejected_events AS valid_events,
    CASE WHEN total_events = rejected_events THEN 'FAILED(SILVER)'
         WHEN rejected_events = 0 THEN 'SUCCESS(SILVER)'
         ELSE 'PARTIAL_SUCCESS(SILVER)' END AS file_status
  FROM metrics)"""


@query("file_metrics", f"{_W}, {METRICS_SQL} SELECT * FROM file_metrics")
def file_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.file_metrics(judged(spark, sf_dir))


@query(
    "job_result",
    f"""{_W}, {METRICS_SQL} SELECT etag, '{{"total":' || total_events || ',"valid":' || valid_events ||
      ',"rejected":' || rejected_events || ',"status":"' || file_status || '"}}' AS result
    FROM file_metrics""",
)
def job_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.job_result(M.file_metrics(judged(spark, sf_dir)))


@query(
    "reported_results",
    f"{_W}, {METRICS_SQL} SELECT etag, file_status AS status, 'run-3' AS run_id FROM file_metrics",
)
def reported_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reported(M.job_result(M.file_metrics(judged(spark, sf_dir))), "run-3")


@query(
    "events_per_file",
    f"{_W} SELECT etag, count(*) AS total_events FROM opened GROUP BY etag",
)
def events_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    containers = V.judge_containers(V.parse_containers(feeds.documents(spark, sf_dir)))
    events = V.open_events(containers.filter("container_reason IS NULL"))
    return M.count_per_file(events, "total_events")


@query(
    "rejections_per_file",
    f"{_W} SELECT etag, count(*) AS rejected_events FROM judged WHERE reason IS NOT NULL GROUP BY etag",
)
def rejections_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.count_per_file(V.rejections(judged(spark, sf_dir)), "rejected_events")


@query(
    "combined_counts",
    """WITH c AS (
      SELECT md5('o' || o_orderkey) AS etag, count(l_orderkey) AS total_events,
        count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS rejected_events
      FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey)
    SELECT *, total_events - rejected_events AS valid_events,
      CASE WHEN total_events = rejected_events THEN 'FAILED(SILVER)'
           WHEN rejected_events = 0 THEN 'SUCCESS(SILVER)'
           ELSE 'PARTIAL_SUCCESS(SILVER)' END AS file_status FROM c""",
)
def combined_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as files, their lines as events, returned lines as rejections."""
    files = feeds.load(spark, sf_dir, "orders").selectExpr("md5('o' || o_orderkey) AS etag")
    lines = feeds.load(spark, sf_dir, "lineitem").selectExpr(
        "md5('o' || l_orderkey) AS etag", "l_returnflag"
    )
    return M.combine_counts(
        files,
        M.count_per_file(lines, "total_events"),
        M.count_per_file(lines.filter("l_returnflag = 'R'"), "rejected_events"),
    )


@query(
    "schema_union",
    f"""{_W}
    SELECT 'container' AS stage, etag, CAST(NULL AS VARCHAR) AS event_id, reason AS rejection_reason
    FROM judged WHERE container_reason IS NOT NULL
    UNION ALL BY NAME
    SELECT event_id, reason AS rejection_reason, etag, 'event' AS stage
    FROM judged WHERE reason IS NOT NULL AND container_reason IS NULL""",
)
def schema_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = feeds.documents(spark, sf_dir)
    containers = V.judge_containers(V.parse_containers(documents))
    first = containers.filter("container_reason IS NOT NULL").select(
        F.lit("container").alias("stage"), "etag", F.col("container_reason").alias("rejection_reason")
    )
    opened = V.open_events(containers.filter("container_reason IS NULL"))
    second = V.rejections(V.judge_events(opened, instant(feeds.AS_OF), "reject")).select(
        "event_id", "rejection_reason", "etag", F.lit("event").alias("stage")
    )
    return union_by_name([first, second], fill_missing=True)


ALL_FIELDS = tuple(dict.fromkeys(f for d in DOMAINS for f in CONTRACT[d]))
