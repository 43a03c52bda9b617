"""Whole runs through files, tables and streams."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.text import content_tag
from siltstone.operators import ledger as L
from siltstone.operators import validation as V
from siltstone.operators.columns import union_by_name
from siltstone.operators.layout import cluster_table, maintain
from siltstone.operators.ledger_store import fold, ledger_log, record
from siltstone.operators.merge import append, fresh
from siltstone.plans.intake import run_intake
from siltstone.plans.silver import finish_silver, run_pending, run_silver_batch, run_silver_files
from siltstone.queries import feeds
from siltstone.queries.checks import ALL_FIELDS, METRICS_SQL, silver_sql
from siltstone.queries.registry import ORACLE, query
from siltstone.schemas import CLUSTER_BY, CONTRACT, DOMAINS, REJECTED, SILVER, Lake, create_tables
from siltstone.session import cut_lineage, instant, scratch_path
from siltstone.sources.files import read_texts, stream_texts
from siltstone.streaming.silver import start_silver_stream

_COMMON = (
    "file_id, domain, source_system, created_at, event_id, event_type, source, event_ts, "
    "ingest_ts, event_date"
)


def _new_lake(spark: SparkSession, indexed: bool = False) -> Lake:
    """A lake by months: the given events are few a day."""
    path = scratch_path(spark, "lake")
    lake = Lake(prefix=f"q{path[-12:]}_", grain="month", indexed=indexed)
    create_tables(spark, lake, location=path)
    return lake


def _all_silver(spark: SparkSession, lake: Lake) -> DataFrame:
    tables = []
    for domain in DOMAINS:
        tables.append(fresh(spark, lake.silver(domain)).select(*SILVER[domain]))
    return feeds.plain(union_by_name(tables, fill_missing=True))


def _wide(domain: str) -> str:
    own = CONTRACT[domain]
    kind = {"amount": "DECIMAL(10,2)"}
    return ", ".join(
        [_COMMON]
        + [f if f in own else f"CAST(NULL AS {kind.get(f, 'VARCHAR')}) AS {f}" for f in ALL_FIELDS]
    )


_SILVER_SQL = f"WITH {feeds.SQL_JUDGED} " + " UNION ALL BY NAME ".join(
    silver_sql(domain, _wide(domain)) for domain in DOMAINS
)


@query("silver_batch", _SILVER_SQL)
def silver_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch loaded twice: the second load adds nothing."""
    lake = _new_lake(spark)
    texts = feeds.delivered(feeds.documents(spark, sf_dir).drop("eid"))
    for _ in range(2):
        run_silver_batch(spark, texts, lake, feeds.AS_OF, on_unexpected="reject")
    return _all_silver(spark, lake)


@query("silver_batch_staged", _SILVER_SQL)
def silver_batch_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch with the judged rows held in a written table."""
    lake = _new_lake(spark)
    texts = feeds.documents(spark, sf_dir)
    run_silver_batch(spark, texts, lake, feeds.AS_OF, on_unexpected="reject", hold="table")
    return _all_silver(spark, lake)


@query("silver_indexed", _SILVER_SQL)
def silver_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """About half of the files, then all of them, into a lake with an index of event ids."""
    lake = _new_lake(spark, indexed=True)
    texts = feeds.delivered(feeds.documents(spark, sf_dir).drop("eid"))
    half = texts.filter(F.pmod(F.xxhash64("etag"), F.lit(2)) == 0)
    for part in (half, texts):
        run_silver_batch(spark, part, lake, feeds.AS_OF, on_unexpected="reject")
    return _all_silver(spark, lake)


@query("silver_stream", _SILVER_SQL)
def silver_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written one per line, then streamed in."""
    folder = feeds.written_lines(spark, sf_dir)
    lake = _new_lake(spark)
    start_silver_stream(
        stream_texts(spark, folder, whole=False),
        scratch_path(spark, "stream-checkpoint"),
        lake,
        {"availableNow": True},
        feeds.AS_OF,
    ).awaitTermination()
    return _all_silver(spark, lake)


def _packs(spark: SparkSession, sf_dir: str, event_type: str) -> str:
    """Folder of container files with at most 500 events each, one document per file.

    The pack number counts rows inside a scan task, so no pack can grow with
    the data or with a hot key.
    """
    time = F.expr("date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") || '+00:00'")
    event = F.struct(
        F.expr("'e' || event_id").alias("event_id"),
        F.expr(event_type).alias("event_type"),
        F.lit("app").alias("source"),
        time.alias("event_ts"),
        time.alias("ingest_ts"),
        F.struct(F.expr("'u' || user_id").alias("user_id")).alias("payload"),
    )
    packed = feeds.load(spark, sf_dir, "events").select(
        F.monotonically_increasing_id().alias("row"), event.alias("event")
    )
    documents = packed.groupBy(F.expr("row div 500").alias("pack")).agg(
        F.collect_list("event").alias("events")
    )
    value = F.to_json(
        F.struct(
            F.expr("'file-' || pack").alias("file_id"),
            F.lit("user_events").alias("domain"),
            F.lit("web").alias("source_system"),
            F.lit("2024-01-01T00:00:00+00:00").alias("created_at"),
            "events",
        )
    )
    folder = scratch_path(spark, "containers")
    documents.select(value.alias("value")).write.option("maxRecordsPerFile", 1).text(folder)
    return folder


@query(
    "container_roundtrip",
    "SELECT 'e' || event_id AS event_id, event_type, 'u' || user_id AS user_id, "
    "ts AS event_ts FROM events",
)
def container_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events packed into files of at most 500, one document each, and read back."""
    folder = _packs(spark, sf_dir, "event_type")
    texts = read_texts(spark, folder).withColumn("etag", content_tag(F.col("value")))
    events = V.read_payload(V.open_events(V.judge_containers(V.parse_containers(texts))))
    return feeds.plain(
        events.select(
            "event_id",
            "event_type",
            "user_id",
            F.try_to_timestamp("event_ts_text").alias("event_ts"),
        )
    )


@query(
    "file_lifecycle",
    f"""WITH {feeds.SQL_JUDGED}, {METRICS_SQL}, {feeds.SQL_DAMAGE}
    SELECT d.etag, d.file_path,
      CASE WHEN route IN ('rejected', 'unrouted') THEN 'REJECTED' ELSE file_status END AS status,
      CASE WHEN route IN ('rejected', 'unrouted') THEN NULL ELSE 'run-1' END AS run_id,
      CAST(0 AS INTEGER) AS retry_count,
      CAST(CASE WHEN route IN ('rejected', 'unrouted') THEN 2 ELSE 4 END AS BIGINT) AS seq
    FROM damaged d JOIN file_metrics m ON d.etag = m.etag""",
)
def file_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged and good files through intake and silver; the ledger at the end."""
    lake = _new_lake(spark)
    texts = feeds.delivered(feeds.damaged_documents(spark, sf_dir).drop("eid"))
    run_intake(spark, texts, lake, feeds.AS_OF)
    run_pending(spark, "run-1", lake, feeds.AS_OF, limit=None, on_unexpected="reject")
    spark.catalog.refreshTable(lake.ledger)
    return L.current(spark.table(lake.ledger)).select(
        "etag", "file_path", "status", "run_id", "retry_count", "seq"
    )


@query("ledger_folded", ORACLE["file_lifecycle"])
def ledger_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the ledger folded after half of the files, after all, and after silver."""
    lake = _new_lake(spark)
    texts = feeds.delivered(feeds.damaged_documents(spark, sf_dir).drop("eid"))
    half = texts.filter(F.pmod(F.xxhash64("value"), F.lit(2)) == 0)
    for number, part in enumerate((half, texts)):
        run_intake(spark, part, lake, feeds.AS_OF)
        fold(spark, lake, date(2030, 2 + number, 1))
    run_pending(spark, "run-1", lake, feeds.AS_OF, limit=None, on_unexpected="reject")
    fold(spark, lake, date(2030, 4, 1))
    return L.current(ledger_log(spark, lake)).select("etag", "file_path", "status", "run_id", "retry_count", "seq")


@query(
    "silver_takeover",
    f"""WITH {feeds.SQL_JUDGED}, {METRICS_SQL}, {feeds.SQL_DAMAGE}
    SELECT d.etag,
      CASE WHEN route IN ('rejected', 'unrouted') THEN 'REJECTED' ELSE file_status END AS status,
      CASE WHEN route IN ('rejected', 'unrouted') THEN NULL ELSE 'run-2' END AS run_id,
      CAST(CASE WHEN route IN ('rejected', 'unrouted') THEN 0 ELSE 1 END AS INTEGER) AS retry_count,
      CAST(CASE WHEN route IN ('rejected', 'unrouted') THEN 2 ELSE 5 END AS BIGINT) AS seq,
      CASE WHEN route NOT IN ('rejected', 'unrouted') THEN rejected_events END AS rejected_events,
      CASE WHEN route NOT IN ('rejected', 'unrouted') THEN coalesce(n, 0) END AS rejection_rows
    FROM damaged d JOIN file_metrics m ON d.etag = m.etag LEFT JOIN
      (SELECT etag, count(*) AS n FROM judged WHERE reason IS NOT NULL GROUP BY etag) r ON r.etag = d.etag""",
)
def silver_takeover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run dies after its rows are in, a later one takes its files over, the first reports late."""
    lake = _new_lake(spark)
    run_intake(spark, feeds.delivered(feeds.damaged_documents(spark, sf_dir).drop("eid")), lake, feeds.AS_OF)
    log = fresh(spark, lake.ledger)
    waiting = L.pending(log, None)
    record(spark, lake, cut_lineage(L.start_silver(log, waiting, "run-1", instant(feeds.AS_OF))))
    texts = fresh(spark, lake.routed).filter(F.col("route").isin(*DOMAINS))
    metrics = run_silver_batch(spark, texts, lake, feeds.AS_OF, on_unexpected="reject")
    # feeds.AS_OF is the start of run-1; its lease is over an hour later
    run_pending(spark, "early", lake, "2030-01-01T00:59:59Z", limit=None, on_unexpected="reject")
    run_pending(spark, "run-2", lake, "2030-01-01T01:00:00Z", limit=None, on_unexpected="reject")
    finish_silver(spark, L.file_results(metrics, "run-1"), "run-1", lake, "2030-01-01T02:00:00Z")

    state = L.current(fresh(spark, lake.ledger)).select("etag", "status", "run_id", "retry_count", "seq")
    stored = fresh(spark, lake.metrics).select("etag", "rejected_events")
    rows = fresh(spark, lake.rejected).groupBy("etag").agg(F.count("*").alias("n"))
    counts = stored.join(rows, "etag", "left")
    counts = counts.select("etag", "rejected_events", F.coalesce("n", F.lit(0)).cast("bigint").alias("rejection_rows"))
    return state.join(counts, "etag", "left")


@query("cluster_rewrite", "SELECT * FROM orders")
def cluster_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table rewritten in clustered order holds the same rows."""
    lake = _new_lake(spark)
    table = f"{lake.schema('gold')}.clustered_orders"
    orders = feeds.load(spark, sf_dir, "orders")
    orders.write.format("parquet").saveAsTable(table)
    cluster_table(spark, table, ["o_custkey", "o_orderpriority"], files=8)
    return spark.table(table)


@query("cluster_partitioned", f"WITH {feeds.SQL_SILVER} SELECT event_id, order_id, amount, event_date FROM "
       "(SELECT *, CAST(event_ts AS DATE) AS event_date FROM order_events)")
def cluster_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned table clustered as a whole and again in part holds the same rows."""
    lake = _new_lake(spark)
    table = lake.silver("order_events")
    rows = feeds.order_events(spark, sf_dir).select(*SILVER["order_events"])
    part = lake.partition("order_events")
    append(lake.dated(rows, "order_events"), table, part)
    columns = list(CLUSTER_BY["order_events"])
    cluster_table(spark, table, columns, 16, part)
    cluster_table(spark, table, columns, 4, part, f"{part} >= DATE '2000-01-01'")
    return spark.table(table).select("event_id", "order_id", "amount", "event_date")


_SQL_ARRIVAL = "CASE ascii(substr(etag, 1, 1)) % 3 WHEN 0 THEN DATE '2029-11-01' WHEN 1 THEN DATE '2029-12-01' ELSE DATE '2030-01-01' END"


@query(
    "arrival_routing",
    f"""WITH {feeds.SQL_JUDGED}, {METRICS_SQL}, {feeds.SQL_DAMAGE},
    arrived AS (SELECT *, {_SQL_ARRIVAL} AS arrival_date FROM damaged),
    loaded AS (SELECT *, route NOT IN ('rejected', 'unrouted') AND arrival_date < DATE '2030-01-01' AS early,
      route NOT IN ('rejected', 'unrouted') AS fine FROM arrived)
    SELECT d.etag, route, arrival_date,
      CASE WHEN fine THEN file_status ELSE 'REJECTED' END AS status,
      CASE WHEN early THEN 'run-1' WHEN fine THEN 'run-2' END AS run_id,
      CASE WHEN fine THEN total_events END AS total_events
    FROM loaded d JOIN file_metrics m ON d.etag = m.etag""",
)
def arrival_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that arrive on three days, two of them before the first silver run, each delivered again later."""
    lake = _new_lake(spark)
    texts = feeds.delivered(feeds.damaged_documents(spark, sf_dir).drop("eid"))
    day = F.expr("ascii(substr(etag, 1, 1)) % 3")
    for number, noon in enumerate(("2029-11-01T12:00:00Z", "2029-12-01T12:00:00Z")):
        run_intake(spark, texts.filter(day <= number), lake, noon)
    run_pending(spark, "run-1", lake, "2029-12-02T00:00:00Z", limit=None, on_unexpected="reject")
    run_intake(spark, texts, lake, feeds.AS_OF)
    run_pending(spark, "run-2", lake, feeds.AS_OF, limit=None, on_unexpected="reject")
    stored = fresh(spark, lake.routed).select("etag", "route", "arrival_date")
    state = L.current(fresh(spark, lake.ledger)).select("etag", "status", "run_id")
    metrics = fresh(spark, lake.metrics).select("etag", "total_events")
    return stored.join(state, "etag", "full").join(metrics, "etag", "left")


@query(
    "maintain_touched",
    f"""WITH {feeds.SQL_SILVER}, dated AS (SELECT *, CAST(event_ts AS DATE) AS event_date FROM order_events)
    SELECT event_id, order_id, amount, event_date,
      max(CASE WHEN month(event_date) = 1 AND day(event_date) > 15 THEN 1 ELSE 0 END)
        OVER (PARTITION BY date_trunc('month', event_date)) = 1 AS rewritten
    FROM dated""",
)
def maintain_touched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clustered, then late rows for every January: a second call rewrites these months only."""
    lake = _new_lake(spark)
    table, part = lake.silver("order_events"), lake.partition("order_events")
    rows = lake.dated(feeds.order_events(spark, sf_dir).select(*SILVER["order_events"]), "order_events")
    late = F.expr("coalesce(month(event_date) = 1 AND day(event_date) > 15, false)")
    append(rows.filter(~late), table, part)
    maintain(spark, lake, files=32)
    before = fresh(spark, table).groupBy(part).agg(F.min("_metadata.file_name").alias("was"))
    before = cut_lineage(before)
    append(rows.filter(late), table, part)
    maintain(spark, lake, files=32)
    now = fresh(spark, table).select(
        "event_id", "order_id", "amount", "event_date", part, F.col("_metadata.file_name").alias("file")
    )
    write = r"^part-[0-9]+-([0-9a-f-]{36})"
    other = F.regexp_extract("file", write, 1) != F.regexp_extract("was", write, 1)
    return now.join(before, part, "left").select(
        "event_id", "order_id", "amount", "event_date", F.coalesce(other, F.lit(True)).alias("rewritten")
    )


@query(
    "intake_duplicates",
    f"""WITH {feeds.SQL_JUDGED}, {METRICS_SQL}, {feeds.SQL_DAMAGE}
    SELECT d.etag, d.route IN ('rejected', 'unrouted') AS turned_down, CAST(1 AS BIGINT) AS stored,
      CAST(1 AS BIGINT) AS ledger_rows_per_state,
      CASE WHEN d.route NOT IN ('rejected', 'unrouted') THEN m.total_events END AS total_events,
      CASE WHEN d.route NOT IN ('rejected', 'unrouted') THEN m.rejected_events END AS rejected_events
    FROM damaged d JOIN file_metrics m ON d.etag = m.etag""",
)
def intake_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file notified twice in one batch is stored, counted and recorded once."""
    lake = _new_lake(spark)
    texts = feeds.delivered(feeds.damaged_documents(spark, sf_dir).drop("eid"))
    run_intake(spark, texts.union(texts), lake, feeds.AS_OF)
    run_pending(spark, "run-1", lake, feeds.AS_OF, limit=None, on_unexpected="reject")
    turned_down = F.first("route").isin("rejected", "unrouted").alias("turned_down")
    stored = fresh(spark, lake.routed).groupBy("etag").agg(turned_down, F.count("*").alias("stored"))
    states = fresh(spark, lake.ledger).groupBy("etag", "status").agg(F.count("*").alias("n"))
    states = states.groupBy("etag").agg(F.max("n").alias("ledger_rows_per_state"))
    metrics = fresh(spark, lake.metrics).select("etag", "total_events", "rejected_events")
    return stored.join(states, "etag", "full").join(metrics, "etag", "left")


@query("silver_replay", f"""WITH {feeds.SQL_JUDGED}, {METRICS_SQL}
    SELECT etag, CAST(1 AS BIGINT) AS metric_rows,
      CAST(sum(n) AS BIGINT) AS rejection_rows
    FROM (SELECT etag, 0 AS n FROM file_metrics
          UNION ALL SELECT etag, 1 FROM judged WHERE reason IS NOT NULL) GROUP BY etag""")
def silver_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics and rejections after a batch is loaded twice are those of one load."""
    lake = _new_lake(spark)
    texts = feeds.delivered(feeds.documents(spark, sf_dir).drop("eid"))
    for _ in range(2):
        run_silver_batch(spark, texts, lake, feeds.AS_OF, on_unexpected="reject", once_per_file=True)
    metrics = fresh(spark, lake.metrics).groupBy("etag").agg(F.count("*").alias("metric_rows"))
    rejected = fresh(spark, lake.rejected).groupBy("etag").agg(F.count("*").alias("n"))
    return metrics.join(rejected, "etag", "full").select(
        "etag", "metric_rows", F.coalesce("n", F.lit(0)).cast("bigint").alias("rejection_rows")
    )


@query(
    "silver_from_file_list",
    "SELECT 'e' || event_id AS event_id, 'u' || user_id AS user_id, ts AS event_ts, "
    "CAST(ts AS DATE) AS event_date FROM events",
)
def silver_from_file_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Container files of at most 500 events, loaded from a list of paths and etags."""
    texts = read_texts(spark, _packs(spark, sf_dir, "'user_events'"))
    listed = texts.select("file_path", content_tag(F.col("value")).alias("etag"))
    lake = _new_lake(spark)
    files = [r.asDict() for r in listed.collect()]
    run_silver_files(spark, files, lake, as_of=feeds.AS_OF)
    rows = fresh(spark, lake.silver("user_events"))
    return feeds.plain(rows.select("event_id", "user_id", "event_ts", "event_date"))


@query("rejected_events_table", ORACLE["rejection_records"])
def rejected_events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejection table after one batch."""
    lake = _new_lake(spark)
    run_silver_batch(spark, feeds.documents(spark, sf_dir), lake, feeds.AS_OF, on_unexpected="reject")
    rows = fresh(spark, lake.rejected).select(*REJECTED)
    return feeds.plain(rows.withColumn("has_raw", F.col("raw_event_json").isNotNull()).drop("raw_event_json"))
