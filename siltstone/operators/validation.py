"""From file text to judged events: one pass, one row per outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions import payload as P
from siltstone.functions import reasons as R
from siltstone.functions import text as T
from siltstone.operators.columns import computed_once, require_columns
from siltstone.schemas import CONTRACT, DOMAINS, SILVER

_HEADER = ("file_id", "domain", "source_system")
_ENVELOPE = ("event_id", "event_type", "source")
_EVENT_TYPE = (
    "struct<event_id:string,event_type:string,source:string,"
    "event_ts:string,ingest_ts:string,payload:variant>"
)
_DOCUMENT_TYPE = (
    "file_id:string,domain:string,source_system:string,created_at:string,"
    f"events:array<{_EVENT_TYPE}>"
)
_PAYLOAD_TEXT = tuple(
    dict.fromkeys(f for fields in CONTRACT.values() for f in fields if f != "amount")
)


def _mixed_events(value: Column) -> Column:
    """Events of a file whose list also holds something else than objects.

    The reader gives no list at all then. Read as variants, each element stands
    for itself; one that is no object becomes an event with only a payload.
    """
    elements = F.try_variant_get(F.try_parse_json(value), "$.events", "array<variant>")
    names = ("event_id", "event_type", "source", "event_ts", "ingest_ts")
    stray = F.struct(*[F.lit(None).cast("string").alias(n) for n in names], F.lit(0).alias("_"))
    return F.transform(
        elements,
        lambda e: F.coalesce(
            F.try_variant_get(e, "$", _EVENT_TYPE),
            stray.dropFields("_").withField("payload", e),
        ),
    )


def parse_containers(texts: DataFrame) -> DataFrame:
    """File text to one container row: header fields and events.

    ``texts`` has ``etag`` and ``value``. The schema is fixed and payloads are
    VARIANT, so a file's content never changes the types another file is read
    with. Text that is not one JSON object gives an empty container.
    """
    require_columns(texts, ["etag", "value"])
    value = F.col("value")
    sealed = texts.select("etag", "value", T.sealed(value, _DOCUMENT_TYPE).alias("parsed"))
    document = F.when(T.is_intact(F.col("parsed"), value), F.get("parsed", 0))
    read = computed_once(sealed, "document", document)
    listed = F.col("document.events")
    return read.select(
        "etag",
        "value",
        *[F.col(f"document.{name}") for name in _HEADER],
        T.iso_instant(F.col("document.created_at")).alias("created_at"),
        F.when(listed.isNotNull(), listed)
        .when(F.col("document").isNotNull(), _mixed_events(value))
        .alias("events"),
    )


def judge_containers(containers: DataFrame) -> DataFrame:
    """Adds the container stage's reason and, for rejected files, their text."""
    return containers.withColumn("container_reason", R.container_reason()).select(
        "etag",
        *_HEADER,
        "created_at",
        "events",
        "container_reason",
        F.when(F.col("container_reason").isNotNull(), F.col("value")).alias("container_json"),
    )


def open_events(containers: DataFrame) -> DataFrame:
    """Judged containers to event rows.

    A rejected container keeps one row without event, whose ``weight`` is the
    number of events it held; every other row weighs 1.
    """
    rejected = F.col("container_reason").isNotNull()
    closed = F.array(F.lit(None).cast(_EVENT_TYPE))
    weight = F.when(rejected, F.coalesce(F.size("events"), F.lit(0))).otherwise(1)
    opened = containers.select(
        "etag",
        *_HEADER,
        "created_at",
        "container_reason",
        "container_json",
        weight.cast("bigint").alias("weight"),
        F.explode(F.when(rejected, closed).otherwise(F.col("events"))).alias("event"),
    )
    return opened.select(
        "*",
        *[F.col(f"event.{name}") for name in _ENVELOPE],
        F.col("event.event_ts").alias("event_ts_text"),
        F.col("event.ingest_ts").alias("ingest_ts_text"),
        F.col("event.payload").alias("payload"),
    )


def read_payload(events: DataFrame) -> DataFrame:
    """Payload kind, fields outside the contract, and the typed payload fields."""
    payload, fields = F.col("payload"), F.col("payload_fields")
    return events.withColumn("payload_fields", P.as_map(payload)).select(
        *events.columns,
        P.kind(payload, fields).alias("payload_kind"),
        P.unexpected(F.col("event_type"), F.map_keys(fields)).alias("unexpected_fields"),
        *[P.field(payload, name).alias(name) for name in _PAYLOAD_TEXT],
        P.money(P.number(payload, "amount")).alias("amount"),
    )


def judge_events(events: DataFrame, as_of: Column, on_unexpected: str = "fail") -> DataFrame:
    """Event rows to final rows: silver columns, ``reason`` and ``raw_event_json``.

    The first stage that objects wins: container, envelope, type, payload,
    domain. Accepted rows have a null reason.
    """
    timed = read_payload(events).select(
        "*",
        T.iso_instant(F.col("event_ts_text")).alias("event_ts"),
        T.iso_instant(F.col("ingest_ts_text")).alias("ingest_ts"),
        as_of.alias("as_of"),
    )
    staged = timed.select(
        "*",
        R.envelope_reason().alias("envelope_reason"),
        R.type_reason().alias("type_reason"),
    )
    early = F.coalesce("container_reason", "envelope_reason", "type_reason")
    reason = F.coalesce(early, R.payload_reason(on_unexpected), R.domain_reason())
    judged = computed_once(staged, "reason", reason)
    raw = (
        F.when(F.col("reason").isNull(), F.lit(None).cast("string"))
        .when(F.col("container_reason").isNotNull(), F.col("container_json"))
        .when(F.coalesce("envelope_reason", "type_reason").isNotNull(), F.to_json("event"))
        .when(F.col("payload_kind") == "null", F.lit(None).cast("string"))
        .when(F.col("payload_kind") == "string", F.try_variant_get("event.payload", "$", "string"))
        .otherwise(P.as_text(F.col("payload")))
    )
    return judged.select(
        "etag",
        *_HEADER,
        "created_at",
        *_ENVELOPE,
        "event_ts",
        "ingest_ts",
        T.utc_day(F.col("event_ts")).alias("event_date"),
        *_PAYLOAD_TEXT,
        "amount",
        "weight",
        "as_of",
        "reason",
        raw.alias("raw_event_json"),
    )


def check_files(texts: DataFrame, as_of: Column, on_unexpected: str = "fail") -> DataFrame:
    """File text to judged rows; the whole of the silver checks."""
    containers = judge_containers(parse_containers(texts))
    return judge_events(open_events(containers), as_of, on_unexpected)


def accepted(judged: DataFrame, domain: str) -> DataFrame:
    """Accepted events of one domain, in the columns of its silver table."""
    if domain not in DOMAINS:
        raise ValueError(f"unknown domain {domain!r}")
    return judged.filter((F.col("event_type") == domain) & F.col("reason").isNull()).select(
        *SILVER[domain]
    )


def reject_hash(etag: str = "etag", event_id: str = "event_id") -> Column:
    """Hash of etag and event id; without an event id, of the etag alone."""
    return F.sha2(F.concat_ws("|", etag, event_id), 256)


def rejections(judged: DataFrame) -> DataFrame:
    """Rejected rows in the columns of the rejection table."""
    return judged.filter("reason IS NOT NULL").select(
        *_HEADER,
        "created_at",
        "etag",
        "event_id",
        "event_type",
        F.col("reason").alias("rejection_reason"),
        "raw_event_json",
        F.col("as_of").alias("rejection_ts"),
        T.utc_day(F.col("as_of")).alias("rejection_date"),
        reject_hash().alias("reject_hash"),
    )
