"""Rejection rules: a code and the SQL predicate that earns it, per stage."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.schemas import DOMAINS

# The codes are matched by readers of the rejection table.
# Several codes of one stage are joined by "," in the order given here.
CONTAINER = {
    "MISSING_FILE_ID": "file_id IS NULL",
    "MISSING_DOMAIN": "domain IS NULL",
    "MISSING_SOURCE_SYSTEM": "source_system IS NULL",
    "MISSING_CREATION_TIME": "created_at IS NULL",
    "EMPTY_EVENTS": "events IS NULL OR size(events) = 0",
}

ENVELOPE = {
    "MISSING_EVENT_ID": "event_id IS NULL",
    "MISSING_EVENT_TYPE": "event_type IS NULL",
    "MISSING_EVENT_TIMESTAMP": "event_ts IS NULL",
    "MISSING_SOURCE": "source IS NULL",
    "MISSING_INGEST_TIMESTAMP": "ingest_ts IS NULL",
    "INGEST BEFORE EVENT_TIMESTAMP": "ingest_ts < event_ts",
    "EVENT_TIMESTAMP_IN_FUTURE": "event_ts > as_of",
}

PAYLOAD_KIND = {
    "PAYLOAD_IS_NULL": "payload_kind = 'null'",
    "PAYLOAD_IS_A_STRING": "payload_kind = 'string'",
    "PAYLOAD_IS_INVALID": "payload_kind = 'other'",
}

UNEXPECTED = {"UNEXPECTED_FIELD": "size(unexpected_fields) > 0"}

DOMAIN = {
    "MISSING_USER_ID": "event_type IN ('user_events', 'order_events') AND user_id IS NULL",
    "MISSING_PAYMENT_ID": "event_type = 'payment_events' AND payment_id IS NULL",
    "MISSING_ORDER_ID": "event_type IN ('order_events', 'payment_events') AND order_id IS NULL",
    "INVALID AMOUNT": "event_type IN ('order_events', 'payment_events') AND amount IS NULL",
}

DOMAIN_MISMATCH = "DOMAIN_EVENT_TYPE_MISMATCH"
UNKNOWN_TYPE = "INVALID_EVENT_TYPE"


def joined(rules: dict[str, str]) -> Column:
    """Codes of all rules that hold, joined by ","; null if none does."""
    hits = [F.when(F.expr(predicate), F.lit(code)) for code, predicate in rules.items()]
    return F.nullif(F.concat_ws(",", *hits), F.lit(""))


def container_reason() -> Column:
    return joined(CONTAINER)


def envelope_reason() -> Column:
    """Needs the timestamps parsed and an ``as_of`` column."""
    return joined(ENVELOPE)


def type_reason(valid_types: tuple[str, ...] = DOMAINS) -> Column:
    """Mismatch with the container's domain goes first, then the unknown type."""
    return F.when(F.col("domain") != F.col("event_type"), DOMAIN_MISMATCH).when(
        ~F.col("event_type").isin(*valid_types), UNKNOWN_TYPE
    )


def payload_reason(on_unexpected: str = "fail") -> Column:
    """Payload kind, then fields outside the contract.

    ``fail`` raises on the first such row, ``reject`` gives the row a code.
    """
    if on_unexpected == "reject":
        extra = joined(UNEXPECTED)
    elif on_unexpected == "fail":
        message = F.concat(
            F.lit("unexpected payload fields in "),
            F.col("event_type"),
            F.lit(": "),
            F.array_join("unexpected_fields", ","),
        )
        extra = F.when(
            F.expr(UNEXPECTED["UNEXPECTED_FIELD"]), F.raise_error(message).cast("string")
        )
    else:
        raise ValueError(f"on_unexpected must be 'fail' or 'reject', not {on_unexpected!r}")
    return F.coalesce(joined(PAYLOAD_KIND), extra)


def domain_reason() -> Column:
    """``amount`` is null unless it is a number >= 0 that fits the column."""
    return joined(DOMAIN)
