"""File intake: notifications, classification, routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions import text as T

# File-name prefix to route.
ROUTE = {"order": "order_events", "payment": "payment_events", "user": "user_events"}
UNROUTED = "unrouted"
REJECTED_ROUTE = "rejected"

# Shapes of the queue messages.
_NOTICE = (
    "Records ARRAY<STRUCT<s3: STRUCT<bucket: STRUCT<name: STRING>, "
    "object: STRUCT<key: STRING, eTag: STRING>>>>"
)
_WORK = "file_path STRING, etag STRING"


def unnest_notifications(messages: DataFrame, body: str = "body") -> DataFrame:
    """Queue messages to one row per object: ``bucket, key, etag``."""
    records = F.explode(F.from_json(body, _NOTICE)["Records"])
    return messages.select(records.alias("record")).select(
        F.col("record.s3.bucket.name").alias("bucket"),
        F.col("record.s3.object.key").alias("key"),
        F.col("record.s3.object.eTag").alias("etag"),
    )


def decode_messages(messages: DataFrame, body: str = "body") -> DataFrame:
    """Processing messages to ``file_path, etag``."""
    return messages.select(F.from_json(body, _WORK).alias("work")).select("work.*")


def encode_messages(files: DataFrame) -> DataFrame:
    """``file_path, etag`` to processing messages."""
    return files.select(F.to_json(F.struct("file_path", "etag")).alias("body"))


def object_path(bucket: str = "bucket", key: str = "key") -> Column:
    """Path of a notified object."""
    return F.concat(F.lit("s3://"), F.col(bucket), F.lit("/"), F.col(key))


def route_of(path: Column) -> Column:
    """Route by the prefix of the file name."""
    name = T.base_name(path)
    route = F.lit(UNROUTED)
    for prefix, target in ROUTE.items():
        route = F.when(name.startswith(prefix), target).otherwise(route)
    return route


def classify_files(texts: DataFrame) -> DataFrame:
    """Adds ``etag`` where missing, ``route`` and the ledger ``status``.

    Files that are not one JSON object, or have an unknown name prefix, are
    REJECTED.
    """
    value = F.col("value")
    tag = T.content_tag(value)
    etag = F.coalesce("etag", tag) if "etag" in texts.columns else tag
    whole = T.is_intact(F.col("parsed"), value)
    route = F.when(whole, route_of(F.col("file_path"))).otherwise(REJECTED_ROUTE)
    fine = F.col("route").isin(*ROUTE.values())
    return (
        texts.withColumns({"etag": etag, "parsed": T.sealed(value)})
        .withColumn("route", route)
        .drop("parsed")
        .withColumn("status", F.when(fine, "VALIDATED").otherwise("REJECTED"))
    )
