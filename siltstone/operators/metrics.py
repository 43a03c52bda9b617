"""Per-file counts and status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def file_status(total: str = "total_events", rejected: str = "rejected_events") -> Column:
    """No valid event fails the file, no rejected one makes it a success."""
    # File states written to the ledger.
    return (
        F.when(F.col(total) == F.col(rejected), "FAILED(SILVER)")
        .when(F.col(rejected) == 0, "SUCCESS(SILVER)")
        .otherwise("PARTIAL_SUCCESS(SILVER)")
    )


def with_status(counts: DataFrame) -> DataFrame:
    """Counts per file to the columns of the metrics table."""
    return counts.select(
        "etag",
        "total_events",
        "rejected_events",
        (F.col("total_events") - F.col("rejected_events")).alias("valid_events"),
        file_status().alias("file_status"),
    )


def file_metrics(judged: DataFrame) -> DataFrame:
    """Metrics of judged rows in one aggregation.

    Every file has a row there, also one without events, so no file list is
    joined in. A rejected container counts as all the events it held.
    """
    turned_down = F.when(F.col("reason").isNotNull(), F.col("weight")).otherwise(0)
    return with_status(
        judged.groupBy("etag").agg(
            F.sum("weight").alias("total_events"), F.sum(turned_down).alias("rejected_events")
        )
    )


def count_per_file(rows: DataFrame, name: str, key: str = "etag") -> DataFrame:
    """Row count per file."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def combine_counts(files: DataFrame, totals: DataFrame, rejected: DataFrame) -> DataFrame:
    """Metrics from separate counts; files missing from a count have 0 there."""
    counts = files.select("etag").join(totals, "etag", "left").join(rejected, "etag", "left")
    return with_status(counts.fillna(0, ["total_events", "rejected_events"]))


def job_result(metrics: DataFrame) -> DataFrame:
    """Metrics as reported to a caller: one JSON text per file."""
    report = F.struct(
        F.col("total_events").alias("total"),
        F.col("valid_events").alias("valid"),
        F.col("rejected_events").alias("rejected"),
        F.col("file_status").alias("status"),
    )
    return metrics.select("etag", F.to_json(report).alias("result"))
