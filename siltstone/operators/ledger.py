"""File status ledger: an append-only log of transitions per etag.

Every transition carries ``seq``, one above the etag's last, so the newest row
per etag is its current state. Of two runs that write the same number at once, the one
whose row sorts last has the file; each reads back what it holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.text import utc_day
from siltstone.operators.rank import first_by, latest_by
from siltstone.schemas import LEDGER

_COLUMNS = list(LEDGER)

# Ledger states.
IN_PROGRESS = "IN_PROGRESS"
VALIDATED = "VALIDATED"
REJECTED = "REJECTED"
IN_SILVER = "IN_PROGRESS(SILVER)"

LEASE_SECONDS = 60
#: How long a silver run may hold its files before another may take them over.
SILVER_LEASE_SECONDS = 3600


def current(log: DataFrame) -> DataFrame:
    """Newest transition per etag."""
    return latest_by(log, ["etag"], ["seq", "updated_at", "run_id", "status"])


def current_of(log: DataFrame, files: DataFrame) -> DataFrame:
    """``current`` for the etags in ``files`` only.

    The log keeps growing, a batch does not: its etags cut the log down before
    rows are ranked, without a shuffle while they are few enough to broadcast.
    """
    return current(log.join(files.select("etag").distinct(), "etag", "left_semi"))


def decide(
    files: DataFrame, log: DataFrame, as_of: Column, lease_seconds: int = LEASE_SECONDS
) -> DataFrame:
    """What to do with each file: ``etag, file_path, decision`` and the state seen.

    Files with the same etag are decided once, under the lowest path.
    """
    seen = current_of(log, files).select(
        "etag", "status", "lease_expiry", "created_at", "retry_count", "seq"
    )
    now = F.unix_seconds(as_of)
    in_progress = F.col("status") == IN_PROGRESS
    decision = (
        F.when(F.col("status").isNull(), "CLAIM")
        .when(F.col("status").isin(VALIDATED, REJECTED), "SKIP_DONE")
        .when(in_progress & (F.col("lease_expiry") > now), "SKIP_LEASED")
        .when(in_progress, "RECLAIM")
        .otherwise("SKIP_OTHER")
    )
    once = first_by(files.select("etag", "file_path"), ["etag"], ["file_path"])
    return once.join(seen, "etag", "left").select(
        "etag",
        "file_path",
        decision.alias("decision"),
        "status",
        "created_at",
        "retry_count",
        "seq",
        (now + lease_seconds).alias("new_lease"),
        as_of.alias("as_of"),
    )


def claims(decisions: DataFrame) -> DataFrame:
    """Log rows for the files claimed or reclaimed."""
    return decisions.filter("decision IN ('CLAIM', 'RECLAIM')").select(
        "etag",
        "file_path",
        F.lit(IN_PROGRESS).alias("status"),
        F.col("new_lease").alias("lease_expiry"),
        F.coalesce("created_at", "as_of").alias("created_at"),
        F.col("as_of").alias("updated_at"),
        F.coalesce(F.col("retry_count") + 1, F.lit(0)).alias("retry_count"),
        F.lit(None).cast("string").alias("run_id"),
        (F.coalesce("seq", F.lit(0)) + 1).cast("bigint").alias("seq"),
    )


def claim(
    files: DataFrame, log: DataFrame, as_of: Column, lease_seconds: int = LEASE_SECONDS
) -> DataFrame:
    """Log rows that claim the files free to be worked on."""
    return claims(decide(files, log, as_of, lease_seconds))


def transition(
    log: DataFrame, updates: DataFrame, expected: str, as_of: Column, held_by: str | None = None
) -> DataFrame:
    """Log rows for ``updates(etag, status[, run_id])`` on files in state ``expected``.

    Files in any other state are left alone, with ``held_by`` also those that another run
    holds by now. An etag reported more than once makes one row.
    """
    updates = first_by(updates, ["etag"], [c for c in updates.columns if c != "etag"])
    run_id = F.col("new_run") if "run_id" in updates.columns else F.col("run_id")
    wanted = updates.select(
        "etag",
        F.col("status").alias("new_status"),
        *([F.col("run_id").alias("new_run")] if "run_id" in updates.columns else []),
    )
    return (
        current_of(log, updates)
        .filter((F.col("status") == expected) & (F.lit(True) if held_by is None else F.col("run_id") == held_by))
        .join(wanted, "etag")
        .withColumns(
            {
                "status": F.col("new_status"),
                "updated_at": as_of,
                "run_id": run_id,
                "seq": F.col("seq") + 1,
            }
        )
        .select(*_COLUMNS)
    )


def _free(as_of: Column | None) -> Column:
    """Whether a silver run may take a file: it waits, or the lease of the run that has it is over."""
    waits = F.col("status") == VALIDATED
    if as_of is None:
        return waits
    return waits | ((F.col("status") == IN_SILVER) & (F.col("lease_expiry") <= F.unix_seconds(as_of)))


def start_silver(
    log: DataFrame, batch: DataFrame, run_id: str, as_of: Column, lease_seconds: int = SILVER_LEASE_SECONDS
) -> DataFrame:
    """Log rows that give the free files of ``batch(etag)`` to a silver run for a time.

    Taking a file over from a run whose lease is over counts as a retry.
    """
    taken_over = (F.col("status") == IN_SILVER).cast("int")
    return (
        current_of(log, batch)
        .filter(_free(as_of))
        .withColumns(
            {
                "status": F.lit(IN_SILVER),
                "lease_expiry": (F.unix_seconds(as_of) + lease_seconds).cast("bigint"),
                "updated_at": as_of,
                "retry_count": F.col("retry_count") + taken_over,
                "run_id": F.lit(run_id),
                "seq": F.col("seq") + 1,
            }
        )
        .select(*_COLUMNS)
    )


def held(log: DataFrame, batch: DataFrame, run_id: str) -> DataFrame:
    """The files of ``batch`` that a silver run holds: ``etag, retry_count, arrival_date``."""
    own = (F.col("status") == IN_SILVER) & (F.col("run_id") == run_id)
    return current_of(log, batch).filter(own).select("etag", "retry_count", utc_day(F.col("created_at")).alias("arrival_date"))


def pending(log: DataFrame, limit: int | None = 10, as_of: Column | None = None) -> DataFrame:
    """Files that wait for silver, oldest first; ``limit`` is the batch size.

    With ``as_of`` also those whose silver run has let its lease run out.
    """
    waiting = current(log).filter(_free(as_of))
    return waiting if limit is None else waiting.orderBy("created_at", "etag").limit(limit)


def file_results(metrics: DataFrame, run_id: str) -> DataFrame:
    """Metrics rows to ledger updates ``etag, status, run_id``."""
    return metrics.select(
        "etag", F.col("file_status").alias("status"), F.lit(run_id).alias("run_id")
    )


def reported_results(results: DataFrame, run_id: str) -> DataFrame:
    """``job_result`` rows back to ledger updates."""
    status = F.from_json("result", "status string")["status"]
    return results.select("etag", status.alias("status"), F.lit(run_id).alias("run_id"))
