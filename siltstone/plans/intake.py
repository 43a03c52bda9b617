"""Raw files to validated or rejected ones."""

from __future__ import annotations

from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.text import utc_day
from siltstone.operators import ledger as L
from siltstone.operators.files import classify_files
from siltstone.operators.ledger_store import ledger_log, record
from siltstone.plans.store import store_texts
from siltstone.schemas import Lake
from siltstone.session import cut_lineage, instant


def claimed_texts(classified: DataFrame, mine: DataFrame) -> DataFrame:
    """The texts of ``mine(etag, file_path, arrival_date)``, each once: queues deliver at least once.

    An etag is claimed under one path. So both are the key, as the join has dealt the texts
    by them, and the texts are not shuffled again.
    """
    held = classified.select("file_path", "etag", "value", "route", "status").join(mine, ["etag", "file_path"])
    return held.dropDuplicates(["etag", "file_path"])


def run_intake(
    spark: SparkSession,
    texts: DataFrame,
    lake: Lake = Lake(),
    as_of: datetime | str | None = None,
    lease_seconds: int = L.LEASE_SECONDS,
) -> DataFrame:
    """Claim new files, store their text by route and day of arrival, and record the outcome.

    Returns ``file_path, etag`` of the files that passed. Files done before, and
    copies of one content under several names, are skipped by etag, and a file
    delivered more than once counts once. A run that
    dies leaves its claims to expire; the next run after that takes the files
    again and stores only what is not stored yet.
    """
    now = instant(as_of)
    log = ledger_log(spark, lake)
    classified = classify_files(texts)
    names = classified.select("etag", "file_path")
    claimed = cut_lineage(L.claim(names, log, now, lease_seconds))
    record(spark, lake, claimed)

    arrived = utc_day(F.col("created_at")).alias("arrival_date")
    mine = claimed.select("etag", "file_path", arrived)
    held = claimed_texts(classified, mine)
    held = held.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        store_texts(spark, lake, held.drop("status"), mine)
        outcome = cut_lineage(held.select("etag", "file_path", "status"))
    finally:
        held.unpersist()
    done = L.transition(ledger_log(spark, lake), outcome, L.IN_PROGRESS, now)
    record(spark, lake, cut_lineage(done))
    return outcome.filter(F.col("status") == L.VALIDATED).select("file_path", "etag")
