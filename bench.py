"""Time the headline queries; prints one JSON line.

Every query runs to a ``noop`` sink, so that all its columns are computed and
none are collected. ``silver_events_per_sec`` is the rate of one whole silver
batch (check, merge into three tables, rejections, metrics) over container
documents written beforehand.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from siltstone.queries import QUERIES, feeds
from siltstone.plans.silver import run_silver_batch
from siltstone.queries.runs import _new_lake
from siltstone.session import local_session, scratch_path

HEADLINE = (
    "fact_orders",
    "fact_payments",
    "dim_users",
    "payment_summary",
    "first_per_key",
    "insert_new",
    "container_rejections",
    "rejection_records",
    "first_delivery_order_events",
    "file_metrics",
    "file_classify",
    "ledger_claim",
    "ledger_finish",
    "combined_counts",
    "notification_unnest",
    "container_roundtrip",
    "cluster_rewrite",
    "changed_orders",
    "file_lifecycle",
    "silver_stream",
    "gold_refresh",
    "gold_update",
)
#: Queries of fewer seconds are timed three times; the median counts.
LONG = 5


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    feeds.load(spark, sf_dir, "nation").write.format("noop").mode("overwrite").save()

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    once("fact_orders")  # start-up, not counted
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        took = [once(name)]
        if took[0] < LONG:
            took += [once(name), once(name)]
        seconds[name] = round(median(took), 3)

    folder = scratch_path(spark, "documents")
    documents = feeds.documents(spark, sf_dir).drop("eid")
    documents.repartition(4 * spark.sparkContext.defaultParallelism).write.parquet(folder)
    start = time.perf_counter()
    metrics = run_silver_batch(
        spark, spark.read.parquet(folder), _new_lake(spark), feeds.AS_OF, on_unexpected="reject"
    )
    seconds["silver_batch"] = round(time.perf_counter() - start, 3)
    events = metrics.groupBy().sum("total_events").first()[0]

    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "silver_events_per_sec": round(events / seconds["silver_batch"]),
                "silver_events": events,
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
