"""How the documents that the queries check are made."""

from __future__ import annotations

import importlib
import json

import pytest

from siltstone.queries import feeds

TYPES = ("signup", "purchase", "error", "view", "click")


def folder_of(spark, tmp_path, ids):
    rows = [(i, f"2024-01-0{i % 9 + 1} 10:00:00", TYPES[i % 5], i % 7, i / 4) for i in ids]
    df = spark.createDataFrame(rows, "event_id bigint, ts string, event_type string, user_id bigint, value double")
    df.selectExpr("* EXCEPT (ts)", "CAST(ts AS TIMESTAMP_NTZ) AS ts").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def test_documents_are_spread_by_their_number(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(feeds, "DOCUMENTS_A_TASK", 10)
    docs = feeds.documents(spark, folder_of(spark, tmp_path, range(95)))
    assert docs.rdd.getNumPartitions() == 10  # not merged to a task a core
    for row in docs.collect():
        events = json.loads(row.value).get("events")
        planted = None if row.eid % 113 == 6 else 0 if row.eid % 13 == 0 else row.eid % 4 + 1
        assert (None if events is None else len(events)) == planted


def test_no_documents(spark, tmp_path):
    assert feeds.documents(spark, folder_of(spark, tmp_path, [])).count() == 0


def test_half_of_the_files_has_a_small_plan(spark, tmp_path, monkeypatch):
    """The choice by text is not pushed into the making of the text."""
    from siltstone.queries import runs

    seen = []

    def stop(spark, texts, *rest):
        seen.append(texts)
        raise InterruptedError

    monkeypatch.setattr(runs, "run_intake", stop)
    with pytest.raises(InterruptedError):
        runs.ledger_folded(spark, folder_of(spark, tmp_path, range(30)))
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 2000 and 0 < seen[0].count() < 30


@pytest.mark.parametrize(
    "module, name, step",
    [
        ("runs", "arrival_routing", "run_intake"),
        ("runs", "silver_takeover", "run_intake"),
        ("runs", "intake_duplicates", "run_intake"),
        ("runs", "file_lifecycle", "run_intake"),
        ("runs", "silver_batch", "run_silver_batch"),
        ("runs", "silver_replay", "run_silver_batch"),
        ("runs", "silver_indexed", "run_silver_batch"),
        ("star", "gold_from_files", "run_silver_batch"),
    ],
)
def test_documents_read_more_than_once_are_made_once(spark, tmp_path, monkeypatch, module, name, step):
    queries = importlib.import_module(f"siltstone.queries.{module}")
    seen = []

    def stop(spark, texts, *rest, **options):
        seen.append(texts)
        raise InterruptedError

    monkeypatch.setattr(queries, step, stop)
    with pytest.raises(InterruptedError):
        getattr(queries, name)(spark, folder_of(spark, tmp_path, range(130)))
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 2000 and "Repartition" not in plan and seen[0].count() > 0
