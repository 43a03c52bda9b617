"""Registered corpus queries against DuckDB, and the pipeline against plain Python."""

import os
import sys
from pathlib import Path

import duckdb
import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parents[1])]
import corpus_pipeline  # noqa: E402
from helpers import ODD_COLUMNS, alnum_words, components, no_docs, odd_docs, shingle_set  # noqa: E402
from oracle import compare  # noqa: E402
from siltstone.llm import cotrain, queries, toxicity  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_against_duckdb(spark, con, name):
    compare(queries.QUERIES[name](spark, SF), con, queries.ORACLE[name])


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5


def test_pipeline_by_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = sorted(docs.collect())
    judge = cotrain.fit(docs, labels)
    args = [[r[i] for r in rows] for i in (3, 2, 4)]
    good = judge.scores([(r.text or "").encode() for r in rows], *args)[2] >= judge.threshold
    rows = [r for r, g in zip(rows, good) if g]
    left = spark.createDataFrame(rows, docs.schema)
    net = toxicity.fit(left, labels)
    score = net.scores([(r.text or "").encode() for r in rows])
    rows = [r for r, s in zip(rows, score) if s < net.thresholds.get(r.lang, net.threshold)]
    named = components({r.doc_id: shingle_set(r.text, 5) for r in rows})
    rows = [r for r in rows if named[r.doc_id] == r.doc_id]
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        own = alnum_words(r.text)
        m = min(10, len(own))
        windows |= {tuple(own[i : i + m]) for i in range(len(own) - m + 1 if m else 0)}
    sizes = {len(w) for w in windows}
    clean = []
    for r in rows:
        own = alnum_words(r.text)
        if not any(tuple(own[i : i + m]) in windows for m in sizes for i in range(len(own) - m + 1)):
            clean.append(r.doc_id)
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted({r.doc_id for r in got}) == sorted(clean)
    assert 0 < len(clean) < docs.count()


@pytest.mark.parametrize("stage", range(4))
def test_stages_keep_columns(spark, stage):
    name, run = corpus_pipeline.STAGES[stage]
    docs = odd_docs(spark)
    out = run(spark, docs, SF)
    assert out.columns == ODD_COLUMNS.replace(" bigint", "").replace(" string", "").split(", "), name
    kept, given = [tuple(r) for r in out.collect()], [tuple(r) for r in docs.collect()]
    assert all(r in given for r in kept)
    assert run(spark, no_docs(spark), SF).count() == 0


def test_last_stage_of_odd_rows(spark):
    assert corpus_pipeline.STAGES[4][1](spark, odd_docs(spark), SF).count() > 0
