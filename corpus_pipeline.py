"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows that the stage before kept,
and returns a DataFrame; all but the last return the columns of ``docs``. ``run`` writes
every stage's result as Parquet in the shared folder and reads it again as the next
stage's documents.

Rows may repeat, lack any value or have further columns; those are kept as they are.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import cotrain, decontaminate, near_dup, packing, toxicity
from siltstone.llm.names import spare_prefix
from siltstone.llm.shipping import ship
from siltstone.session import scratch_path

#: Two stages are trained classifiers, so SQL cannot say the result.
ORACLE_SQL = None

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what the co-trained quality classifier holds good.

    It learns from ``labels`` of the given documents; where there are none, all stay.
    """
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judge = cotrain.fit(docs, labels)
    own = spare_prefix(docs)
    judged = cotrain.with_quality(docs, judge, prefix=own)
    return judged.filter(F.col(f"{own}good")).select(docs.columns)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose toxicity reaches the threshold of their language."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    net = toxicity.fit(docs, labels)
    score = f"{spare_prefix(docs)}toxicity"
    scored = toxicity.with_toxicity(docs, net, score_col=score)
    toxic = toxicity.over_threshold(net, F.col(score), F.col("lang"))
    return scored.filter(~toxic).select(docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: five-word shingles, 0.8."""
    ship(spark)
    found = near_dup.near_duplicates(docs, shingle=5, per_cent=80)
    return near_dup.one_per_group(docs, found)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in which a window of ten benchmark words occurs."""
    ship(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    own = spare_prefix(docs)
    found = decontaminate.benchmark_hits(docs, benchmark, window=10, prefix=own)
    return found.filter(F.col(f"{own}hit_words").isNull()).select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, in sequences of 2048 ids."""
    ship(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, size=2048)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the rows of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = scratch_path(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
    return docs
