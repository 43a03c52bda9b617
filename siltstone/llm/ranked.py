"""Ranked lexical search, term at a time with limited accumulators (operator 11).

1. One pass over the texts writes the postings of the queries' terms, one row per block of
   texts: for each term the texts that hold it and how often, and every text's length.
2. Spark adds up document frequencies and lengths from these rows.
3. Every block is ranked by itself, all queries against it. A query's terms are taken from
   the rarest on. A term's bound is its largest contribution in the block; once the bounds
   of the terms still to come cannot lift a new text to the k-th partial score (of this
   block, or the k-th score of the blocks before it), no accumulator is made any more, and
   the later terms only add to those that exist, exactly. A task passes on k rows a query.

Queries go to the tasks in passes of bounded size. All numbers are 64-bit integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from siltstone.llm.bytesets import ALNUM, blocks, texts_of
from siltstone.llm.lexicon import Lexicon, cut_words
from siltstone.session import scratch_path

#: Characters of queries that are searched for in one pass over the texts.
PASS_CHARS = 2_000_000
#: Bytes of text in a block of postings.
INDEX_BLOCK = 8 << 20

_INDEX = (
    "ids array<bigint>, sizes binary, terms array<int>, found array<bigint>, place binary, "
    "tf binary, n_texts bigint, n_terms bigint"
)


class Queries(NamedTuple):
    """Queries of one pass: their ids, the numbers of their terms, and the terms."""

    ids: list[Any]
    terms: list[np.ndarray]
    lexicon: Lexicon


def _passes(queries: DataFrame, id_col: str, text_col: str) -> Iterator[Queries]:
    """Queries by id, rows of one id together, in passes of bounded size."""
    rows = queries.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.filter("text IS NOT NULL")
    held = rows.select(F.sum(F.length("text") + 1)).first()[0] or 0
    passes = int(held // PASS_CHARS) + 1
    for i in range(passes):
        texts: dict[Any, list[bytes]] = {}
        for row in rows.filter(F.pmod(F.xxhash64("id"), F.lit(passes)) == i).collect():
            texts.setdefault(row.id, []).append(row.text.encode())
        ids = sorted(texts, key=repr)
        cut = cut_words([b" ".join(texts[i]) for i in ids], ALNUM)
        words = [cut.word(j) for j in range(len(cut.start))]
        number: dict[bytes, int] = {}
        for word in words:
            number.setdefault(word, len(number))
        own = np.array([number[w] for w in words], np.int64)
        terms = [np.unique(own[a:b]) for a, b in zip(cut.first, cut.first[1:])]
        if number:
            yield Queries(ids, terms, Lexicon(list(number)))


def postings(texts: list[bytes], lexicon: Lexicon) -> tuple[np.ndarray, ...]:
    """Term count of each text, and ``term, text, tf`` of the lexicon's words, by term and text."""
    sizes, parts = [], []
    for a, b in blocks(texts):
        cut = cut_words(texts[a:b], ALNUM)
        sizes.append(np.diff(cut.first))
        term = lexicon.find(cut.data, cut.start, cut.stop).astype(np.int64)
        known = np.flatnonzero(term >= 0)
        own = (cut.of()[known] + a) + term[known] * len(texts)
        parts.append(np.unique(own, return_counts=True))
    if not parts:
        return np.empty(0, np.int64), *[np.empty(0, np.int64)] * 3
    pair, tf = (np.concatenate(p) for p in zip(*parts))  # a text lies in one block: pairs are unique
    order = np.argsort(pair, kind="stable")
    term, place = np.divmod(pair[order], len(texts))
    return np.concatenate(sizes), term, place, tf[order]


def _one_list(values: pa.Array) -> pa.Array:
    """``values`` as the list of a single row."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _index(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Blocks of postings of ``id, text`` rows; texts without a term are left out."""
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(1))
            for a, b in blocks(texts, INDEX_BLOCK):
                sizes, term, place, tf = postings(texts[a:b], sent.value)
                terms, first = np.unique(term, return_index=True)
                found = np.diff(np.append(first, len(term)))
                columns = {
                    "ids": _one_list(batch.column(0).slice(a, b - a)),
                    "sizes": pa.array([sizes.astype(np.int32).tobytes()], pa.binary()),
                    "terms": _one_list(pa.array(terms, pa.int32())),
                    "found": _one_list(pa.array(found, pa.int64())),
                    "place": pa.array([place.astype(np.int32).tobytes()], pa.binary()),
                    "tf": pa.array([tf.astype(np.int32).tobytes()], pa.binary()),
                    "n_texts": pa.array([int((sizes > 0).sum())], pa.int64()),
                    "n_terms": pa.array([int(sizes.sum())], pa.int64()),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return docs.mapInArrow(run, _INDEX)


class Weights(NamedTuple):
    """Corpus numbers that a score needs; ``terms`` of each query run from the rarest on."""

    weight: np.ndarray
    n_texts: int
    n_terms: int
    terms: list[np.ndarray]
    k: int


def _weights(index: DataFrame, queries: Queries, k: int) -> Weights:
    total = index.agg(F.sum("n_texts").alias("n"), F.sum("n_terms").alias("l")).first()
    each = index.select(F.explode(F.arrays_zip("terms", "found")).alias("t"))
    rows = each.groupBy("t.terms").agg(F.sum("t.found").alias("df")).collect()  # a row per query term
    df = np.zeros(queries.lexicon.size, np.int64)
    for row in rows:
        df[row.terms] = row.df
    n = total.n or 0
    weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    ranked = [t[np.lexsort((t, df[t]))] for t in queries.terms]
    return Weights(weight, n, total.l or 0, ranked, k)


class Block:
    """One block's postings with every posting's contribution to a score."""

    def __init__(self, sizes, terms, found, place, tf, weights: Weights):
        self.texts = len(sizes)
        self.first = np.concatenate(([0], np.cumsum(found)))
        self.place = place.astype(np.int64)
        tf = tf.astype(np.int64)
        m = 10 + (90 * sizes.astype(np.int64) * weights.n_texts) // max(weights.n_terms, 1)
        part = (1_000_000_000 * tf) // (1000 * tf + 8 * m[self.place])
        self.part = np.repeat(weights.weight[terms], found) * part
        self.bound = np.maximum.reduceat(self.part, self.first[:-1]) if len(terms) else self.part
        self.slot = np.full(len(weights.weight), -1, np.int64)
        self.slot[terms] = np.arange(len(terms))

    def best(self, terms: np.ndarray, k: int, reached: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the texts that may be among the ``k`` best of a query.

        ``terms`` run from the rarest on; texts below ``reached`` need not be found. All
        texts that tie with the k-th are given.
        """
        own = self.slot[terms]
        own = own[own >= 0]
        none = np.empty(0, np.int64)
        if not len(own):
            return none, none
        ahead = np.cumsum(self.bound[own][::-1])[::-1]  # what a text first met here can still get
        if ahead[0] < reached:
            return none, none
        score = np.zeros(self.texts, np.int64)
        made = np.zeros(self.texts, bool)
        still_open = True
        for nth, term in enumerate(own):
            at = self.place[self.first[term] : self.first[term + 1]]
            part = self.part[self.first[term] : self.first[term + 1]]
            if still_open and nth:
                partial = score[made]
                if len(partial) >= k:
                    reached = max(reached, int(np.partition(partial, len(partial) - k)[len(partial) - k]))
                still_open = ahead[nth] >= reached
            if still_open:
                made[at] = True
                score[at] += part
            else:
                kept = made[at]
                score[at[kept]] += part[kept]
        places = np.flatnonzero(score > 0)
        if len(places) > k:
            least = np.partition(score[places], len(places) - k)[len(places) - k]
            places = places[score[places] >= least]
        return places, score[places]


class _Leaders:
    """The ``k`` best ``(score, id)`` of a query so far; equal scores by id, null ids last."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.id = np.empty(0, np.int64), np.empty(0, np.int64)
        self.nameless = np.empty(0, bool)

    def reached(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.k else 0

    def add(self, score: np.ndarray, ids: np.ndarray, nameless: np.ndarray) -> None:
        score, ids = np.concatenate((self.score, score)), np.concatenate((self.id, ids))
        nameless = np.concatenate((self.nameless, nameless))
        order = np.lexsort((ids, nameless, -score))[: self.k]
        self.score, self.id, self.nameless = score[order], ids[order], nameless[order]


def _ranked(index: DataFrame, weights: Weights, ids: list[Any], id_type: T.DataType) -> DataFrame:
    """The best rows of every query in every task: ``item_id, doc_id, score``."""
    sent = index.sparkSession.sparkContext.broadcast((weights, ids))
    name_type = to_arrow_type(id_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, names = sent.value
        leaders = [_Leaders(weights.k) for _ in names]
        for batch in batches:
            for row in batch.to_pylist():
                ids = pa.array(row["ids"], pa.int64())
                nameless = ids.is_null().to_numpy(zero_copy_only=False)
                ids = ids.fill_null(0).to_numpy()
                block = Block(
                    np.frombuffer(row["sizes"], np.int32),
                    np.array(row["terms"], np.int64),
                    np.array(row["found"], np.int64),
                    np.frombuffer(row["place"], np.int32),
                    np.frombuffer(row["tf"], np.int32),
                    weights,
                )
                for lead, terms in zip(leaders, weights.terms):
                    at, score = block.best(terms, weights.k, lead.reached())
                    if len(at):
                        lead.add(score, ids[at], nameless[at])
        for name, lead in zip(names, leaders):
            if len(lead.score):
                columns = [
                    pa.array([name] * len(lead.score), name_type),
                    pa.array(lead.id, pa.int64(), mask=lead.nameless),
                    pa.array(lead.score, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["item_id", "doc_id", "score"])

    narrow = index.select("ids", "sizes", "terms", "found", "place", "tf")
    return narrow.mapInArrow(run, _found_schema(id_type))


def _found_schema(id_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("item_id", id_type),
            T.StructField("doc_id", T.LongType()),
            T.StructField("score", T.LongType()),
        ]
    )


def search(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The ``k`` best texts of every query: ``item_id, rank, doc_id, score``.

    A text's score is the sum, over the query's distinct terms, of the term's weight times
    its saturated frequency, in whole numbers; only scores above 0 count. Equal scores are
    ordered by id, null ids last; repeated rows rank one by one. A null text has no terms
    and is not counted; a query without terms has no rows; rows of one query id are one
    query. Ids of texts are integers. Further columns of either side are ignored, and
    empty tables give no rows.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "ranked")
    narrow = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    narrow = narrow.filter("text IS NOT NULL")
    id_type = queries.schema[item_col].dataType
    found = spark.createDataFrame([], _found_schema(id_type))
    for nth, own in enumerate(_passes(queries, item_col, item_text_col)):
        _index(narrow, own.lexicon).write.parquet(f"{path}/{nth}")
        index = spark.read.schema(_INDEX).parquet(f"{path}/{nth}")
        found = found.union(_ranked(index, _weights(index, own, k), own.ids, id_type))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
