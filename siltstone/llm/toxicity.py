"""Toxicity by a convolutional text classifier in numpy (operator 5).

A word is the sum of hashed embeddings of itself and of its first four, five and seven
bytes. Filters of one, two and three words run over the whole text, each keeps its largest
value, and a logistic layer weighs them. The first embedding axis starts from each
bucket's log odds in the training texts and the first filter reads it; the rest starts at
random; all of it is then trained by Adam through the max pooling, whose gradient reaches
one place per text and filter. Scores are calibrated to probabilities on texts kept out of
the training, all labelled rows but the sample. Thresholds are calibrated by language; the
score knows no language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.bytesets import ALNUM, Words, blocks, mixed, span_keys, texts_of
from siltstone.llm.fitting import best_threshold, calibration, in_sample, sigmoid

BUCKETS = 1 << 17
SIZE = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
HEADS = (4, 5, 7)
_PAD = max(WIDTHS)
#: Rows of each class, not trained on, with which a language gets a threshold of its own.
LEAST_OF_CLASS = 10
#: Steps to one unit of the network's answer in which rows are counted.
STEPS = 64


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Four bucket numbers per word, texts parted by padding rows, and where texts begin.

    Padding has bucket ``BUCKETS``, whose embedding is zero. A text is followed by as many
    rows of it as the widest filter spans.
    """
    words = Words(texts, ALNUM)
    keys = [words.keys]
    for n in HEADS:
        stop = np.minimum(words.stop, words.start + n)
        keys.append(mixed(span_keys(words.data, words.start, stop) + np.uint64(n)))
    place = np.arange(len(words)) + _PAD * words.of()
    ids = np.full((len(words) + _PAD * len(texts), len(keys)), BUCKETS, np.int32)
    for i, key in enumerate(keys):
        ids[place, i] = (key >> np.uint64(47)).astype(np.int32)
    return ids, words.first[:-1] + _PAD * np.arange(len(texts))


@dataclass
class Network:
    """Parameters of the classifier, its calibration and thresholds."""

    table: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    weights: np.ndarray
    shift: float
    slope: float = 1.0
    intercept: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5

    def embedded(self, ids: np.ndarray) -> np.ndarray:
        out = self.table[ids[:, 0]]
        for i in range(1, ids.shape[1]):
            out += self.table[ids[:, i]]
        return out

    def maps(self, x: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Each filter's value where it starts at a word or at the first padding row."""
        wide = np.concatenate((x, np.zeros((_PAD, x.shape[1]), x.dtype)))
        out = np.empty((len(x), len(WIDTHS) * FILTERS), np.float32)
        for k, (width, weights) in enumerate(zip(WIDTHS, self.filters)):
            part = out[:, k * FILTERS : (k + 1) * FILTERS]
            np.matmul(x, weights[0], out=part)
            for j in range(1, width):
                part += wide[j : j + len(x)] @ weights[j]
        ends = np.append(begin[1:], len(x))
        for back in range(1, _PAD):  # from here a filter would reach into the next text
            out[ends - back] = -np.inf
        return out

    def logits_of(self, ids: np.ndarray, begin: np.ndarray) -> np.ndarray:
        pooled = np.maximum.reduceat(self.maps(self.embedded(ids), begin), begin, axis=0)
        return np.maximum(pooled + self.bias, 0) @ self.weights + self.shift

    def logits(self, texts: list[bytes]) -> np.ndarray:
        out = np.empty(len(texts))
        for a, b in blocks(texts, 256 << 10):
            out[a:b] = self.logits_of(*features(texts[a:b]))
        return out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return sigmoid(self.slope * self.logits(texts) + self.intercept)


def _log_odds(ids: list[np.ndarray], y: np.ndarray, strength: float = 10.0) -> np.ndarray:
    """Shrunken log odds of each bucket by the texts it occurs in."""
    seen = np.zeros((2, BUCKETS + 1))
    for own, label in zip(ids, y):
        seen[int(label)][np.unique(own)] += 1
    total = np.maximum(np.array([(y == 0).sum(), (y == 1).sum()], float), 1)
    share = total / total.sum()
    clean, toxic = ((seen[k] + strength * share[k]) / total[k] for k in (0, 1))
    odds = np.clip(np.log(toxic / clean), -3, 3)
    odds[BUCKETS] = 0
    return odds


class _Adam:
    def __init__(self, rate: float):
        self.rate, self.moments, self.turn = rate, {}, 0

    def step(self, name: str, value: np.ndarray, gradient: np.ndarray, rows=None) -> None:
        m, v = self.moments.setdefault(name, (np.zeros_like(value), np.zeros_like(value)))
        at = slice(None) if rows is None else rows
        m[at] = 0.9 * m[at] + 0.1 * gradient
        v[at] = 0.99 * v[at] + 0.01 * gradient**2
        fix = np.sqrt(1 - 0.99**self.turn) / (1 - 0.9**self.turn)
        value[at] -= self.rate * fix * m[at] / (np.sqrt(v[at]) + 1e-6)


def train(texts: list[bytes], y: np.ndarray, **options) -> Network:
    """Fit the network to labelled texts (1: toxic)."""
    ids: list[np.ndarray] = []
    for a, b in blocks(texts):
        own, begin = features(texts[a:b])
        ids += np.split(own, begin[1:])
    return train_on(ids, y, **options)


def train_on(
    ids: list[np.ndarray], y: np.ndarray, epochs: int = 4, batch: int = 128, seed: int = 5
) -> Network:
    """``train`` on texts given by their ``features``."""
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.1, (BUCKETS + 1, SIZE)).astype(np.float32)
    table[:, 0] = _log_odds(ids, y)
    table[BUCKETS] = 0
    filters = [rng.normal(0, 0.2, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS]
    for weights in filters:
        weights[0, :, 0] = 0
        weights[:, 0, 0] = 0.3
    bias = np.full(len(WIDTHS) * FILTERS, -0.5, np.float32)
    out = np.full(len(bias), 0.1, np.float32)
    shift = np.array([np.log((y.sum() + 1) / (len(y) - y.sum() + 1))], np.float32)
    net = Network(table, filters, bias, out, float(shift[0]))
    adam = _Adam(0.01)
    for _ in range(epochs):
        order = rng.permutation(len(ids))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            adam.turn += 1
            _step(net, adam, [ids[i] for i in chosen], y[chosen], shift)
    return net


def _step(net: Network, adam: _Adam, ids: list[np.ndarray], y: np.ndarray, shift: np.ndarray) -> None:
    flat = np.concatenate(ids)
    length = np.array([len(i) for i in ids])
    begin = np.cumsum(length) - length
    x = net.embedded(flat)
    maps = net.maps(x, begin)
    pooled = np.maximum.reduceat(maps, begin, axis=0)
    same = maps == np.repeat(pooled, length, axis=0)
    place = np.empty(pooled.shape, np.int64)
    row, column = np.nonzero(same)
    text = np.searchsorted(begin, row, side="right") - 1
    place[text[::-1], column[::-1]] = row[::-1]  # the first of equal values
    hidden = pooled + net.bias
    active = np.maximum(hidden, 0)
    p = sigmoid(active @ net.weights + shift[0])
    error = ((p - y) / len(y)).astype(np.float32)
    back = error[:, None] * net.weights[None, :] * (hidden > 0)
    wide = np.concatenate((x, np.zeros((_PAD, SIZE), np.float32)))
    words: list[np.ndarray] = []
    pushes: list[np.ndarray] = []
    for k, (width, weights) in enumerate(zip(WIDTHS, net.filters)):
        own, at = back[:, k * FILTERS : (k + 1) * FILTERS], place[:, k * FILTERS : (k + 1) * FILTERS]
        gradient = np.empty_like(weights)
        for j in range(width):
            gradient[j] = np.einsum("tfd,tf->df", wide[at + j], own)
            inside = (at + j < len(x)) & (own != 0)
            words.append((at + j)[inside])
            pushes.append((own[:, :, None] * weights[j].T[None])[inside])
        adam.step(f"filter{k}", weights, gradient + 1e-4 * weights)
    adam.step("bias", net.bias, back.sum(axis=0))
    adam.step("out", net.weights, active.T @ error + 1e-4 * net.weights)
    adam.step("shift", shift, error.sum(keepdims=True))
    net.shift = float(shift[0])
    word, push = np.concatenate(words), np.concatenate(pushes)
    bucket = flat[word].ravel()
    push = np.repeat(push, flat.shape[1], axis=0)
    rows, inverse = np.unique(bucket, return_inverse=True)
    total = np.zeros((len(rows), SIZE), np.float32)
    np.add.at(total, inverse, push)
    total[rows == BUCKETS] = 0
    adam.step("table", net.table, total, rows)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learn_from: Column | None = None,
    sample: int = 8000,
    sample_chars: int = 32_000_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    label_col: str = "toxic",
) -> Network:
    """Train on about ``sample`` labelled rows (``learn_from`` restricts them), calibrate on the rest.

    The sample is smaller if its texts would hold more than about ``sample_chars`` characters.
    Every text is scored once where it is read; the scores, not the texts, meet the labels.

    A fifth of the rows, chosen by a hash of the id, is never trained on. All labelled rows
    that were not trained on give the calibration and the thresholds, by counts of their
    scores. A language with fewer than ``LEAST_OF_CLASS`` of them of either class has the
    common threshold. Rows without a label are left out. Without any, or with one class
    only, the network answers with the share of that class.
    """
    known = labels.filter(F.col(label_col).isNotNull())
    if learn_from is not None:
        known = known.filter(learn_from)
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("double").alias("label"))
    texts = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(lang_col).alias("lang")
    )
    sizes = texts.select("id", F.length("text").alias("chars")).join(known, "id")
    total = sizes.agg(
        F.avg("label").alias("rate"), F.min("label").alias("a"), F.max("label").alias("b"), F.avg("chars").alias("chars")
    ).first()
    if total.rate is None or total.a == total.b:
        return _constant(float(total.rate or 0.0))
    sample = min(sample, int(sample_chars / max(total.chars, 1.0)) + 1)
    fifth = F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(5)) == 0
    known = known.withColumn("learned", in_sample(known, F.col("id"), sample) & ~fifth)
    ids, y = _training_rows(texts, known.filter("learned").select("id", "label"))
    if not len(y):
        return _constant(float(total.rate))
    net = train_on(ids, y)
    del ids
    counts = _score_counts(texts, known.filter("NOT learned").select("id", "label"), net)
    logits, truth, number = (counts[c].to_numpy(float) for c in ("step", "label", "n"))
    logits /= STEPS
    net.slope, net.intercept = calibration(logits, truth, number)
    scores = sigmoid(net.slope * logits + net.intercept)
    net.threshold = best_threshold(scores, truth, number=number)
    for name, at in counts.groupby("lang").indices.items():
        if all(number[at][truth[at] == c].sum() >= LEAST_OF_CLASS for c in (0, 1)):
            net.thresholds[str(name)] = best_threshold(scores[at], truth[at], net.threshold, number[at])
    return net


def _constant(rate: float) -> Network:
    net = train([b""], np.zeros(1), epochs=0)
    net.weights[:] = 0
    net.shift = float(np.log((rate + 1e-3) / (1 - rate + 1e-3)))
    return net


def _score_counts(texts: DataFrame, known: DataFrame, net: Network) -> pd.DataFrame:
    """Labelled rows by language, label and the network's answer in whole steps."""
    sent = texts.sparkSession.sparkContext.broadcast(net)
    kind = texts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = np.rint(np.clip(sent.value.logits(texts_of(batch.column(2))), -40, 40) * STEPS)
            columns = [batch.column(0), batch.column(1), pa.array(step.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "lang", "step"])

    held = texts.filter("id IS NOT NULL").select("id", F.coalesce("lang", F.lit("")).alias("lang"), "text")
    steps = held.mapInArrow(run, f"id {kind}, lang string, step int")
    counts = steps.join(known, "id").groupBy("lang", "label", "step").agg(F.count(F.lit(1)).alias("n"))
    return counts.toPandas().sort_values(["lang", "label", "step"], ignore_index=True)


def _training_rows(texts: DataFrame, chosen: DataFrame) -> tuple[list[np.ndarray], np.ndarray]:
    """``features`` and labels of the chosen rows, by id and content.

    The chosen ids, no more than the sample allows, are sent to the texts, whose features are
    made where they are read.
    """
    spark = texts.sparkSession
    local = spark.createDataFrame([tuple(r) for r in chosen.collect()], chosen.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(1))
            for a, b in blocks(texts):
                ids, begin = features(texts[a:b])
                made = pa.array([i.tobytes() for i in np.split(ids, begin[1:])], pa.binary())
                kept = [batch.column(i).slice(a, b - a) for i in (0, 2)]
                yield pa.RecordBatch.from_arrays([*kept, made], ["id", "label", "ids"])

    kind = texts.schema["id"].dataType.simpleString()
    rows = texts.join(F.broadcast(local), "id").select("id", "text", "label")
    got = rows.mapInArrow(run, f"id {kind}, label double, ids binary").toArrow()
    raw, names = got.column("ids").to_pylist(), got.column("id").to_pylist()
    order = sorted(range(len(raw)), key=lambda i: (names[i], raw[i]))
    y = got.column("label").to_numpy()[order] if order else np.zeros(0)
    return [np.frombuffer(raw[i], np.int32).reshape(-1, 1 + len(HEADS)) for i in order], y


def with_toxicity(docs: DataFrame, net: Network, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the calibrated probability of being toxic, in ``score_col``.

    Whole texts are scored row by row in the tasks that read them; a null or empty text
    gets the score of no words. An input column named ``score_col`` is replaced.
    """
    out = docs.drop(score_col)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in out.schema] + [T.StructField(score_col, T.DoubleType())])
    sent = docs.sparkSession.sparkContext.broadcast(net)
    at = out.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(sent.value.scores(texts_of(batch.column(at))), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, score_col])

    return out.mapInArrow(run, schema)


def over_threshold(net: Network, score: Column, lang: Column) -> Column:
    """Whether a score reaches its language's threshold (the common one for others)."""
    limit = F.lit(net.threshold)
    for name, own in net.thresholds.items():
        limit = F.when(F.coalesce(lang, F.lit("")) == name, F.lit(own)).otherwise(limit)
    return score >= limit
