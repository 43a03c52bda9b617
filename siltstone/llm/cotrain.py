"""Page quality by co-training two views (operator 9).

The content view of a document is the bag of its words, word ends and immediate
repetitions, read by a logistic model over hashed buckets. The metadata view never reads a
word: it has the document's source, language and length and the counts of lines, capitals,
signs and digits that describe a page's layout. Each view is trained on the labelled
sample; then, round after round, each hands its surest judgements of unlabelled documents
to the other as extra labels: all of them are scored, and
the other's new rows are drawn from the surest. At last both are calibrated on all labelled
rows that neither was trained on, and a logistic model of the two calibrated scores decides.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.bytesets import SPACED, Words, blocks, joined, mixed, span_keys, texts_of
from siltstone.llm.fitting import best_threshold, calibration, in_sample, logistic, sigmoid
from siltstone.session import scratch_path

BUCKETS = 1 << 15
SOURCES = 32
LANGS = 16
#: Steps to one unit of a view's answer in which rows are counted.
STEPS = 16
_WIDTH = SOURCES + LANGS + 1  # the metadata that is not layout
_SIGNS = np.zeros(256, bool)
_SIGNS[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


def content(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each text's content features, and where texts begin (one entry more)."""
    words = Words(texts, SPACED)
    n, of = len(words), words.of()
    end = span_keys(words.data, np.maximum(words.start, words.stop - 2), words.stop)
    again = np.zeros(n, np.uint64)
    again[1:] = (words.keys[1:] == words.keys[:-1]) & (of[1:] == of[:-1])
    ids = np.empty((n, 3), np.int32)
    ids[:, 0] = words.keys >> np.uint64(49)
    ids[:, 1] = mixed(end + np.uint64(1)) >> np.uint64(49)
    ids[:, 2] = mixed(again + np.uint64(7)) >> np.uint64(49)
    return ids.ravel(), words.first * 3


def layout(texts: list[bytes]) -> np.ndarray:
    """Counts that describe each page: lines, capitals, signs, digits, blanks, in shares."""
    data, begin = joined(texts)
    kinds = (
        data == 0x0A,
        (data >= 0x41) & (data <= 0x5A) | (data == 0xC3),
        _SIGNS[data],
        (data >= 0x30) & (data <= 0x39),
        SPACED[data],
    )
    size = np.diff(begin) - 1.0
    counts = [np.add.reduceat(k.astype(np.int64), begin[:-1]) for k in kinds]
    counts[4] = counts[4] - 1  # the closing mark
    share = [c / np.maximum(size, 1) for c in counts]
    shape = [np.log1p(size), np.log1p(counts[0]), np.log1p(size / (counts[0] + 1.0))]
    return np.column_stack([*shape, *share, *(np.sqrt(s) for s in share)])


def _slot(name: str | None, size: int) -> int:
    return zlib.crc32((name or "").encode()) % size


def metadata(texts: list[bytes], sources: list, langs: list, lengths: list) -> np.ndarray:
    """The metadata view's matrix; a null length counts as zero."""
    head = np.zeros((len(texts), _WIDTH))
    for i, (source, lang, length) in enumerate(zip(sources, langs, lengths)):
        head[i, _slot(source, SOURCES)] = 1
        head[i, SOURCES + _slot(lang, LANGS)] = 1
        head[i, -1] = np.log1p(max(length or 0, 0))
    return np.column_stack((head, layout(texts)))


def _means(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    return (total[first[1:]] - total[first[:-1]]) / np.maximum(np.diff(first), 1)


class ContentModel:
    """Logistic model of the mean bucket weight of a text."""

    def __init__(self) -> None:
        self.weights = np.zeros(BUCKETS, np.float32)
        self.shift = 0.0

    def fit(self, ids: list[np.ndarray], y: np.ndarray, epochs: int = 12, seed: int = 2) -> None:
        rng = np.random.default_rng(seed)
        grown = np.full(BUCKETS, 1e-3)
        for _ in range(epochs):
            order = rng.permutation(len(ids))
            for at in range(0, len(order), 64):
                chosen = order[at : at + 64]
                flat = np.concatenate([ids[i] for i in chosen])
                length = np.array([len(ids[i]) for i in chosen])
                first = np.concatenate(([0], np.cumsum(length)))
                error = sigmoid(_means(self.weights[flat], first) + self.shift) - y[chosen]
                push = np.repeat(error / np.maximum(length, 1), length)
                gradient = np.bincount(flat, push, BUCKETS)
                grown += gradient**2
                self.weights -= (0.5 * gradient / np.sqrt(grown)).astype(np.float32)
                self.shift -= 0.05 * float(error.mean())

    def logits(self, ids: list[np.ndarray]) -> np.ndarray:
        return np.array([float(self.weights[i].mean()) if len(i) else 0.0 for i in ids]) + self.shift


class MetadataModel:
    """Ridge logistic model of the standardised metadata."""

    def fit(self, x: np.ndarray, y: np.ndarray) -> None:
        self.mean, self.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
        self.weights = logistic((x - self.mean) / self.scale, y)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights[:-1] + self.weights[-1]


@dataclass
class Judge:
    """Both trained views, their calibration, and what combines them."""

    content: ContentModel
    metadata: MetadataModel
    calibrations: tuple[tuple[float, float], tuple[float, float]] = ((1.0, 0.0), (1.0, 0.0))
    blend: tuple[float, float, float] = (0.5, 0.5, 0.0)
    threshold: float = 0.5
    exchanged: tuple[int, int] = (0, 0)

    def combined(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        (a, b), (c, d) = self.calibrations
        wide = 12
        one, two = np.clip(a * one + b, -wide, wide), np.clip(c * two + d, -wide, wide)
        return sigmoid(self.blend[0] * one + self.blend[1] * two + self.blend[2])

    def logits(self, texts, sources, langs, lengths) -> tuple[np.ndarray, np.ndarray]:
        """Both views' answers before calibration."""
        one, two = np.zeros(len(texts)), np.zeros(len(texts))
        for a, b in blocks(texts):
            ids, first = content(texts[a:b])
            one[a:b] = _means(self.content.weights[ids], first) + self.content.shift
            two[a:b] = self.metadata.logits(metadata(texts[a:b], sources[a:b], langs[a:b], lengths[a:b]))
        return one, two

    def scores(self, texts, sources, langs, lengths) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of good quality by content, by metadata, and by both."""
        one, two = self.logits(texts, sources, langs, lengths)
        (p, q), (r, s) = self.calibrations
        return sigmoid(p * one + q), sigmoid(r * two + s), self.combined(one, two)


def train_views(ids: list, x: np.ndarray, y: np.ndarray, extra: Extra | None = None) -> Judge:
    """Both views trained on labelled rows and on what the other view has labelled for each."""
    judge = Judge(ContentModel(), MetadataModel())
    given = extra or Extra()
    judge.content.fit([*ids, *(i for i, _ in given.content.values())], np.append(y, [v for _, v in given.content.values()]))
    rows = [r for r, _ in given.metadata.values()]
    judge.metadata.fit(np.vstack((x, *rows)), np.append(y, [v for _, v in given.metadata.values()]))
    judge.exchanged = (len(given.content), len(given.metadata))
    return judge


class Extra:
    """Documents that each view was given by the other: id to features and label."""

    def __init__(self) -> None:
        self.content: dict = {}
        self.metadata: dict = {}


class Views(NamedTuple):
    """Rows as both views see them."""

    names: list
    ids: list[np.ndarray]
    x: np.ndarray
    y: np.ndarray


def _views(rows: DataFrame) -> Views:
    """Content buckets, metadata and labels of ``id, text, source, lang, length, label``.

    Both views are made in the tasks that read the texts; the driver gets the buckets as
    16-bit numbers and never a text. Rows are ordered by id and content.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, rest = texts_of(batch.column(1)), [batch.column(i).to_pylist() for i in (2, 3, 4)]
            for a, b in blocks(texts):
                flat, first = content(texts[a:b])
                ids = np.split(flat.astype(np.uint16), first[1:-1])
                x = metadata(texts[a:b], *(r[a:b] for r in rest))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array([i.tobytes() for i in ids], pa.binary()),
                        pa.array([v.tobytes() for v in x], pa.binary()),
                        batch.column(5).slice(a, b - a),
                    ],
                    ["id", "ids", "x", "label"],
                )

    kind = rows.schema["id"].dataType.simpleString()
    made = rows.select("id", "text", "source", "lang", "length", "label").mapInArrow(
        run, f"id {kind}, ids binary, x binary, label double"
    )
    got = made.toArrow()
    raw, names = got.column("ids").to_pylist(), got.column("id").to_pylist()
    order = sorted(range(len(raw)), key=lambda i: (names[i], raw[i]))
    width = _WIDTH + layout([b""]).shape[1]
    x = np.array([np.frombuffer(v) for v in got.column("x").to_pylist()]).reshape(-1, width)
    return Views(
        [names[i] for i in order],
        [np.frombuffer(raw[i], np.uint16) for i in order],
        x[order] if order else x,
        got.column("label").to_numpy()[order] if order else np.zeros(0),
    )


def _steps_of(texts: DataFrame, judge: Judge) -> DataFrame:
    """``id, content, metadata``: both views' answers on every text, in whole steps."""
    sent = texts.sparkSession.sparkContext.broadcast(judge)
    kind = texts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = [batch.column(i).to_pylist() for i in (2, 3, 4)]
            found = sent.value.logits(texts_of(batch.column(1)), *rest)
            steps = [np.rint(np.clip(f, -40, 40) * STEPS).astype(np.int32) for f in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, steps)], ["id", "content", "metadata"])

    own = texts.filter("id IS NOT NULL").select("id", "text", "source", "lang", "length")
    return own.mapInArrow(run, f"id {kind}, content int, metadata int")


def _cuts(free: DataFrame, view: str, share: float, portion: float) -> tuple[int, int, int, int]:
    """Steps at or below and above which the surest ``portion`` lies, and how many rows do.

    Bad and good rows in the labels' proportion, counted over all unlabelled rows.
    """
    held = free.groupBy(view).agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values(view)
    step, n = held[view].to_numpy(), held["n"].to_numpy()
    if not len(n):
        return -(1 << 30), 1 << 30, 0, 0
    up, down = np.cumsum(n), np.cumsum(n[::-1])[::-1]
    low = int(np.searchsorted(up, max(1.0, portion * (1 - share) * up[-1])))
    high = len(n) - 1 - int(np.searchsorted(down[::-1], max(1.0, portion * share * up[-1])))
    if low >= high:  # nothing that tells them apart
        return -(1 << 30), 1 << 30, 0, 0
    return int(step[low]), int(step[high]), int(up[low]), int(down[high])


def _drawn(free: DataFrame, view: str, share: float, portion: float, draw: int, turn: int) -> dict:
    """About ``draw`` ids of the surest rows with their labels, by a hash of the id."""
    low, high, bad, good = _cuts(free, view, share, portion)
    scale = 1 << 31
    mark = F.pmod(F.xxhash64(F.lit(17 + turn), "id"), F.lit(scale))
    wanted = ((F.col(view) <= low, bad, draw * (1 - share), 0.0), (F.col(view) >= high, good, draw * share, 1.0))
    out: dict = {}
    for beyond, rows, number, label in wanted:
        if rows:
            rate = int(scale * min(1.0, max(number, 1.0) / rows))
            out |= {r.id: label for r in free.filter(beyond & (mark < rate)).select("id").distinct().collect()}
    return out


def fit(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = 5000,
    sample_chars: int = 32_000_000,
    portion: float = 0.1,
    draw: int = 500,
    rounds: int = 4,
    id_col: str = "doc_id",
    label_col: str = "quality",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    length_col: str = "n_chars",
) -> Judge:
    """Train on about ``sample`` labelled rows, chosen by id hashes, of about ``sample_chars`` at most.

    In each round both views score all unlabelled rows; the surest ``portion``, found from
    counts over all of them, is where the other view's new labels come from, a draw of about
    ``draw`` rows a round. A quarter of the labelled rows is never trained on; these and all
    labelled rows outside the sample give calibrations, blend and threshold. Rows without a
    label count as unlabelled. Without labels, or with labels of one class, every document
    gets that class.
    """
    spark = docs.sparkSession
    known = labels.filter(F.col(label_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("double").alias("label"))
    texts = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        F.col(source_col).alias("source"),
        F.col(lang_col).alias("lang"),
        F.col(length_col).cast("bigint").alias("length"),
    )
    sizes = texts.select("id", F.coalesce(F.length("text"), F.lit(0)).alias("chars")).join(known, "id")
    total = sizes.agg(
        F.avg("label").alias("rate"), F.min("label").alias("a"), F.max("label").alias("b"), F.avg("chars").alias("chars")
    ).first()
    if total.rate is None or total.a == total.b:
        return _constant(Judge(ContentModel(), MetadataModel()), 1.0 if total.rate is None else float(total.rate))
    sample = min(sample, int(sample_chars / max(total.chars, 1.0)) + 1)
    quarter = F.pmod(F.xxhash64(F.lit(4), "id"), F.lit(4)) == 0
    known = known.withColumn("learned", in_sample(known, F.col("id"), sample) & ~quarter)
    path = scratch_path(spark, "quality")

    def views(chosen: dict) -> Views:
        """The chosen rows; their ids, no more than ``sample`` or ``draw`` allow, go to the texts."""
        kind = texts.schema["id"].dataType.simpleString()
        local = spark.createDataFrame(sorted(chosen.items()), f"id {kind}, label double")
        return _views(texts.join(F.broadcast(local), "id"))

    def scored(judge: Judge, name: str) -> DataFrame:
        _steps_of(texts, judge).write.parquet(f"{path}/{name}")
        return spark.read.parquet(f"{path}/{name}")

    own = views({r.id: r.label for r in known.filter("learned").collect()})
    if not len(own.y) or own.y.min() == own.y.max():
        return _constant(Judge(ContentModel(), MetadataModel()), float(total.rate))
    extra, share = Extra(), float(own.y.mean())
    judge = train_views(own.ids, own.x, own.y)
    for turn in range(rounds):
        free = scored(judge, f"round-{turn}").join(known.select("id"), "id", "left_anti")
        for view, other in (("content", extra.metadata), ("metadata", extra.content)):
            given = {k: v for k, v in _drawn(free, view, share, portion, draw, 2 * turn).items() if k not in other}
            if given:
                got = views(given)
                part = got.x if other is extra.metadata else got.ids
                other.update({name: (row, label) for name, row, label in zip(got.names, part, got.y)})
        judge = train_views(own.ids, own.x, own.y, extra)
    rest = scored(judge, "last").join(known.filter("NOT learned").select("id", "label"), "id")
    counts = rest.groupBy("content", "metadata", "label").agg(F.count(F.lit(1)).alias("n")).toPandas()
    counts = counts.sort_values(["content", "metadata", "label"])
    one, two, truth, n = (counts[c].to_numpy(float) for c in ("content", "metadata", "label", "n"))
    one, two = one / STEPS, two / STEPS
    judge.calibrations = (calibration(one, truth, n), calibration(two, truth, n))
    if len(truth) and truth.min() < truth.max():
        (a, b), (c, d) = judge.calibrations
        both = np.column_stack((np.clip(a * one + b, -12, 12), np.clip(c * two + d, -12, 12)))
        judge.blend = tuple(logistic(both, truth, ridge=0.5, number=n).tolist())
        judge.threshold = best_threshold(judge.combined(one, two), truth, number=n)
    return judge


def _constant(judge: Judge, share: float) -> Judge:
    width = _WIDTH + layout([b""]).shape[1]
    judge.metadata.mean, judge.metadata.scale = np.zeros(width), np.ones(width)
    judge.metadata.weights = np.zeros(width + 1)
    judge.blend = (0.0, 0.0, 6.0 if share >= 0.5 else -6.0)
    return judge


def with_quality(
    docs: DataFrame,
    judge: Judge,
    prefix: str = "",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    length_col: str = "n_chars",
) -> DataFrame:
    """``docs`` with ``content_score, metadata_score, quality_score, good`` added.

    Scores are calibrated probabilities of good quality; ``good`` says that the combined
    one reaches the threshold. ``prefix`` goes before the new names, and input columns of
    those names are replaced. Null and empty texts are scored by their metadata and by no
    words; nulls in metadata have buckets of their own. Rows are scored one by one in the
    tasks that read them.
    """
    names = [f"{prefix}{n}" for n in ("content_score", "metadata_score", "quality_score", "good")]
    out = docs.drop(*names)
    kinds = (T.DoubleType(), T.DoubleType(), T.DoubleType(), T.BooleanType())
    fields = [T.StructField(f.name, f.dataType, True) for f in out.schema]
    schema = T.StructType(fields + [T.StructField(n, k) for n, k in zip(names, kinds)])
    sent = docs.sparkSession.sparkContext.broadcast(judge)
    at = [out.columns.index(c) for c in (text_col, source_col, lang_col, length_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            rest = [batch.column(i).to_pylist() for i in at[1:]]
            found = own.scores(texts_of(batch.column(at[0])), *rest)
            added = [pa.array(s, pa.float64()) for s in found]
            added.append(pa.array(found[2] >= own.threshold, pa.bool_()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, *names])

    return out.mapInArrow(run, schema)
