"""Language-model scores of whole texts (operator 7).

A text is its lower-cased words and an end. Each word has the chance

    a * (its smoothed part of all training tokens) + b * (its part of the text so far) + c * (attention model)

where the attention model multiplies the chances of the word's subword ids, given the ids
before them, and that the word then is over, and a + b + c = 1. The smoothed part is that of
the base: training words have 0.1 added to their count, and what they leave is for a word that
training lacks. At no place do the chances of all training words, the end and one other word
pass 1, and no text falls below its base by more than log10 of a for each token. Counts of words and subword ids and the training of the
attention model cover every training document. The most frequent words go to all tasks, as
many as a fixed bound allows; every other word's count is joined, with the same result.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm import attention
from siltstone.llm.attention import Attention
from siltstone.llm.bytesets import END, LOWER, SPACED, Words, blocks, joined, mixed, span_keys, texts_of
from siltstone.llm.fitting import bounded_sample
from siltstone.llm.pieces import cut, encoder
from siltstone.session import scratch_path

#: Words whose counts are sent to all tasks, at most.
HEAD_WORDS = 400_000
#: Words that a counting task holds before it passes its counts on.
HELD_WORDS = 500_000
#: Rows of a part of a table that is summed over tasks.
PART_ROWS = 512
#: Bytes of ids, as 64-bit numbers, that a task learns from in random order.
HELD_IDS = 4 << 20
#: Ids of all training texts for one shard that learns on its own.
SHARD_IDS = 24_000_000
#: Rates of the rounds; the last is that of the texts that settled the weights.
ROUND_RATES = (0.004, 0.002, 0.001, 0.0005)
#: Range and step of log10 of the ratios by which words are counted for the weights.
RATIOS = 12.0
RATIO_STEP = 0.05
#: The end of a text as a word.
END_KEY = 0
#: Words that the start of a text weighs against what it has repeated.
EARLY = 5
#: Share of a later word's chance for words whose first id has no leading blank.
UNLED = 1e-3


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word counts of a task's texts, passed on whenever many are held."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    number = 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([k for k, _ in held])
        counts = np.concatenate([c for _, c in held])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        return keys[first], np.add.reduceat(counts, first)

    def rows() -> pa.RecordBatch:
        keys, counts = held[0]
        return pa.RecordBatch.from_arrays(
            [pa.array(keys.view(np.int64)), pa.array(counts)], ["word", "n"]
        )

    for batch in batches:
        texts = texts_of(batch.column(0))
        for a, b in blocks(texts, 2 << 20):
            keys, counts = np.unique(Words(texts[a:b], SPACED).keys, return_counts=True)
            ends = (np.array([END_KEY], np.uint64), np.array([b - a]))
            held += [(keys, counts), ends]
            number += len(keys)
            if number > 2 * HELD_WORDS:
                held = [merged()]
                number = len(held[0][0])
                if number > HELD_WORDS:
                    yield rows()
                    held, number = [], 0
    if held:
        held = [merged()]
        yield rows()


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, n``: count of each word's hash in one text column, ends included."""
    counts = texts.mapInArrow(_counted, "word bigint, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """What every task needs to score: frequent words, totals and the attention model."""

    words: np.ndarray
    counts: np.ndarray
    tokens: int
    distinct: int
    weights: tuple[float, float, float]
    attention: Attention
    leads: np.ndarray
    tokenizer: str

    def found(self, keys: np.ndarray) -> np.ndarray:
        """Count of each word, -1 where it is not among the frequent ones."""
        if not len(self.words):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.words, keys), len(self.words) - 1)
        return np.where(self.words[at] == keys, self.counts[at], -1)

    def smoothed(self, counts: np.ndarray) -> np.ndarray:
        """Part of all training tokens, with room for words that training lacks."""
        return (counts + 0.1) / (self.tokens + 0.1 * (self.distinct + 1))

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10(self.smoothed(counts))

    def besides(self, repeated: np.ndarray, log_chance: np.ndarray) -> np.ndarray:
        """A word's chance without its count: by repetition and by the attention model."""
        return self.weights[1] * repeated + self.weights[2] * np.exp(log_chance) + 1e-300

    def mixed(self, counts: np.ndarray, besides: np.ndarray) -> np.ndarray:
        """log10 of a word's whole chance."""
        return np.log10(self.weights[0] * self.smoothed(counts) + besides)


class WordStream:
    """A block of texts as words and subword ids; words are parted by single blanks.

    ``known`` are the ids, and how many each word has, where they were found before.
    """

    def __init__(self, texts: list[bytes], tokenizer: str, known: tuple[np.ndarray, np.ndarray] | None = None):
        raw, begin = joined(texts)
        data = LOWER[raw]
        blank = SPACED[raw]
        data = np.where(blank & (raw != END), np.uint8(0x20), data)
        keep = ~blank
        keep[:-1] |= ~blank[1:]  # of a run of white space its last byte stays
        keep |= raw == END
        keep[begin[:-1][blank[begin[:-1]] & (raw[begin[:-1]] != END)]] = True
        data, closes = data[keep], np.flatnonzero(raw[keep] == END)
        end = data == END
        apart = end | (data == 0x20)
        edge = np.flatnonzero(np.diff(np.concatenate(([True], apart)).astype(np.int8)))
        self.start, self.stop = edge[0::2], edge[1::2]
        self.keys = span_keys(data, self.start, self.stop)
        self.first = np.searchsorted(self.start, np.concatenate(([0], closes + 1)))
        if known is not None:
            self.ids, self.per_word = known
            return
        piece, piece_stop = cut(data, False)
        blanks = (piece_stop - piece == 1) & (data[piece] == 0x20)
        piece, piece_stop = piece[~blanks], piece_stop[~blanks]
        own = encoder(tokenizer)
        self.ids, count = own.lookup(span_keys(data, piece, piece_stop), piece, piece_stop, data.tobytes())
        # a piece with a leading blank begins one byte before its word
        word = np.searchsorted(self.start, piece + (data[piece] == 0x20), side="right") - 1
        self.per_word = np.bincount(word, count, len(self.start)).astype(np.int64)

    def __len__(self) -> int:
        return len(self.first) - 1

    def by_text(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Each text's ids, and how many each of its words has."""
        sums = np.concatenate(([0], np.cumsum(self.per_word)))[self.first]
        return np.split(self.ids, sums[1:-1]), np.split(self.per_word, self.first[1:-1])

    def repeated(self) -> np.ndarray:
        """Each word's part of the words before it in its text, early ones held down."""
        of = np.repeat(np.arange(len(self)), np.diff(self.first))
        key = self.keys ^ mixed(of.astype(np.uint64) + np.uint64(1))
        order = np.argsort(key, kind="stable")
        new = np.flatnonzero(np.concatenate(([True], np.diff(key[order]) != 0)))
        nth = np.arange(len(key)) - np.repeat(new, np.diff(np.append(new, len(key))))
        seen = np.empty(len(key), np.int64)
        seen[order] = nth
        before = np.arange(len(key)) - self.first[of]
        return seen / (before + EARLY)


def word_chances(stream: WordStream, attention: Attention, leads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Natural log chance of each word, and of each text's end.

    ``leads`` marks the ids that begin with a blank, as every word but a text's first does.
    A word is its ids and then a border: such an id or the end. That a border stands before
    it is known, but for a text's first word. So the chances of all words and the end at one
    place add up to no more than 1. ``UNLED`` of it is for words that begin otherwise.
    """
    per_text = np.add.reduceat(
        np.append(stream.per_word, 0), np.minimum(stream.first[:-1], len(stream.per_word))
    )
    per_text[np.diff(stream.first) == 0] = 0
    ends = np.cumsum(per_text)
    texts = np.split(stream.ids.astype(np.int64), ends[:-1]) if len(ends) else []
    chance, border = attention.log_chances_of(texts, leads)
    at = ends + np.arange(len(ends))  # where each text's end stands among its ids
    inside = np.ones(len(chance), bool)
    inside[at] = False
    total = np.concatenate(([0.0], np.cumsum(chance[inside], dtype=np.float64)))
    stop = np.cumsum(stream.per_word)
    begin = stop - stream.per_word
    of = np.repeat(np.arange(len(stream)), np.diff(stream.first))
    words = total[stop] - total[begin] + border[stop + of]
    later = np.ones(len(words), bool)
    some = np.diff(stream.first) > 0
    later[stream.first[:-1][some]] = False
    led = np.append(leads[stream.ids], False)[begin]
    known = np.log1p(-UNLED) - border
    words += np.where(later, np.where(led, known[begin + of], np.log(UNLED)), 0)
    return words, chance[at] + np.where(some, known[at], 0.0)


def _mixing_weights(ratios: np.ndarray, number: np.ndarray) -> tuple[float, float, float]:
    """Weights of a word's three chances by expectation maximisation over all words.

    A row of ``ratios`` has log10 of the first two chances over the third, for ``number`` words.
    """
    weights = np.full(3, 1 / 3)
    if len(number):
        held = np.column_stack((10.0**ratios, np.ones(len(number))))
        for _ in range(50):
            own = held * weights
            own *= (number / own.sum(axis=1))[:, None]
            weights = np.clip(own.sum(axis=0) / number.sum(), 0.01, None)
            weights /= weights.sum()
    return tuple(weights.tolist())


def _step_of(part: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """log10 of a chance over the attention model's, in whole steps."""
    ratio = np.log10(np.maximum(part, 1e-300)) - chance
    return np.rint(np.clip(ratio, -RATIOS, RATIOS) / RATIO_STEP).astype(np.int32)


def _mixing(stored: DataFrame, model: Model, counts: DataFrame) -> tuple[float, float, float]:
    """Mixing weights by all words of ``stored`` texts, whose counts are less the word itself."""
    spark = stored.sparkSession
    sent = spark.sparkContext.broadcast(model)
    schema = "word bigint, one int, two int, chance double, n bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            for stream, _, _ in _streams(batch, own):
                if not len(stream.keys):
                    continue
                chance = word_chances(stream, own.attention, own.leads)[0] / np.log(10)
                count = own.found(stream.keys)
                one = _step_of(own.smoothed(np.maximum(count - 1, 0)), chance)
                two = _step_of(stream.repeated(), chance)
                known = count >= 0
                pairs, n = np.unique(np.column_stack((one, two))[known], axis=0, return_counts=True)
                rare = int((~known).sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate((np.zeros(len(n), np.int64), stream.keys.view(np.int64)[~known])),
                                 mask=np.arange(len(n) + rare) < len(n)),
                        pa.array(np.concatenate((pairs[:, 0], np.zeros(rare, np.int32)))),
                        pa.array(np.concatenate((pairs[:, 1], two[~known]))),
                        pa.array(np.concatenate((np.zeros(len(n)), chance[~known]))),
                        pa.array(np.concatenate((n, np.ones(rare, np.int64)))),
                    ],
                    [c.split()[0] for c in schema.split(", ")],
                )

    path = scratch_path(spark, "lm_mixing")
    stored.select(*_STREAM).mapInArrow(run, schema).write.parquet(path)
    words = spark.read.parquet(path)
    other = counts.select("word", F.col("n").alias("of_all"))
    smooth = F.lit(model.tokens + 0.1 * (model.distinct + 1))
    part = (F.col("of_all") - 1 + 0.1) / smooth
    ratio = F.least(F.greatest(F.log10(part) - F.col("chance"), F.lit(-RATIOS)), F.lit(RATIOS))
    rare = words.filter("word IS NOT NULL").join(other, "word")
    rare = rare.select(F.rint(ratio / RATIO_STEP).cast("int").alias("one"), "two", "n")
    steps = words.filter("word IS NULL").select("one", "two", "n").union(rare)
    got = steps.groupBy("one", "two").agg(F.sum("n").alias("n")).toPandas().sort_values(["one", "two"])
    return _mixing_weights(got[["one", "two"]].to_numpy(float) * RATIO_STEP, got["n"].to_numpy(float))


def _id_type(vocabulary: int) -> type:
    return np.uint16 if vocabulary <= 1 << 16 else np.int32


#: What ``_streams`` reads of stored texts, last in its batches.
_STREAM = ("text", "ids", "per_word")


def _stored(texts: DataFrame, tokenizer: str, path: str) -> DataFrame:
    """``texts`` written with ``turn``, the subword ids of ``text`` and how many each word has.

    The ids serve the counts, all rounds, the weights and the scores, so they are found once.
    """
    turn = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(10)).cast("int")
    rows = texts.withColumn("turn", turn)
    names, at = rows.columns, rows.columns.index("text")
    kind = _id_type(encoder(tokenizer).mark_id + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = texts_of(batch.column(at))
            for a, b in blocks(held):
                ids, number = WordStream(held[a:b], tokenizer).by_text()
                columns = [column.slice(a, b - a) for column in batch.columns]
                columns.append(pa.array([i.astype(kind).tobytes() for i in ids], pa.binary()))
                columns.append(pa.array([n.astype(np.int32).tobytes() for n in number], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, [*names, "ids", "per_word"])

    found = [T.StructField(name, T.BinaryType()) for name in ("ids", "per_word")]
    encoded = rows.mapInArrow(run, T.StructType([*rows.schema.fields, *found]))
    encoded.write.option("compression", "zstd").parquet(path)
    return texts.sparkSession.read.parquet(path)


def _streams(batch: pa.RecordBatch, model: Model) -> Iterator[tuple[WordStream, int, int]]:
    """Some texts at a time of a batch that ends in ``_STREAM``, and where they begin and end in it."""
    column, ids, number = batch.columns[-3:]
    kind, texts = _id_type(len(model.attention.kind)), texts_of(column)
    for a, b in blocks(texts):
        own, per_word = (b"".join(c.slice(a, b - a).to_pylist()) for c in (ids, number))
        known = np.frombuffer(own, kind), np.frombuffer(per_word, np.int32).astype(np.int64)
        yield WordStream(texts[a:b], model.tokenizer, known), a, b


def _id_blocks(column: pa.Array, kind: type) -> Iterator[tuple[list[np.ndarray], int, int]]:
    """Stored ids of some texts at a time, and where these begin and end in the column."""
    length = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    size = np.cumsum(length * 8 // np.dtype(kind).itemsize + 8)
    edges = [0, *(np.flatnonzero(np.diff(size // HELD_IDS)) + 1).tolist(), len(column)]
    for a, b in zip(edges, edges[1:]):
        if a < b:
            yield [np.frombuffer(i, kind).astype(np.int64) for i in column.slice(a, b - a).to_pylist()], a, b


def _parts(rows: np.ndarray, name: int = 0) -> Iterator[pa.RecordBatch]:
    """Rows of numbers as ``part, body``, those of zeros left out; ``name`` is the first part's."""
    for a in range(0, len(rows), PART_ROWS):
        own = rows[a : a + PART_ROWS]
        if own.any():
            body = [np.ascontiguousarray(own, np.float64).tobytes()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([name + a // PART_ROWS], pa.int32()), pa.array(body, pa.binary())], ["part", "body"]
            )


def _summed(parts: DataFrame) -> dict[int, np.ndarray]:
    """Sum of each part's bodies over all tasks, rounded to single precision at the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.frombuffer(body)
                total[part] = total[part] + own if part in total else own
        for part, own in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([own.astype(np.float32).tobytes()], pa.binary())],
                ["part", "body"],
            )

    return {r.part: np.frombuffer(r.body, np.float32) for r in parts.repartition("part").mapInArrow(run, _PART).collect()}


_PART = "part int, body binary"


def _whole(parts: dict[int, np.ndarray], number: int, width: int) -> np.ndarray:
    out = np.zeros((number, width), np.float32)
    for part, body in parts.items():
        if part >= 0:
            own = body.reshape(-1, width)
            out[part * PART_ROWS : part * PART_ROWS + len(own)] = own
    return out


def _gathered(stored: DataFrame, vocabulary: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """``attention.gathered`` of all stored texts, and counts of ids without turn 0."""
    kind, width = _id_type(vocabulary), 2 + 2 * attention.BESIDE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((vocabulary, width - 1), np.uint32)
        learned = np.zeros((vocabulary, 1), np.uint32)
        for batch in batches:
            turn = batch.column(0).to_pylist()
            for ids, a, b in _id_blocks(batch.column(1), kind):
                attention.gathered(ids, vocabulary, end, total)
                own = [np.append(i, end) for i, t in zip(ids, turn[a:b]) if t]
                if own:
                    learned[:, 0] += np.bincount(np.concatenate(own), minlength=vocabulary).astype(np.uint32)
        for a in range(0, vocabulary, PART_ROWS):
            rows = slice(a, a + PART_ROWS)
            yield from _parts(np.concatenate((total[rows], learned[rows]), axis=1), a // PART_ROWS)

    counts = _whole(_summed(stored.select("turn", "ids").mapInArrow(run, _PART)), vocabulary, width)
    return counts[:, :-1], counts[:, -1]


def _round(stored: DataFrame, model: Attention, shards: int, rate: float) -> None:
    """One pass over stored texts: shards learn from ``model`` alone, which then moves by their mean.

    A shard has the same texts in the same order in every run.
    """
    sent = stored.sparkSession.sparkContext.broadcast(model)
    vocabulary = len(model.table)
    kind = _id_type(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        old = sent.value
        new = copy.deepcopy(old)
        learner, seen = attention.Learner(new), np.zeros(vocabulary, np.int64)
        for batch in batches:
            for ids, _, _ in _id_blocks(batch.column(0), kind):
                x, target = attention.windows(ids, old.end)
                learner.learn(x, target, (rate, rate))
                seen += np.bincount(x[target >= 0], minlength=vocabulary)
        if seen.any():
            rows, flat = attention.changes(old, new, seen)
            yield from _parts(rows)
            yield from _parts(flat[None, :], -1)

    ids = stored.select("doc_id", "ids").repartition(shards, F.xxhash64("doc_id", "ids")).sortWithinPartitions(F.xxhash64("ids"), "ids")
    parts = _summed(ids.select("ids").mapInArrow(run, _PART))
    if parts:
        attention.moved(model, _whole(parts, vocabulary, 1 + attention.SIZE), parts[-1])
    sent.unpersist()


def fit(texts: DataFrame, counts: DataFrame, tokenizer: str, sample: int = 1200) -> Model:
    """``fit_stored`` of training texts (``doc_id, text``)."""
    stored = _stored(texts, tokenizer, scratch_path(texts.sparkSession, "lm_ids"))
    return fit_stored(stored, counts, tokenizer, sample)


def fit_stored(stored: DataFrame, counts: DataFrame, tokenizer: str, sample: int = 1200) -> Model:
    """Model from ``_stored`` training texts and their stored ``word_counts``.

    Counts of words and of subword ids are of all texts, and all texts train the network.
    It starts from a fit on about ``sample`` of them. Then shards of nine tenths learn on
    their own, in three rounds of other texts, after each of which the changes are averaged.
    The last tenth settles the three weights and is learned from after that.
    """
    totals = counts.agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("distinct")).first()
    # how many words have a count of at least each of a hundred-odd steps
    step = F.floor(F.log2("n") * 4).cast("int")
    steps = sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True)
    least, held = 1 << 62, 0
    for row in steps:
        held += row["count"]
        if held > HEAD_WORDS:
            break
        least = row["step"]
    end = encoder(tokenizer).mark_id
    kind = _id_type(end + 1)
    gathered, learned = _gathered(stored, end + 1, end)
    learned = learned.copy()
    net, occurs = attention.start(gathered, end), gathered[:, 0].copy()
    del gathered  # the driver needs the memory
    first = bounded_sample(stored.filter("turn > 0"), F.col("doc_id"), sample).select("doc_id", "ids").collect()
    first = [i for _, i in sorted(((r.doc_id is not None, r.doc_id), bytes(r.ids)) for r in first)]
    attention.fit(net, [np.frombuffer(i, kind).astype(np.int64) for i in first])
    shards = max(1, -(-int(occurs.sum(dtype=np.float64)) // SHARD_IDS))
    for turn, rate in enumerate(ROUND_RATES[:-1]):
        _round(stored.filter((F.col("turn") - 1).between(3 * turn, 3 * turn + 2)), net, shards, rate)
    net.inner = attention.inner(learned, net.kind)
    head = counts.filter(step >= F.lit(min(least, 1 << 30))).toPandas()
    words = head["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(words)
    model = Model(
        words[order],
        head["n"].to_numpy(np.int64)[order],
        int(totals.tokens or 0),
        int(totals.distinct or 0),
        (1 / 3, 1 / 3, 1 / 3),
        net,
        encoder(tokenizer).leads(),
        tokenizer,
    )
    model.weights = _mixing(stored.filter("turn = 0"), model, counts)
    net.inner = attention.inner(occurs, net.kind)
    _round(stored.filter("turn = 0"), net, max(1, shards // 3), ROUND_RATES[-1])
    return model


def _ids(texts: list[bytes], tokenizer: str) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for a, b in blocks(texts):
        out += [i.astype(np.int64) for i in WordStream(texts[a:b], tokenizer).by_text()[0]]
    return out


_SCORED = (
    "rid bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, "
    "score double, words array<bigint>, chances array<double>"
)


def _first_scores(stored: DataFrame, model: Model) -> DataFrame:
    """Scores of stored texts by the frequent words, and the other words with log10 of their chance besides."""
    sent = stored.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        end_count = own.found(np.array([END_KEY], np.uint64)).clip(0)
        for batch in batches:
            for stream, a, b in _streams(batch, own):
                chance, end_chance = word_chances(stream, own.attention, own.leads)
                counts = own.found(stream.keys)
                known = counts >= 0
                first = stream.first
                sums = lambda x: np.diff(np.concatenate(([0.0], np.cumsum(x)))[first])  # noqa: B023, E731
                base = sums(np.where(known, own.base(counts.clip(0)), 0)) + own.base(end_count)
                besides = own.besides(stream.repeated(), chance)
                score = sums(np.where(known, own.mixed(counts.clip(0), besides), 0))
                score += own.mixed(end_count, own.besides(0, end_chance))
                rare = np.concatenate(([0], np.cumsum(~known)))[first].astype(np.int32)
                lists = [
                    pa.ListArray.from_arrays(pa.array(rare), pa.array(values[~known]))
                    for values in (stream.keys.view(np.int64), np.log10(besides))
                ]
                columns = [batch.column(i).slice(a, b - a) for i in range(3)]
                columns += [
                    pa.array(np.diff(first) + 1),
                    pa.array(sums(known).astype(np.int64) + int(end_count[0] > 0)),
                    pa.array(base),
                    pa.array(score),
                    *lists,
                ]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _SCORED.split(", ")])

    return stored.select("rid", "doc_id", "held_out", *_STREAM).mapInArrow(run, _SCORED)


def score_texts(
    docs: DataFrame,
    held_out: Column,
    tokenizer: str,
    sample: int = 1200,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Score every text by a model of those that are not ``held_out``.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``: the
    words and the end; how many of them the training texts have; the training tokens; log10
    of the text's chance by smoothed word counts and by the model. A null or empty text is
    its end alone. Rows are scored one by one, whatever their ids; other columns are
    ignored. Where ``held_out`` is null the row is not held out. No rows give no rows.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "lm")
    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.col(text_col).alias("text"),
    )
    stored = _stored(rows, tokenizer, f"{path}/texts")
    training = stored.filter("NOT held_out")
    word_counts(training.select("text")).write.parquet(f"{path}/counts")
    counts = spark.read.parquet(f"{path}/counts")
    model = fit_stored(training, counts, tokenizer, sample)
    _first_scores(stored, model).write.parquet(f"{path}/scored")
    scored = spark.read.parquet(f"{path}/scored")

    pair = F.explode(F.arrays_zip("words", "chances")).alias("pair")
    rare = scored.select("rid", pair).select(
        "rid", F.col("pair.words").alias("word"), F.col("pair.chances").alias("chance")
    )
    n = F.coalesce("n", F.lit(0))
    smooth = F.lit(model.tokens + 0.1 * (model.distinct + 1))
    part = F.lit(model.weights[0]) * (n + 0.1) / smooth
    rest = rare.join(counts, "word", "left").select(
        "rid",
        (n > 0).cast("bigint").alias("known"),
        F.log10((n + 0.1) / smooth).alias("base"),
        F.log10(part + F.pow(F.lit(10.0), "chance")).alias("own"),
    )
    rest = rest.groupBy("rid").agg(*(F.sum(c).alias(c) for c in ("known", "base", "own")))
    return scored.drop("words", "chances").join(rest, "rid", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("own", F.lit(0.0))).alias("score"),
    )
