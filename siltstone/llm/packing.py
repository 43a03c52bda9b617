"""Bounded-space online packing of tokenized documents (operator 6).

Each task reads its documents in order and keeps ``windows`` open sequences. A document
longer than a sequence gives off full sequences first. What is left goes, whole, to the
open sequence where it leaves least room. Where it fits none, the fullest one is emitted:
filled up with the document's first ids if its gap is at least ``least_cut``, else padded;
the rest of the document goes on in the same way. The open sequences of all tasks are
merged at last: rounds of the same packing over ever fewer tasks, until one is left, whose
only unfilled sequence is cut into powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.bytesets import blocks, texts_of
from siltstone.llm.pieces import encoder
from siltstone.session import scratch_path

_COLUMNS = (
    ("doc_id", "bigint"),
    ("start", "bigint"),
    ("length", "bigint"),
    ("ids_crc32", "bigint"),
    ("doc_tokens", "bigint"),
    ("sequence_id", "bigint"),
    ("offset", "bigint"),
    ("ids", "binary"),
    ("is_open", "boolean"),
)
_SCHEMA = ", ".join(f"{n} {t}" for n, t in _COLUMNS)
_ARROW = {"bigint": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
#: A merging round hands the open sequences of so many tasks to one.
FAN_IN = 32

Piece = tuple[int | None, int, int, np.ndarray]  # document, ids before, its ids in all, ids


class Packer:
    """Open sequences of one task; emitted ones go to ``out`` as (pieces, fill)."""

    def __init__(self, size: int, windows: int, least_cut: int):
        self.size, self.windows, self.least_cut = size, windows, least_cut
        self.open: list[list[Piece]] = []
        self.fill: list[int] = []
        self.out: list[list[Piece]] = []

    def add(self, piece: Piece) -> None:
        doc, start, total, ids = piece
        while len(ids) >= self.size:
            self.out.append([(doc, start, total, ids[: self.size])])
            start, ids = start + self.size, ids[self.size :]
        while len(ids):
            room = [self.size - f for f in self.fill]
            fits = [(r, i) for i, r in enumerate(room) if r >= len(ids)]
            if fits:
                left, best = min(fits)
                self.open[best].append((doc, start, total, ids))
                self.fill[best] += len(ids)
                if left == len(ids):
                    self._emit(best)
                return
            if len(self.open) < self.windows:
                self.open.append([(doc, start, total, ids)])
                self.fill.append(len(ids))
                return
            fullest = max(range(len(self.fill)), key=self.fill.__getitem__)
            gap = room[fullest]
            if gap >= self.least_cut:
                self.open[fullest].append((doc, start, total, ids[:gap]))
                start, ids = start + gap, ids[gap:]
            self._emit(fullest)

    def _emit(self, i: int) -> None:
        self.out.append(self.open.pop(i))
        self.fill.pop(i)

    def finish(self) -> None:
        """Fill the open sequences one after another; cut the last into powers of two."""
        pieces = [p for sequence in self.open for p in sequence]
        self.open, self.fill = [], []
        room = self.size
        target: list[Piece] = []
        left = sum(len(p[3]) for p in pieces)
        for doc, start, total, ids in pieces:
            while len(ids):
                if not target:
                    room = self.size if left >= self.size else 1 << (left.bit_length() - 1)
                took = min(room, len(ids))
                target.append((doc, start, total, ids[:took]))
                start, ids, room, left = start + took, ids[took:], room - took, left - took
                if not room:
                    self.out.append(target)
                    target = []


def _rows(sequences: list[list[Piece]], first: int, still_open: bool) -> pa.RecordBatch:
    columns: list[list] = [[] for _ in _COLUMNS]
    for number, pieces in enumerate(sequences, first):
        offset = 0
        for doc, start, total, ids in pieces:
            raw = ids.astype("<u4").tobytes()
            row = (doc, start, len(ids), zlib.crc32(raw), total, number, offset)
            for column, value in zip(columns, (*row, raw if still_open else None, still_open)):
                column.append(value)
            offset += len(ids)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, _ARROW[t]) for c, (_, t) in zip(columns, _COLUMNS)], [n for n, _ in _COLUMNS]
    )


def _packed(packer: Packer, pieces: Iterator[Piece], first: int, last: bool):
    """Rows of emitted sequences as they come, at the end those of the open ones."""
    number = first
    for piece in pieces:
        packer.add(piece)
        if len(packer.out) >= 256:
            yield _rows(packer.out, number, False)
            number += len(packer.out)
            packer.out.clear()
    if last:
        packer.finish()
    yield _rows(packer.out, number, False)
    yield _rows(packer.open, number + len(packer.out), True)


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    size: int = 2048,
    windows: int = 32,
    least_cut: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pack every id of every document into sequences of at most ``size`` ids.

    Returns a row per piece: ``doc_id, start`` (its document's ids before it), ``length,
    ids_crc32, doc_tokens`` (the document's ids with its end id), ``sequence_id, offset``.
    A null or empty text is the end id alone. Rows are packed one by one, so repeated
    rows and null ids keep pieces of their own; other columns are ignored; no rows, no
    sequences. Texts are not shuffled: only open sequences move, ``windows`` per task.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col))

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)

        def pieces() -> Iterator[Piece]:
            for batch in batches:
                names, texts = batch.column(0).to_pylist(), texts_of(batch.column(1))
                for a, b in blocks(texts):
                    for doc, ids in zip(names[a:b], own.encode(texts[a:b])):
                        yield doc, 0, len(ids) + 1, np.append(ids, end_id).astype(np.uint32)

        first = TaskContext.get().partitionId() << 36
        yield from _packed(Packer(size, windows, least_cut), pieces(), first, False)

    path = scratch_path(spark, "packed")
    source.mapInArrow(first_pass, _SCHEMA).write.parquet(f"{path}/round=0")
    tasks = max(1, _written(spark, f"{path}/round=0"))
    turn = 0
    while True:
        opened = spark.read.parquet(f"{path}/round={turn}").filter("is_open")
        turn += 1
        tasks = -(-tasks // FAN_IN)
        _merge(opened, tasks, turn, (size, windows, least_cut)).write.parquet(f"{path}/round={turn}")
        if tasks == 1:
            break
    done = spark.read.parquet(path).filter("NOT is_open")
    return done.select([n for n, _ in _COLUMNS[:7]])


def _written(spark: SparkSession, path: str) -> int:
    return spark.read.parquet(path).filter("is_open").select(_task()).distinct().count()


def _task() -> F.Column:
    """The task that a sequence was opened in."""
    return F.shiftright(F.col("sequence_id"), 36).bitwiseAND((1 << 20) - 1).alias("task")


def _merge(opened: DataFrame, tasks: int, turn: int, limits: tuple[int, int, int]) -> DataFrame:
    """One round over the open sequences, on ``tasks`` tasks; the last round leaves none open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces() -> Iterator[Piece]:
            for batch in batches:
                for row in batch.to_pylist():
                    ids = np.frombuffer(row["ids"], "<u4")
                    yield row["doc_id"], row["start"], row["doc_tokens"], ids

        first = (turn << 56) + (TaskContext.get().partitionId() << 36)
        yield from _packed(Packer(*limits), pieces(), first, tasks == 1)

    dealt = opened.repartition(tasks, _task()) if tasks > 1 else opened.coalesce(1)
    ordered = dealt.sortWithinPartitions("sequence_id", "offset")
    return ordered.mapInArrow(run, _SCHEMA)
