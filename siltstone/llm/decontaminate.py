"""Benchmark decontamination by Wu-Manber search over words (operator 4).

Every window of ``window`` consecutive words of an item is a pattern; an item of fewer
words is one pattern of its own length. Patterns of one length share a shift table over
blocks of two words (one, for patterns of one word): how far a cursor may move on when it
reads that block without passing the end of any pattern. A shift of zero names a bucket of
patterns that end in that block; their words are then compared. All cursors of a batch move
together, one numpy step each, so a document of any length is searched whole: it is cut
into stretches that overlap by a pattern's length less one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.bytesets import ALNUM, Words, blocks, mixed, ragged, texts_of

#: Items of so many words at most are searched for at once; more take further passes.
PASS_WORDS = 250_000
#: A cursor's stretch of words.
STRETCH = 512
_U = np.uint64


def _pairs(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mixed(left * _U(0x9E3779B97F4A7C15) + right)


class Patterns:
    """Shift table and suffix buckets of all patterns of one length.

    ``words`` has the word keys of each pattern, ``items`` its item, and ``place`` the
    index in ``source`` of its first word, from where its bytes are compared.
    """

    def __init__(self, words: np.ndarray, items: np.ndarray, place: np.ndarray, source: Words):
        self.source = source
        self.length = words.shape[1]
        self.block = min(2, self.length)
        order = np.argsort(self._block_at(words, self.length - self.block), kind="stable")
        self.words, self.items, self.place = words[order], items[order], place[order]
        tails = self._block_at(self.words, self.length - self.block)
        self.tails, self.tail_begin = np.unique(tails, return_index=True)
        self.tail_end = np.append(self.tail_begin[1:], len(tails))
        shift: dict[int, int] = {}
        for at in range(self.length - self.block + 1):
            for key in np.unique(self._block_at(words, at)).tolist():
                shift[key] = self.length - self.block - at
        keys = np.array(list(shift), np.uint64)
        self.keys = np.sort(keys)
        self.shifts = np.array([shift[k] for k in self.keys.tolist()], np.int64)
        self.beyond = self.length - self.block + 1
        # most blocks are in no pattern: a bit table answers for them at once
        self.bits = max(16, int(len(keys) * 16).bit_length())
        self.maybe = np.zeros(1 << self.bits, bool)
        self.maybe[(keys >> _U(64 - self.bits)).astype(np.int64)] = True

    def _block_at(self, words: np.ndarray, at: int) -> np.ndarray:
        if self.block == 1:
            return words[:, at]
        return _pairs(words[:, at], words[:, at + 1])

    def shift_of(self, block: np.ndarray) -> np.ndarray:
        out = np.full(len(block), self.beyond, np.int64)
        maybe = np.flatnonzero(self.maybe[(block >> _U(64 - self.bits)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, block[maybe]), len(self.keys) - 1)
        known = self.keys[at] == block[maybe]
        out[maybe[known]] = self.shifts[at[known]]
        return out

    def search(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Begin of each occurrence in a block of texts, as a word's index, and its pattern."""
        m = self.length
        text, first = words.keys, words.first
        size = np.diff(first)
        begin, size = first[:-1][size >= m], size[size >= m]
        if not len(begin):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        parts = -(-(size - m + 1) // STRETCH)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        at = np.repeat(begin, parts) + nth * STRETCH + m - 1  # where a pattern would end
        stop = np.minimum(at + STRETCH, np.repeat(begin + size, parts))
        found_at: list[np.ndarray] = []
        found: list[np.ndarray] = []
        while len(at):
            block = _pairs(text[at - 1], text[at]) if self.block == 2 else text[at]
            shift = self.shift_of(block)
            stay = np.flatnonzero(shift == 0)
            if len(stay):
                self._compare(words, at[stay], block[stay], found_at, found)
                shift[stay] = 1
            at = at + shift
            going = at < stop
            at, stop = at[going], stop[going]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(found_at), np.concatenate(found)

    def _compare(self, words: Words, end, block, found_at, found) -> None:
        """Check the patterns of each cursor's bucket, one of each bucket per turn."""
        bucket = np.searchsorted(self.tails, block)
        pattern, last = self.tail_begin[bucket], self.tail_end[bucket]
        begin = end - self.length + 1
        while len(begin):
            span = words.keys[begin[:, None] + np.arange(self.length)]
            same = np.flatnonzero((span == self.words[pattern]).all(axis=1))
            same = same[self._alike(words, begin[same], pattern[same])]
            found_at.append(begin[same])
            found.append(pattern[same])
            pattern = pattern + 1
            more = pattern < last
            begin, pattern, last = begin[more], pattern[more], last[more]


    def _alike(self, words: Words, begin: np.ndarray, pattern: np.ndarray) -> np.ndarray:
        """Whether the words themselves, not only their keys, are the pattern's."""
        here = begin[:, None] + np.arange(self.length)
        there = self.place[pattern][:, None] + np.arange(self.length)
        size = words.stop[here] - words.start[here]
        alike = (size == self.source.stop[there] - self.source.start[there]).all(axis=1)
        here, there, size = here[alike].ravel(), there[alike].ravel(), size[alike]
        left = ragged(words.data, words.start[here], size.ravel())
        right = ragged(self.source.data, self.source.start[there], size.ravel())
        row = np.repeat(np.flatnonzero(alike), size.sum(axis=1))
        alike[row[left != right]] = False
        return alike


def compiled(items: list[tuple[str, bytes]], window: int) -> list[Patterns]:
    """Patterns of the items, by length; ``items`` are names and texts."""
    words = Words([text for _, text in items], ALNUM)
    by_length: dict[int, tuple[list, list, list]] = {}
    for i in range(len(items)):
        own = words.keys[words.first[i] : words.first[i + 1]]
        if len(own):
            m = min(window, len(own))
            rows = np.lib.stride_tricks.sliding_window_view(own, m)
            kept = by_length.setdefault(m, ([], [], []))
            kept[0].append(rows)
            kept[1].append(np.full(len(rows), i))
            kept[2].append(words.first[i] + np.arange(len(rows)))
    return [Patterns(*map(np.concatenate, parts), words) for _, parts in sorted(by_length.items())]


def _passes(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[str, bytes]]]:
    """Items in passes of bounded size, each fetched by itself."""
    items = benchmark.filter(F.col(text_col).isNotNull()).select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
        F.col(text_col).alias("text"),
    )
    held = items.select(F.sum(F.length("text") / 2 + 1)).first()[0] or 0
    passes = int(held // PASS_WORDS) + 1
    for i in range(passes):
        part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(passes)) == i)
        yield [(r.item, r.text.encode()) for r in part.collect()]


def _ranged(begin: np.ndarray, length: int, n: int) -> np.ndarray:
    """Marks of the words in any occurrence."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, begin, 1)
    np.add.at(edge, begin + length, -1)
    return np.cumsum(edge)[:-1] > 0


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    prefix: str = "",
) -> DataFrame:
    """``docs`` with ``n_words, hit_words, hit_items`` of each row added.

    ``hit_words`` has a byte per word of the text, 1 where the word lies in an occurrence
    of a benchmark window; ``hit_items`` are the items with an occurring window, sorted as
    strings, each once (an item id that is null counts as the empty string). A null or
    empty text or item has no words. ``prefix`` goes before the names of the new columns;
    input columns of those names are replaced. Rows keep their columns and are looked at
    one by one, in the tasks that read them: no shuffle. The benchmark is split into
    passes of bounded size, chained in the same tasks, so it may be of any size.
    """
    n_words, hit_words, hit_items = (f"{prefix}{c}" for c in ("n_words", "hit_words", "hit_items"))
    out = docs.drop(n_words, hit_words, hit_items).withColumns(
        {
            n_words: F.lit(0).cast("bigint"),
            hit_words: F.lit(None).cast("binary"),
            hit_items: F.array().cast("array<string>"),
        }
    )
    for items in _passes(benchmark, item_col, item_text_col):
        sent = docs.sparkSession.sparkContext.broadcast((compiled(items, window), [n for n, _ in items]))
        out = _one_pass(out, sent, text_col, (n_words, hit_words, hit_items))
    return out


def _one_pass(docs: DataFrame, sent, text_col: str, names: tuple[str, str, str]) -> DataFrame:
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, labels = sent.value
        for batch in batches:
            at = {n: batch.schema.get_field_index(n) for n in (text_col, *names)}
            texts = texts_of(batch.column(at[text_col]))
            marks = batch.column(at[names[1]]).to_pylist()
            items = batch.column(at[names[2]]).to_pylist()
            counts: list[int] = []
            for a, b in blocks(texts):
                words = Words(texts[a:b], ALNUM)
                counts += np.diff(words.first).tolist()
                _search(groups, labels, words, a, marks, items)
            columns = list(batch.columns)
            columns[at[names[0]]] = pa.array(counts, pa.int64())
            columns[at[names[1]]] = pa.array(marks, pa.binary())
            columns[at[names[2]]] = pa.array(items, pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, schema)


def _search(groups, labels, words: Words, base: int, marks: list, items: list) -> None:
    """Add the occurrences in a block of texts to ``marks`` and ``items`` from ``base`` on."""
    hit = np.zeros(len(words), bool)
    met: dict[int, set[str]] = {}
    for patterns in groups:
        begin, which = patterns.search(words)
        if len(begin):
            hit |= _ranged(begin, patterns.length, len(words))
            doc = np.searchsorted(words.first, begin, side="right") - 1
            for d, i in np.unique(np.stack((doc, patterns.items[which])), axis=1).T.tolist():
                met.setdefault(d, set()).add(labels[i])
    for d, names in met.items():
        own = hit[words.first[d] : words.first[d + 1]].astype(np.uint8)
        if marks[base + d]:
            own |= np.frombuffer(marks[base + d], np.uint8)
        marks[base + d] = own.tobytes()
        items[base + d] = sorted({*(items[base + d] or ()), *names})


def digest(names: list[str]) -> str:
    """SHA-256 of the comma-joined names, as lowercase hex."""
    return hashlib.sha256(",".join(names).encode()).hexdigest()
