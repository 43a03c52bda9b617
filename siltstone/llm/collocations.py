"""Phrase collocations by double-array tries of candidate phrases (operator 12).

A phrase can only be frequent if all its parts are, and if the hash bucket it falls into is.

1. Words and pairs of neighbours are counted by bucket. Tasks pass on sorted buckets, packed
   by part of the hash space, so what one task adds up is bounded. The buckets that reach
   the least count are kept in a bit table of fixed size: it may let more phrases through,
   never fewer.
2. The words and pairs in such buckets, and the triples whose two pairs are, go to the part
   of their hash, once for each block of texts, with how often the block has them. In a
   part, those that cannot reach the least count are dropped; the others are its candidates.
3. A part's candidates go into double-array tries of bounded size, over word numbers below
   one root per language. The phrases that the part got step through them together, level by
   level, and the candidates that end in their states are counted. These counts alone make
   the result. A part has a bounded share of the texts and meets its own candidates only, so
   the texts are read as often for many candidates as for few.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.bytesets import END, blocks, mixed, ragged, texts_of
from siltstone.llm.lexicon import Cut, Lexicon, chained, cut_joined, cut_words, keys_of, new_seed, numbered
from siltstone.llm.trie import DoubleArray
from siltstone.session import scratch_path

WORDS = 3
#: Candidates in one trie; about 100 bytes each in a task.
TRIE_PHRASES = 1_000_000
#: Characters of text whose buckets are added up in one group.
PART_CHARS = 16_000_000
#: Words of 64 bits in the table of frequent buckets.
TABLE = 1 << 20
_U = np.uint64
#: Parts a language's name from a phrase; it never occurs in UTF-8.
_SPLIT = 0xFE
#: Entries of one row.
_CHUNK = 1 << 16
#: Entries that step through a trie together.
_STEPPED = 1 << 18

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E), END]] = True
_APART = _BREAK.copy()
_APART[[0x20, 0x09]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, END]] = True
_ENTRY = _BLANK.copy()
_ENTRY[_SPLIT] = True


def pieces_of(texts: list[bytes]) -> tuple[Cut, np.ndarray]:
    """Words of the texts, and for each whether the next one follows in the same piece."""
    cut = cut_words(texts, _APART)
    follows = np.zeros(len(cut.start), bool)
    if len(cut.start):
        broken = np.cumsum(_BREAK[cut.data], dtype=np.int32)
        follows[:-1] = broken[cut.start[1:]] == broken[cut.start[:-1]]
    return cut, follows


def _lang_keys(langs: pa.Array, seed: int) -> np.ndarray:
    """Key of each row's language."""
    coded = langs.dictionary_encode()
    names = [x.encode() for x in coded.dictionary.to_pylist()]
    length = np.fromiter(map(len, names), np.int64, len(names))
    stop = np.cumsum(length)
    keys = keys_of(np.frombuffer(b"".join(names), np.uint8), stop - length, stop, seed)
    return keys[coded.indices.to_numpy()]


def _levels(cut: Cut, follows: np.ndarray, lang_keys: np.ndarray, seed: int) -> tuple[np.ndarray, ...]:
    """Keys of the words and of the pairs that begin at each word, with its language."""
    plain = keys_of(cut.data, cut.start, cut.stop, seed)
    words = chained(lang_keys[cut.of()], plain)
    pairs = np.zeros(len(words), np.uint64)
    pairs[:-1] = chained(words[:-1], plain[1:])
    return plain, words, pairs


def _bits(bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a bucket stands in the table, and its two bits there."""
    drawn = mixed(bucket)
    one, two = drawn & _U(63), (drawn >> _U(6)) & _U(63)
    return (drawn >> _U(44)).astype(np.int64) % TABLE, _U(1) << one | _U(1) << two


@dataclass
class Buckets:
    """Hash buckets of keys: a part of the hash space and 40 bits in it."""

    parts: int

    def part(self, keys: np.ndarray) -> np.ndarray:
        return (keys & _U(0xFFFFF)) % _U(self.parts)

    def of(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> _U(24)) * _U(self.parts) + self.part(keys)

    def holds(self, table: np.ndarray, keys: np.ndarray) -> np.ndarray:
        at, bits = _bits(self.of(keys))
        return table[at] & bits == bits


def _packed(keys: list[np.ndarray], buckets: Buckets, least: int) -> pa.RecordBatch:
    """A batch's buckets with their counts (up to ``least``), one row per part."""
    bucket, count = np.unique(buckets.of(np.concatenate(keys)), return_counts=True)
    part, name = bucket % _U(buckets.parts), bucket // _U(buckets.parts)
    order = np.argsort(part, kind="stable")
    part, name, count = part[order].astype(np.int64), name[order], np.minimum(count[order], least)
    parts, first = np.unique(part, return_index=True)
    ends = np.append(first[1:], len(part))
    low, high = name.astype(np.uint32), (name >> _U(32)).astype(np.uint8)
    count = count.astype(np.uint8 if least < 256 else np.uint32)
    columns = [pa.array(parts, pa.int64())]
    for values in (low, high, count):
        columns.append(pa.array([values[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()))
    return pa.RecordBatch.from_arrays(columns, ["part", "low", "high", "count"])


def _frequent_buckets(texts: DataFrame, buckets: Buckets, least: int, seed: int) -> np.ndarray:
    """Table of the buckets that words and pairs reach ``least`` times."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, langs, keys = texts_of(batch.column(1)), _lang_keys(batch.column(0), seed), []
            for a, b in blocks(rows):
                cut, follows = pieces_of(rows[a:b])
                _, words, pairs = _levels(cut, follows, langs[a:b], seed)
                keys += [words, pairs[follows]]
            if keys:
                yield _packed(keys, buckets, least)

    kind = np.uint8 if least < 256 else np.uint32

    def add_up(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        low, high, count = (
            np.frombuffer(b"".join(table.column(c).to_pylist()), k)
            for c, k in (("low", np.uint32), ("high", np.uint8), ("count", kind))
        )
        name = high.astype(np.uint64) << _U(32) | low
        order = np.argsort(name, kind="stable")
        name, count = name[order], count[order].astype(np.int64)
        first = np.flatnonzero(np.append(True, name[1:] != name[:-1]))
        full = np.add.reduceat(count, first) >= least
        at, bits = _bits(name[first[full]] * _U(buckets.parts) + _U(part))
        return pa.table({"at": pa.array(at, pa.int64()), "bits": pa.array(bits.view(np.int64))})

    packed = texts.mapInArrow(pack, "part bigint, low binary, high binary, count binary")
    full = packed.groupBy("part").applyInArrow(add_up, "at bigint, bits bigint")
    rows = full.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()  # TABLE rows at most
    table = np.zeros(TABLE, np.uint64)
    table[rows.column("at").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return table


class _Entries:
    """Phrases of a block of texts as bytes: the language, the phrase, each with its end.

    The language is closed by a byte that no text holds, so is the phrase, whose words are
    joined by a blank.
    """

    def __init__(self, cut: Cut, lang: np.ndarray, names: list[bytes]):
        extra = b" " + bytes([_SPLIT]) + bytes([END]) + b"".join(names)
        self.cut, self.lang = cut, lang
        self.blank = len(cut.data)
        self.data = np.concatenate((cut.data, np.frombuffer(extra, np.uint8)))
        self.size = np.fromiter(map(len, names), np.int64, len(names))
        self.begin = self.blank + 3 + np.cumsum(self.size) - self.size

    def of(self, at: np.ndarray, words: int) -> list[bytes]:
        """The phrases of ``words`` words that begin at the words ``at``."""
        start = np.empty((len(at), 2 * words + 2), np.int64)
        length = np.ones_like(start)
        lang = self.lang[at]
        start[:, 0], length[:, 0] = self.begin[lang], self.size[lang]
        start[:, 1] = self.blank + 1
        for j in range(words):
            start[:, 2 + 2 * j] = self.cut.start[at + j]
            length[:, 2 + 2 * j] = self.cut.stop[at + j] - self.cut.start[at + j]
            start[:, 3 + 2 * j] = self.blank
        start[:, -1] = self.blank + 2
        raw = ragged(self.data, start.ravel(), length.ravel()).tobytes()
        ends = np.cumsum(length.sum(axis=1)).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def packed(self, at: np.ndarray, count: np.ndarray, part: np.ndarray, words: int) -> Iterator[pa.RecordBatch]:
        """Rows of one part each: entries sorted by their bytes, and their counts."""
        order = np.argsort(part, kind="stable")
        edges = np.flatnonzero(np.diff(part[order], prepend=-1)).tolist() + [len(order)]
        names = ["part", "words", "entries", "bytes", "counts", "held"]
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.int64()]
        for first, last in zip(edges, edges[1:]):
            for a in range(first, last, _CHUNK):
                own = order[a : min(a + _CHUNK, last)]
                texts = self.of(at[own], words)
                sort = sorted(range(len(texts)), key=texts.__getitem__)
                entries = b"".join([texts[i] for i in sort])
                counts = count[own][sort].astype(np.uint32).tobytes()
                made = [pa.compress(x, "zstd", asbytes=True) for x in (entries, counts)]
                row = (int(part[own[0]]), words, made[0], len(entries), made[1], len(counts))
                yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names)


def _strings(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.Array:
    """Byte spans as strings."""
    made = ragged(data, start, stop - start)
    ends = np.concatenate(([0], np.cumsum(stop - start)))
    whole = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(ends.tobytes()), pa.py_buffer(made.tobytes()))
    return whole.cast(pa.string())


_COUNTS = ["lang", "phrase", "words", "a"]


def _all_words(names: list[str], words: np.ndarray) -> pa.RecordBatch:
    """Words of each language, beside the rows of phrases."""
    size = len(names)
    columns = [
        pa.array([-1] * size, pa.int64()),
        pa.array([0] * size, pa.int32()),
        pa.array([x.encode() for x in names], pa.binary()),
        pa.array([0] * size, pa.int64()),
        pa.nulls(size, pa.binary()),
        pa.array(words.astype(np.int64)),
    ]
    return pa.RecordBatch.from_arrays(columns, ["part", "words", "entries", "bytes", "counts", "held"])


def _counted(
    texts: DataFrame, table: np.ndarray, buckets: Buckets, least: int, seed: int, trie_phrases: int
) -> DataFrame:
    """``lang, phrase, words, a`` of the phrases that occur ``least`` times.

    Tasks pass on each part's phrases sorted and compressed, with their counts. All words of a
    language are a row of their own, with no phrase and ``words`` 0.
    """
    sent = texts.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, langs = texts_of(batch.column(1)), _lang_keys(batch.column(0), seed)
            coded = batch.column(0).dictionary_encode()
            own, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            names, total = [x.encode() for x in own], np.zeros(len(own))
            for a, b in blocks(rows, 4 << 20):
                cut, follows = pieces_of(rows[a:b])
                plain, words, pairs = _levels(cut, follows, langs[a:b], seed)
                total += np.bincount(code[a:b], np.diff(cut.first), len(names))
                entries = _Entries(cut, code[a:b][cut.of()], names)
                live = buckets.holds(sent.value, pairs) & follows
                triples = np.zeros(len(words), np.uint64)
                triples[:-2] = chained(pairs[:-2], plain[2:])
                both = live.copy()
                both[:-1] &= live[1:]
                both[-1:] = False
                sets = ((words, buckets.holds(sent.value, words)), (pairs, live), (triples, both))
                for number, (keys, chosen) in enumerate(sets, 1):
                    place = np.flatnonzero(chosen)
                    met, where, count = np.unique(keys[place], return_index=True, return_counts=True)
                    part = buckets.part(met).astype(np.int64)
                    yield from entries.packed(place[where], count, part, number)
            yield _all_words(own, total)

    def add_up(table: pa.Table) -> pa.Table:
        size = table.column("words")[0].as_py()
        if not size:
            total = table.select(["entries", "held"]).group_by("entries").aggregate([("held", "sum")])
            names = total["entries"].combine_chunks().cast(pa.string())
            none = pa.nulls(len(total), pa.string())
            return pa.table([names, none, pa.array([0] * len(total), pa.int32()), total["held_sum"]], names=_COUNTS)
        data, count = (
            np.frombuffer(b"".join(pa.decompress(x, n, "zstd", asbytes=True) for x, n in zip(*pair)), kind)
            for *pair, kind in (
                (table.column("entries").to_pylist(), table.column("bytes").to_pylist(), np.uint8),
                (table.column("counts").to_pylist(), table.column("held").to_pylist(), np.uint32),
            )
        )
        del table
        stop = np.flatnonzero(data == END)
        start = np.concatenate(([0], stop[:-1] + 1))
        middle = np.flatnonzero(data == _SPLIT)
        where, which = numbered(data, start, stop)
        where = where[np.bincount(which, np.minimum(count, least)) >= least]
        del which
        langs = _strings(data, start[where], middle[where])
        phrases = _strings(data, middle[where] + 1, stop[where])
        del where
        own = np.zeros(len(langs), np.int64)
        for a in range(0, len(langs), trie_phrases):
            trie = PhraseTrie(langs[a : a + trie_phrases], phrases[a : a + trie_phrases])
            for b in range(0, len(stop), _STEPPED):
                some = slice(b, b + _STEPPED)
                found, nth = trie.ends(data, start[some], middle[some], stop[some], size)
                own[a : a + trie.phrases] += np.bincount(found, count[some][nth], trie.phrases).astype(np.int64)
        enough = np.flatnonzero(own >= least)
        words = pa.array(np.full(len(enough), size, np.int32))
        return pa.table([langs.take(enough), phrases.take(enough), words, pa.array(own[enough])], names=_COUNTS)

    packed = texts.mapInArrow(
        run, "part bigint, words int, entries binary, bytes bigint, counts binary, held bigint"
    )
    return packed.groupBy("part", "words").applyInArrow(add_up, "lang string, phrase string, words int, a bigint")


class PhraseTrie:
    """Candidates of all languages in one double array; ``accept`` names them by position."""

    def __init__(self, langs: pa.Array, phrases: pa.Array):
        empty, end = (pa.scalar(x, pa.large_binary()) for x in (b"", b"\xff"))
        raw = pc.binary_join_element_wise(phrases.cast(pa.large_binary()), empty, end)
        begin = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
        data = np.frombuffer(raw.buffers()[2], np.uint8)[begin[0] : begin[-1]]
        cut = cut_joined(data, begin - begin[0], _BLANK)
        where, which = numbered(cut.data, cut.start, cut.stop)
        coded = langs.dictionary_encode()
        self.langs = {name: i for i, name in enumerate(coded.dictionary.to_pylist())}
        own = coded.indices.to_numpy().astype(np.int64)
        nth = np.arange(len(which)) - np.repeat(cut.first[:-1], np.diff(cut.first))
        # words of one language that often follow others get neighbouring numbers: a dense array
        lang_of = np.full(len(where), len(self.langs))
        np.minimum.at(lang_of, which, own[cut.of()])
        order = np.lexsort((-np.bincount(which[nth > 0], minlength=len(where)), lang_of))
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        self.lexicon = Lexicon.of_spans(cut.data, cut.start[where[order]], cut.stop[where[order]])
        paths = np.full((len(phrases), 1 + WORDS), -1, np.int32)
        paths[:, 0] = own + len(where)
        paths[cut.of(), 1 + nth] = number[which]
        self.phrases = len(phrases)
        self.array = DoubleArray(paths)
        self.accept = np.full(len(self.array.check), -1, np.int32)
        self.accept[self.array.end] = np.arange(len(phrases))
        del self.array.end

    def root_of(self, langs: list[str]) -> np.ndarray:
        """State of each language, -1 for one without candidates."""
        symbol = np.array([self.langs.get(x, -1) for x in langs], np.int64)
        symbol[symbol >= 0] += self.lexicon.size
        return self.array.step(np.zeros(len(symbol), np.int64), symbol)

    def accepted(self, texts: list[bytes], roots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The candidate of every accepting state that a position comes to; words of each text."""
        cut, follows = pieces_of(texts)
        number = self.lexicon.find(cut.data, cut.start, cut.stop).astype(np.int64)
        at, state = np.arange(len(number)), roots[cut.of()]
        met = []
        for level in range(WORDS):
            if level:
                on = follows[at]
                at, state = at[on] + 1, state[on]
            known = (state >= 0) & (number[at] >= 0)
            at, state = at[known], state[known]
            state = self.array.step(state, number[at])
            on = state >= 0
            at, state = at[on], state[on]
            found = self.accept[state]
            met.append(found[found >= 0])
        return np.concatenate(met), np.diff(cut.first)

    def ends(
        self, data: np.ndarray, start: np.ndarray, middle: np.ndarray, stop: np.ndarray, words: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """The candidates in whose states entries of ``words`` words end, and which entries do.

        An entry has its language from ``start`` to ``middle`` and its phrase from there to ``stop``.
        """
        begin = int(start[0]) if len(start) else 0
        data, start, middle, stop = data[begin : stop[-1] + 1 if len(stop) else 0], start - begin, middle - begin, stop - begin
        name, lang = numbered(data, start, middle)
        names = [data[a:b].tobytes().decode() for a, b in zip(start[name].tolist(), middle[name].tolist())]
        state = self.root_of(names)[lang]
        cut = cut_joined(data, middle + 1, _ENTRY)
        nth = np.arange(len(start))
        for level in range(words):
            at = cut.first[nth] + level
            number = self.lexicon.find(cut.data, cut.start[at], cut.stop[at]).astype(np.int64)
            known = (state >= 0) & (number >= 0)
            nth, state, number = nth[known], state[known], number[known]
            state = self.array.step(state, number)
            on = state >= 0
            nth, state = nth[on], state[on]
        found = self.accept[state]
        return found[found >= 0], nth[found >= 0]


_SCORE = (
    "CAST(1000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0)) "
    "div (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0)))"
)


def _scored(counts: DataFrame) -> DataFrame:
    """Phrases of two words and more with their lowest-scoring cut."""
    cuts = (
        counts.filter("words > 1")
        .select("lang", "phrase", "a", F.split("phrase", " ").alias("w"))
        .select("*", F.explode(F.expr("sequence(1, size(w) - 1)")).alias("k"))
        .select(
            "lang", "phrase", "a", "k",
            F.expr("array_join(slice(w, 1, k), ' ')").alias("head"),
            F.expr("array_join(slice(w, k + 1, size(w) - k), ' ')").alias("tail"),
        )
    )
    for part, name in (("head", "l"), ("tail", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(part), F.col("a").alias(name)), ["lang", part])
    cut = F.min(F.struct(F.expr(_SCORE).cast("bigint").alias("score"), "k", "l", "r")).alias("cut")
    return cuts.groupBy("lang", "phrase", "a").agg(cut).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def _covered(counts: DataFrame) -> DataFrame:
    """``lang, phrase, longer``: the most frequent longer candidate around a phrase."""
    w = F.split("phrase", " ")
    inner = F.explode(
        F.array(*(F.array_join(F.slice(w, i + 1, WORDS - 1), " ") for i in range(2)))
    ).alias("inner")
    around = counts.filter(F.col("words") == WORDS).select("lang", inner, "a")
    return around.groupBy("lang", F.col("inner").alias("phrase")).agg(F.max("a").alias("longer"))


def collocations(
    docs: DataFrame,
    least: int = 10,
    top: int = 2000,
    inside_per_cent: int = 50,
    text_col: str = "text",
    lang_col: str = "lang",
    trie_phrases: int = TRIE_PHRASES,
) -> DataFrame:
    """The ``top`` collocations of every language: ``lang, rank, phrase, a, l, r, n, score``.

    Candidates are phrases of two or three words inside a piece of text that occur ``least``
    times in the language's texts. ``a`` is a phrase's count, ``l`` and ``r`` those of the
    parts at its lowest-scoring cut, ``n`` all words of the language, ``score`` is
    ``floor(10**6 * a * a / (l * r))``, the first of equal cuts counts. A phrase inside a
    longer candidate that occurs in ``inside_per_cent`` of its places is left out. Order:
    score, ``a``, phrase by bytes. A null language is ``und``; null and empty texts have no
    words; repeated rows count each time; further columns are ignored. No rows give none.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "collocations")
    seed = new_seed()

    def keep(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{path}/{name}")

    texts = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text")
    )
    chars = texts.select(F.sum(F.length("text"))).first()[0] or 0
    buckets = Buckets(min(chars // PART_CHARS + 1, 1 << 20))
    table = _frequent_buckets(texts, buckets, least, seed)
    counted = keep(_counted(texts, table, buckets, least, seed, trie_phrases), "counts")
    counts = counted.filter("words > 0")
    total = counted.filter("words = 0").select("lang", F.col("a").alias("n"))

    best = _scored(counts).join(_covered(counts), ["lang", "phrase"], "left")
    best = best.filter(f"longer IS NULL OR 100 * longer < {int(inside_per_cent)} * a")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.join(total, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
