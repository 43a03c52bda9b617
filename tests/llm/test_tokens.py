"""Operators on token ids: pieces, records, packing, prefix counts."""

import random
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
from helpers import no_docs, odd_docs, odd_rows, twin_words  # noqa: E402
from siltstone.llm import packing, prefix_counts, records  # noqa: E402
from siltstone.llm.bytesets import Words  # noqa: E402
from siltstone.llm.pieces import Encoder  # noqa: E402
from siltstone.session import scratch_path  # noqa: E402

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
PARTS = [
    " ", "  ", "\n", "\n\n", "\t", "'s", "'ll", "'", "''", "a", "B", "é", "Ç", "1", "22", "½", "!", "?!",
    "\x85", "\xa0", "<|", "<|endoftext|>", "<|ENDOFTEXT|>", "’", "日本", "é", "İ", "ª", "\x1c", "\x00",
    "_", "-", "----", "'re", "'VE", "'d ", "ß", "ǆ", "the", " and",
]


def strings(n, most=10, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, most))) for _ in range(n)]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_ids_are_the_librarys(path):
    texts = strings(6000)
    own = Encoder(path, bits=8)  # a table that overflows all the time
    want = Tokenizer.from_file(path).encode_batch_fast(texts, add_special_tokens=False)
    for text, got, expected in zip(texts, own.encode([t.encode() for t in texts]), want):
        assert got.tolist() == expected.ids, repr(text)


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_twin_words_keep_their_ids(path):
    one, two = twin_words()
    texts = [one, two, f"{two} {one}", one[:8], two[:8], one[:16], two[:16], "\x00", "\x00\x00", one * 3, two * 3]
    want = Tokenizer.from_file(path).encode_batch_fast(texts, add_special_tokens=False)
    got = Encoder(path).encode([t.encode() for t in texts])
    assert [g.tolist() for g in got] == [w.ids for w in want]


def test_keys_of_words():
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("ab") for _ in range(n)) for n in range(1, 300) for _ in range(3)})
    words += [*twin_words(), *twin_words(4096)]
    apart = np.concatenate([Words([w.encode()]).keys for w in words])
    assert len(set(apart.tolist())) == len(words)
    assert np.array_equal(Words([" ".join(words).encode()]).keys, apart)  # wherever a word stands


def test_every_prefix_count():
    own = prefix_counts.PrefixCounter(BYTE)
    texts = strings(800)
    for text, got in zip(texts, own.counts([t.encode() for t in texts])):
        prefixes = [text[: i + 1] for i in range(len(text))]
        want = own.library.encode_batch_fast(prefixes, add_special_tokens=False)
        assert got.tolist() == [len(e.ids) for e in want], repr(text)


def test_prefix_operator(spark):
    rows = prefix_counts.prefix_token_counts(odd_docs(spark), BYTE, budget=5).collect()
    library = Tokenizer.from_file(BYTE)
    texts = sorted((r[1] or "") for r in odd_rows())
    assert len(rows) == len(texts)
    for row in rows:
        counts = prefix_counts.unpacked(row.prefix_counts)
        assert row.n_tokens == (counts[-1] if len(counts) else 0)
        fits = [i + 1 for i, c in enumerate(counts) if c <= 5]
        assert row.prefix_chars == (fits[-1] if fits else 0)
    want = sorted((len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for t in texts)
    assert sorted((r.n_bytes, r.n_tokens) for r in rows) == want
    assert prefix_counts.prefix_token_counts(no_docs(spark), BYTE).count() == 0


def test_counter_refuses_lossy_vocabulary():
    with pytest.raises(ValueError):
        prefix_counts.PrefixCounter(WORD)


def brute_records(rows, end):
    library = Tokenizer.from_file(BYTE)
    out = defaultdict(list)
    for doc, text in rows:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [end], "<u4")
        out[doc].append((len(ids), zlib.crc32(ids.tobytes())))
    return out


def test_records_round_trip(spark):
    folder = scratch_path(spark, "records")
    docs = odd_docs(spark).repartition(3)
    manifest = records.write_records(docs, folder, BYTE, end_id=2)
    got = records.read_records(spark, folder).orderBy("start").collect()
    want = brute_records([(r[0], r[1]) for r in odd_rows()], 2)
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in got), key=lambda x: -1 if x is None else x)
    assert [r.start for r in got] == list(np.cumsum([0] + [r.n_tokens for r in got])[:-1])
    found = defaultdict(list)
    for r in got:
        found[r.doc_id].append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}
    assert manifest.agg(F.sum("records")).first()[0] == len(odd_rows())

    mixed = records.shuffled_records(spark, folder, seed=4).collect()
    crcs = sorted(zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in mixed)
    assert crcs == sorted(r.ids_crc32 for r in got)
    assert sorted(r.place for r in mixed) == [r.place for r in sorted(mixed, key=lambda r: r.place)]
    other = records.shuffled_records(spark, folder, seed=5).collect()
    assert {r.place for r in other} != {r.place for r in mixed}


def test_records_of_nothing(spark):
    folder = scratch_path(spark, "records")
    records.write_records(no_docs(spark), folder, BYTE, end_id=2)
    assert records.read_records(spark, folder).count() == 0


def test_broken_frames():
    data = records.frame(7, np.array([1, 2, 3]), 2) + records.frame(None, np.array([70_000]), 4)
    assert [(d, i.tolist()) for d, i in records.frames(data)] == [(7, [1, 2, 3]), (None, [70_000])]
    for at in (0, 9, 15, len(data) - 1):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            list(records.frames(bytes(broken)))
    with pytest.raises(ValueError):
        list(records.frames(data[:-5]))


def checked_packing(rows, wanted, size):
    """Each id in one piece, sequences without gaps; returns the padding."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    padding = 0
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        assert end <= size
        padding += 0 if end & (end - 1) == 0 else size - end
    for doc, ids in wanted.items():
        at = 0
        for start, length, crc, total in sorted(pieces.pop(doc)):
            assert start == at and total == len(ids)
            assert crc == zlib.crc32(ids[start : start + length].astype("<u4").tobytes())
            at += length
        assert at == len(ids)
    assert not pieces
    return padding


@pytest.mark.parametrize("parts", [1, 9])
def test_packing(spark, parts):
    rng = random.Random(parts)
    texts = [(i, " ".join(f"w{rng.randrange(500)}" for _ in range(rng.randrange(0, 400)))) for i in range(600)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(parts)
    rows = packing.pack(docs, WORD, end_id=1, size=256, windows=4).collect()
    library = Tokenizer.from_file(WORD)
    want = {i: np.array(library.encode(t, add_special_tokens=False).ids + [1], np.uint32) for i, t in texts}
    padding = checked_packing(rows, want, 256)
    assert padding <= 0.02 * sum(map(len, want.values()))


def test_merging_takes_rounds(spark, monkeypatch):
    monkeypatch.setattr(packing, "FAN_IN", 2)
    docs = spark.range(40).selectExpr("id AS doc_id", "concat('w ', id) AS text").repartition(7)
    rows = packing.pack(docs, WORD, end_id=1, size=64).collect()
    library = Tokenizer.from_file(WORD)
    want = {i: np.array(library.encode(f"w {i}", add_special_tokens=False).ids + [1], np.uint32) for i in range(40)}
    assert checked_packing(rows, want, 64) == 0


def test_packing_odd_rows(spark):
    rows = packing.pack(odd_docs(spark), WORD, end_id=1).collect()
    library = Tokenizer.from_file(WORD)
    want = [len(library.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in odd_rows()]
    assert sum(r.length for r in rows) == sum(want)
    assert packing.pack(no_docs(spark), WORD, end_id=1).count() == 0
