"""Ranked search, collocations and license scans against plain Python."""

import math
import random
import re
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from helpers import alnum_words, no_docs, odd_docs, odd_rows, prose  # noqa: E402
from siltstone.llm import collocations as C  # noqa: E402
from siltstone.llm import licenses, ranked  # noqa: E402
from siltstone.llm.bytesets import ALNUM  # noqa: E402
from siltstone.llm.lexicon import Lexicon, cut_words, numbered  # noqa: E402
from siltstone.llm.trie import DoubleArray  # noqa: E402


def _thue_morse(size: int, first: str) -> bytes:
    flip = {"a": "b", "b": "a"}
    text = first
    while len(text) < size:
        text += "".join(flip[c] for c in text)
    return text.encode()


def test_lexicon_compares_words():
    rng = random.Random(3)
    words = sorted({"".join(rng.choices("abc", k=rng.randrange(1, 30))).encode() for _ in range(500)})
    twins = [_thue_morse(1024, "a"), _thue_morse(1024, "b")]
    lexicon = Lexicon([*words[::2], twins[0]])
    cut = cut_words([b" ".join([*words, *twins]), b"", b"..", b"x" * 100_000], ALNUM)
    found = lexicon.find(cut.data, cut.start, cut.stop)
    listed = {w: i for i, w in enumerate([*words[::2], twins[0]])}
    assert found.tolist() == [listed.get(cut.word(i), -1) for i in range(len(cut.start))]
    where, which = numbered(cut.data, cut.start, cut.stop)
    assert [cut.word(w) for w in where[which]] == [cut.word(i) for i in range(len(cut.start))]
    assert len(where) == len({cut.word(i) for i in range(len(cut.start))})
    assert Lexicon([]).find(cut.data, cut.start, cut.stop).max() == -1


def test_double_array():
    rng = np.random.default_rng(4)
    rows = np.unique(np.minimum(rng.geometric(0.01, (4000, 3)), 900), axis=0).astype(np.int32)
    rows[::3, 2] = -1
    rows[::7, 1:] = -1
    trie = DoubleArray(rows)
    known = {tuple(r[: n + 1].tolist()) for r in rows for n in range(3) if r[n] >= 0}
    asked = rng.integers(0, 950, (5000, 3))
    asked[:2000] = rows[rng.integers(0, len(rows), 2000)]
    state = np.zeros(len(asked), np.int64)
    for level in range(3):
        state = np.where(state >= 0, trie.step(np.maximum(state, 0), asked[:, level]), -1)
        want = [tuple(a[: level + 1].tolist()) in known for a in asked]
        assert (state >= 0).tolist() == want
    assert len(set(trie.end.tolist())) == len({tuple(r.tolist()) for r in rows})


def _ranked_by_force(docs, items, k):
    held = [(d, Counter(alnum_words(t))) for d, t in docs if t is not None]
    held = [(d, c, c.total()) for d, c in held if c]
    n, total = len(held), sum(size for *_, size in held)
    df = Counter(w for _, c, _ in held for w in c)
    asked: dict = {}
    for item, text in items:
        if text is not None:
            asked.setdefault(item, set()).update(alnum_words(text))
    out = []
    for item, terms in asked.items():
        scores = []
        for d, counts, size in held:
            m = 10 + (90 * size * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1)))
                * ((10**9 * counts[w]) // (1000 * counts[w] + 8 * m))
                for w in terms
                if w in counts
            )
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, i + 1, s[3], -s[0]) for i, s in enumerate(sorted(scores, key=lambda s: s[:3])[:k])]
    return sorted(out, key=repr)


def _items(spark, rows):
    return spark.createDataFrame(rows, "item_id string, text string, doc_id string")


@pytest.mark.parametrize("k", [1, 3, 10])
def test_ranked_search(spark, monkeypatch, k):
    monkeypatch.setattr(ranked, "INDEX_BLOCK", 4000)
    monkeypatch.setattr(ranked, "PASS_CHARS", 300)
    rng = random.Random(k)
    docs = [(i, prose(rng, rng.randrange(1, 120), 80)) for i in range(300)]
    docs += [docs[0], docs[0], (None, docs[1][1]), (None, None), (7, ""), (8, " -- ")]
    items = [(f"q{i}", prose(rng, rng.randrange(1, 30), 160), "x") for i in range(20)]
    items += [items[0], ("q1", "w1 extra", "x"), ("none", None, "x"), ("", "", "x"), (None, "W1 w2", "x")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    got = ranked.search(frame, _items(spark, items), k=k).collect()
    assert sorted((tuple(r) for r in got), key=repr) == _ranked_by_force(docs, [i[:2] for i in items], k)


def test_accumulators_stop_early():
    """Common terms make no accumulators once rare ones lead, and the best are still exact."""
    rng = np.random.default_rng(1)
    texts = [b"rare " * 3 + b"common"] * 3 + [b"common " * int(n) for n in rng.integers(1, 4, 500)]
    lexicon = Lexicon([b"rare", b"common"])
    sizes, term, place, tf = ranked.postings(texts, lexicon)
    weights = ranked.Weights(np.array([5000, 1]), len(texts), int(sizes.sum()), [], 2)
    block = ranked.Block(sizes, np.array([0, 1]), np.array([3, 503]), place, tf, weights)
    at, score = block.best(np.array([0, 1]), 2, 0)
    assert at.tolist() == [0, 1, 2] and len(set(score.tolist())) == 1
    everything = np.zeros(len(texts), np.int64)
    np.add.at(everything, block.place, block.part)
    assert score.tolist() == everything[:3].tolist()
    assert len(block.best(np.array([0, 1]), 2, int(everything.max()) + 10**9)[0]) == 0


def test_ranked_search_of_odd_rows(spark):
    items = _items(spark, [("a", "quick fox word1", "x"), ("b", "日本語 café", "x"), ("c", None, "x")])
    got = ranked.search(odd_docs(spark), items).collect()
    want = _ranked_by_force([r[:2] for r in odd_rows()], [("a", "quick fox word1"), ("b", "日本語 café")], 10)
    assert sorted((tuple(r) for r in got), key=repr) == want
    assert ranked.search(no_docs(spark), items).count() == 0
    assert ranked.search(odd_docs(spark), items.filter("FALSE")).count() == 0


def _collocations_by_force(rows, least, top, per_cent):
    counts: dict = {}
    total: Counter = Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub(r"[A-Z]+", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            own = counts.setdefault(lang, Counter())
            for n in (1, 2, 3):
                own.update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, own in counts.items():
        held = {p: a for p, a in own.items() if a >= least}
        ranked_ones = []
        for p, a in held.items():
            longer = [b for q, b in held.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if len(p) == 1 or any(100 * b >= per_cent * a for b in longer):
                continue
            cuts = [(10**6 * a * a // (held[p[:k]] * held[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            ranked_ones.append((-score, -a, " ".join(p).encode(), held[p[:k]], held[p[k:]]))
        for i, (score, a, phrase, left, right) in enumerate(sorted(ranked_ones)[:top]):
            out.append((lang, i + 1, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def _phrase_rows(rng):
    rows = []
    for i in range(200):
        words = [rng.choice(["Of the", "a", "new  york", "x\ty", "ä", "of", "the", "end"]) for _ in range(rng.randrange(1, 25))]
        rows.append((rng.choice([" ", ". ", ", ", "\n"]).join(words) + rng.choice(["", "!", "\x0b a"]), rng.choice(["en", "EN", None, ""])))
    return rows + [rows[0], (None, "en"), ("", None), ("a " * 3000, "long")]


@pytest.mark.parametrize("tries", [1_000_000, 30])
def test_collocations(spark, monkeypatch, tries):
    monkeypatch.setattr(C, "PART_CHARS", 5000)
    rows = _phrase_rows(random.Random(6))
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], "text string, lang string, phrase string, n int")
    got = C.collocations(frame.repartition(3), least=3, top=15, trie_phrases=tries).collect()
    want = _collocations_by_force(rows, 3, 15, 50)
    assert sorted(tuple(r) for r in got) == want
    assert len(want) > 20


def test_more_tries_do_not_read_the_texts_more_often(spark):
    rows = _phrase_rows(random.Random(6))

    def rows_read(tries):
        seen = spark.sparkContext.accumulator(0)

        def noted(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        frame = spark.createDataFrame(rows, "text string, lang string").mapInArrow(noted, "text string, lang string")
        assert C.collocations(frame, least=3, trie_phrases=tries).count() > 20
        return seen.value

    assert rows_read(20) == rows_read(1_000_000)


def test_collocations_of_odd_rows(spark):
    got = C.collocations(odd_docs(spark), least=2).collect()
    want = _collocations_by_force([(r[1], r[2]) for r in odd_rows()], 2, 2000, 50)
    assert sorted(tuple(r) for r in got) == want
    assert C.collocations(no_docs(spark)).count() == 0
    assert C.collocations(odd_docs(spark), least=10**6).count() == 0


APACHE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in\n'
    " * compliance with the License. You may obtain a copy of the License at"
)
LICENSED = {
    "apache license tribe": ("apache", "apache"),
    "an apache tribe signed a license under the version of 2 0": ("", ""),
    APACHE: ("apache", "apache,apache-2.0"),
    f"mit license. {'filler words here ' * 40} {APACHE} {'more ' * 30} cc  BY": (
        "apache,cc-by,mit",
        "apache,apache-2.0,cc-by,mit",
    ),
    licenses.WORDINGS[8].text.replace("without limitation ", "").upper(): ("", "mit"),
    licenses.WORDINGS[8].text.split("documentation")[0]: ("", ""),
    "cc BY-NC 4.0 and licensed under CC BY-NC 4.0!": ("cc-by", "cc-by,cc-by-nc-4.0"),
    " ".join(["license"] * 5000): ("", ""),
}


def _base_by_force(text):
    words = alnum_words(text)
    spots = []
    for phrase, label in licenses.BASE.items():
        own = alnum_words(phrase)
        spots += [(i, label, i + len(own)) for i in range(len(words)) if words[i : i + len(own)] == own]
    return len(words), sorted(spots)


def test_license_scan(spark):
    rng = random.Random(8)
    common = [prose(rng, 60) + " the of and to in license version" for _ in range(60)]
    rows = [(i, t, "x") for i, t in enumerate([*LICENSED, *common, None, "", APACHE * 300])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_words string").repartition(4)
    got = {r.doc_id: r for r in licenses.license_scan(docs).collect()}
    assert len(got) == len(rows)
    for i, text, _ in rows:
        n, spots = _base_by_force(text)
        assert got[i].n_words == n
        assert [tuple(s) for s in got[i].base_spans] == [(label, a, b) for a, label, b in sorted((a, l, b) for a, l, b in spots)]
    for i, (base, labels) in enumerate(LICENSED.values()):
        own = {s.label for s in got[i].base_spans}
        assert ",".join(sorted(own)) == base
        assert ",".join(sorted(own | {w.label for w in got[i].wordings})) == labels, list(LICENSED)[i]
    whole = next(w for w in got[2].wordings if w.label == "apache-2.0")
    assert (whole.start, whole.share) == (0, 1.0)


def test_license_scan_of_odd_rows(spark):
    got = licenses.license_scan(odd_docs(spark), prefix="__")
    rows = got.select("doc_id", "text", "__n_words", "__base_spans", "__wordings").collect()
    assert len(rows) == len(odd_rows()) and all(r[2] == len(alnum_words(r.text)) for r in rows)
    assert not any(r[3] or r[4] for r in rows)
    assert licenses.license_scan(no_docs(spark)).count() == 0
