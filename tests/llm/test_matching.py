"""Near duplicates, decontamination and nearest neighbours against brute force."""

import random
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from helpers import alnum_words, components, edited, no_docs, odd_docs, odd_rows, prose, shingle_set, twin_words  # noqa: E402
from siltstone.llm import ann, decontaminate, near_dup  # noqa: E402
from siltstone.llm.components import components as linked  # noqa: E402


def copies(seed=1):
    """Groups whose members differ from a lost original by anything from little to much."""
    rng = random.Random(seed)
    texts = [prose(rng, 120) for _ in range(40)]
    for group in range(3):
        base = prose(rng, 90)
        texts += [edited(rng, base, rng.choice([0.005, 0.02, 0.04, 0.08])) for _ in range(60)]
    texts += [texts[-1]] * 30 + ["short text", "short text", "SHORT text", "another one here", "", "  "]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("block", [200_000, 900])
def test_near_duplicates(spark, monkeypatch, block):
    monkeypatch.setattr(near_dup, "BLOCK_SHINGLES", block)
    texts = copies()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    rows = {r.doc_id: r for r in near_dup.near_duplicates(docs, shingle=4).collect()}
    sets = {i: shingle_set(t, 4) for i, t in enumerate(texts)}
    want = components(sets)
    assert {i: r.n_shingles for i, r in rows.items()} == {i: len(s) for i, s in sets.items()}
    assert {i: r.component_id for i, r in rows.items()} == want
    assert {i for i, r in rows.items() if r.kept} == {i for i, c in want.items() if i == c}


def test_near_duplicates_odd_rows(spark):
    docs = odd_docs(spark)
    found = near_dup.near_duplicates(docs)
    rows = found.collect()
    assert len(rows) == len(odd_rows())
    kept = near_dup.one_per_group(docs, found)
    assert kept.columns == docs.columns
    texts = [r.text for r in kept.collect()]
    worded = [t for t in texts if t and t.strip()]
    assert len(worded) == len(set(worded)) == len({r[1] for r in odd_rows() if r[1] and r[1].strip()})
    assert sum(not (t and t.strip()) for t in texts) == sum(not (r[1] and r[1].strip()) for r in odd_rows())
    assert near_dup.near_duplicates(no_docs(spark)).count() == 0


def test_register_estimate():
    rng = np.random.default_rng(2)
    for share in (0.3, 0.8, 0.95):
        pool = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
        both = pool[: int(2000 * share)]
        a, b = np.sort(np.concatenate((both, pool[2000:2400]))), np.sort(np.concatenate((both, pool[3000:3400])))
        made = [
            near_dup.registers(near_dup.Sets(s, np.zeros(len(s), np.int64), np.array([0, len(s)])), 1) for s in (a, b)
        ]
        j, deviation = near_dup.estimate(made[0], made[1], np.array([len(a)]), np.array([len(b)]))
        true = len(both) / (len(both) + 800)
        assert abs(j[0] - true) < 5 * deviation[0]


def test_components(spark):
    rng = random.Random(8)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 560)]
    loose = [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    edges = chain + star + loose + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in linked(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    nodes = {x for e in chain + star + loose if e[0] != e[1] for x in e}
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in chain + star + loose:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    assert got == {n: root(n) for n in nodes}


def hits(text, items, window):
    words = alnum_words(text)
    marked, names = set(), set()
    for name, item in items:
        own = alnum_words(item)
        m = min(window, len(own))
        patterns = {tuple(own[i : i + m]) for i in range(len(own) - m + 1)} if m else set()
        for i in range(len(words) - m + 1 if m else 0):
            if tuple(words[i : i + m]) in patterns:
                marked.update(range(i, i + m))
                names.add(name)
    return len(words), len(marked), sorted(names)


@pytest.mark.parametrize("pass_words", [250_000, 15])
def test_benchmark_hits(spark, monkeypatch, pass_words):
    monkeypatch.setattr(decontaminate, "PASS_WORDS", pass_words)
    monkeypatch.setattr(decontaminate, "STRETCH", 7)
    rng = random.Random(4)
    items = [(str(i), prose(rng, rng.choice([1, 2, 3, 5, 9, 14]), 12)) for i in range(14)]
    items += [("x", None), ("", "  "), ("7", items[3][1])]
    texts = [prose(rng, rng.randrange(0, 60), 12) for _ in range(120)] + [t or "" for _, t in items] + [None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    for r in decontaminate.benchmark_hits(docs, bench, window=5).collect():
        want = hits(texts[r.doc_id], [(n, t) for n, t in items if t], 5)
        assert (r.n_words, sum(r.hit_words or b""), list(r.hit_items)) == want


def test_benchmark_hits_odd_rows(spark):
    docs = odd_docs(spark)
    bench = spark.createDataFrame([(1, "brown fox JUMPS over"), (None, "one two three")], "item_id bigint, text string")
    out = decontaminate.benchmark_hits(docs, bench, window=3)
    rows = out.collect()
    assert len(rows) == len(odd_rows()) and out.columns[:-3] == [c for c in docs.columns if c != "hit_words" ]
    assert sorted(r.doc_id for r in rows if r.hit_words) == [0, 0, 6, 8]
    assert [r.hit_items for r in rows if r.doc_id == 8] == [[""]]
    assert decontaminate.benchmark_hits(no_docs(spark), bench).count() == 0
    assert all(r.hit_words is None for r in decontaminate.benchmark_hits(docs, bench.limit(0)).collect())


def test_benchmark_compares_words(spark, monkeypatch):
    """Where all words have one key, only the words themselves decide."""
    one, two = twin_words()
    docs = spark.createDataFrame([(1, f"x {one} y"), (2, f"x {two} y"), (3, "a b c"), (4, "a b d")], "doc_id int, text string")
    bench = spark.createDataFrame([("p", f"{one} y"), ("q", "b c")], "item_id string, text string")
    items = {r.doc_id: list(r.hit_items) for r in decontaminate.benchmark_hits(docs, bench, window=2).collect()}
    assert items == {1: ["p"], 2: [], 3: ["q"], 4: []}
    patterns, texts = decontaminate.compiled([("q", b"b c")], 2)[0], decontaminate.Words([b"a b d b c"], decontaminate.ALNUM)
    patterns.words[:] = patterns.words[0, 0]
    begin = np.array([1, 3])
    assert patterns._alike(texts, begin, np.zeros(2, int)).tolist() == [False, True]


def test_near_duplicates_of_twin_words(spark):
    one, two = twin_words()
    rest = "a b c d e f"
    docs = spark.createDataFrame([(1, one), (2, two), (3, one), (4, f"{rest} {one}"), (5, f"{rest} {two}")], "doc_id int, text string")
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(docs, shingle=1).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5}


def nearest_by_force(rows, k):
    kept = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            kept[i] = np.array(v, float)
    out = {}
    for q, x in kept.items():
        if q % 100 == 0:
            near = sorted((float(np.sqrt(((x - y) ** 2).sum())), i) for i, y in kept.items() if i != q and len(y) == len(x))
            out[q] = near[:k]
    return out


def test_nearest(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 24))
    rows = [(i, (centres[i % 12] + rng.normal(scale=0.4, size=24)).tolist()) for i in range(1500)]
    same = rows[700][1]
    rows += [(i, same) for i in range(1500, 1560)] + [rows[3]]
    rows += [(1600, None), (1700, []), (1800, [0.0] * 24), (1801, [float("nan")] * 24), (1802, [None] + [1.0] * 23)]
    rows += [(1900, [1.0, 2.0]), (1901, [1.0, 2.5]), (None, [1.0] * 24)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = ann.nearest(vectors, vectors.filter("vec_id % 100 = 0"), k=10, shard=400).collect()
    want = nearest_by_force(rows, 10)
    found: dict = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(found[r.query_id])
    assert set(found) == set(want) and 1900 in found and len(found[1900]) == 1
    shared = sum(len({i for _, i in found[q]} & {i for _, i in want[q]}) for q in want)
    assert shared >= 0.95 * sum(map(len, want.values()))
    assert [i for _, i in found[700]] == [i for _, i in want[700]]  # ten of sixty copies, the least ids
    for q, near in found.items():
        assert near == sorted(near)
        assert np.allclose([s for s, _ in near], [s for s, _ in want[q]][: len(near)], atol=0.5)


@pytest.mark.parametrize("scale", [1e-160, 1e-25, 1.0, 1e25, 1e160])
def test_nearest_at_any_scale(spark, monkeypatch, scale):
    monkeypatch.setattr(ann, "LANE", 1)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 3)
    base = np.random.default_rng(8).normal(size=(400, 8))
    rows = [(i, (v * scale).tolist()) for i, v in enumerate(base)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    queries = vectors.filter("vec_id % 20 = 0").union(vectors.filter("vec_id = 40"))
    got = ann.nearest(vectors, queries, shard=150).collect()
    met = 0
    for q in range(0, 400, 20):
        apart = np.sqrt(((base - base[q]) ** 2).sum(axis=1))
        apart[q] = np.inf
        own = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == q)
        assert len(own) == 10 and np.allclose([s / scale for _, _, s in own], apart[[i for _, i, _ in own]])
        met += len(set(np.argsort(apart)[:10].tolist()) & {i for _, i, _ in own})
    assert met >= 0.95 * 200


def test_nearest_of_nothing(spark):
    none = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert ann.nearest(none, none).count() == 0


def test_graph_survives_packing():
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(300, 8))
    graph = ann.Graph(vectors).build()
    again = ann.Graph.unpacked(vectors, **graph.packed())
    for q in rng.normal(size=(20, 8)).astype(np.float32):
        assert graph.search(q).tolist() == again.search(q).tolist()
