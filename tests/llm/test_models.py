"""Trained operators: held-out accuracy, exact base counts, causality, odd rows."""

import collections
import math
import random
import sys
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from helpers import no_docs, odd_docs, odd_rows, prose, spaced_words  # noqa: E402
from siltstone.llm import attention, cotrain, lm, toxicity  # noqa: E402
from siltstone.llm.pieces import encoder  # noqa: E402
from siltstone.llm.fitting import best_threshold, bounded_sample, calibration, logistic, remainder, sigmoid  # noqa: E402

BYTE = public_tokenizers.path("byte_bpe_50k.json")


def labelled(spark, n=1200, seed=2):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = prose(rng, rng.randrange(5, 120), 4000).split()
        toxic, bad = rng.random() < 0.2, rng.random() < 0.3
        for _ in range(rng.randrange(1, 4) if toxic else 0):
            words.insert(rng.randrange(len(words)), f"vilest{rng.choice('abcdefgh')}")
        if bad:
            words = [w + rng.choice(["***", "$$$"]) for w in words]
        text = " ".join(words)
        docs.append((i, text, rng.choice(["en", "de"]), f"src{i % 5}", len(text)))
        labels.append((i, int(not bad), int(toxic)))
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint"),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
    )


def test_toxicity_held_out(spark):
    docs, labels = labelled(spark)
    rest = remainder("doc_id", 3)
    net = toxicity.fit(docs, labels, learn_from=rest != 1)
    rows = toxicity.with_toxicity(docs, net).join(labels, "doc_id").filter(rest == 1).collect()
    right = sum((r.score >= 0.7) == bool(r.toxic) for r in rows)
    assert len(rows) > 300 and right >= 0.95 * len(rows)
    assert set(net.thresholds) == {"en", "de"} and all(0 < t < 1 for t in net.thresholds.values())


def test_toxicity_odd_rows(spark):
    docs, labels = labelled(spark, 200)
    net = toxicity.fit(docs, labels)
    odd = odd_docs(spark)
    rows = toxicity.with_toxicity(odd, net).collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r.score <= 1 for r in rows)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r.text or "", r.score) == r.score
    assert toxicity.with_toxicity(no_docs(spark), net).count() == 0
    for none in (labels.limit(0), labels.filter("toxic = 0")):
        flat = toxicity.fit(docs, none)
        assert toxicity.with_toxicity(docs, flat).agg(F.max("score")).first()[0] < 0.5


def test_filters_stay_in_their_text():
    net = toxicity.train([b"good words here", b"vile words here"] * 20, np.array([0.0, 1.0] * 20), epochs=1)
    texts = [b"vile", b"", b"good words", b"one two three four five vile"]
    alone = [net.logits([t])[0] for t in texts]
    assert np.allclose(net.logits(texts), alone, atol=1e-5)


def test_cotraining(spark):
    docs, labels = labelled(spark)
    seen = labels.filter(F.pmod(F.xxhash64("doc_id"), F.lit(3)) != 0)
    judge = cotrain.fit(docs, seen)
    assert min(judge.exchanged) > 0
    rows = cotrain.with_quality(docs, judge).join(labels, "doc_id").collect()
    unseen = {r.doc_id for r in labels.collect()} - {r.doc_id for r in seen.collect()}
    held = [r for r in rows if r.doc_id in unseen]
    assert sum(r.good == bool(r.quality) for r in held) >= 0.97 * len(held)


def test_cotraining_odd_rows(spark):
    docs, labels = labelled(spark, 200)
    judge = cotrain.fit(docs, labels)
    rows = cotrain.with_quality(odd_docs(spark), judge).collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r.quality_score <= 1 for r in rows)
    assert cotrain.with_quality(no_docs(spark), judge).count() == 0
    constant = cotrain.fit(docs, labels.limit(0))
    assert cotrain.with_quality(docs, constant).filter("NOT good").count() == 0
    worst = cotrain.fit(docs, labels.filter("quality = 0"))
    assert cotrain.with_quality(docs, worst).filter("good").count() == 0


def test_views_are_apart():
    """The metadata view does not change when words are exchanged for others alike."""
    one, two = [b"abc def\nGhi 12!"], [b"xyz uvw\nQrs 34?"]
    assert np.allclose(cotrain.layout(one), cotrain.layout(two))
    assert not np.array_equal(cotrain.content(one)[0], cotrain.content(two)[0])


def test_attention_is_causal_and_scores_once():
    rng = np.random.default_rng(0)
    texts = [rng.integers(0, 50, n) for n in (0, 1, 30, 31, 32, 33, 55, 56, 57, 200)]
    model = attention.train([rng.integers(0, 50, 400) for _ in range(4)], 51, 50, epochs=1)
    chance = model.log_chances(texts)
    assert len(chance) == sum(len(t) + 1 for t in texts) and np.isfinite(chance).all()
    at = 0
    for text in texts:
        own = chance[at : at + len(text) + 1]
        assert np.allclose(own, model.log_chances([text]), atol=1e-4)
        for cut in {0, len(text) // 2, max(len(text) - 1, 0)}:  # what comes later changes nothing
            assert np.allclose(model.log_chances([text[:cut]])[:cut], own[:cut], atol=1e-4)
        at += len(text) + 1
    total = sum(math.exp(model.log_chances([np.array([3, 4, i])])[2]) for i in range(51) if i != 50)
    total += math.exp(model.log_chances([np.array([3, 4])])[2])
    assert abs(total - 1) < 0.01


def test_attention_learns():
    text = np.tile(np.array([1, 2, 3, 4, 5, 6, 7, 8]), 50)
    model = attention.train([text] * 8, 10, 9, epochs=20)
    assert model.log_chances([text]).mean() < 0
    assert model.log_chances([text]).mean() > attention.train([text] * 8, 10, 9, epochs=0).log_chances([text]).mean()


def test_word_chances_add_up():
    """At one place the chances of different words and of the end pass 1 in no model."""
    rng = random.Random(3)
    texts = [prose(rng, 40, 60).encode() for _ in range(60)]
    own = encoder(BYTE)
    ids = [i.astype(np.int64) for i in own.encode(texts)]
    net = attention.train(ids, own.mark_id + 1, own.mark_id, epochs=2)
    names = sorted({w for t in texts for w in t.split()}) + [b"zzz", b"w", b"qu\xc2\xa0x", b"\xc2\xa0y", b"1", b"'s"]
    for before in (b"", b"w1 w2", b"w3"):
        stream = lm.WordStream([before + b" " + n for n in names] + [before], BYTE)
        word, end = lm.word_chances(stream, net, own.leads())
        last = stream.first[1:-1] - 1
        total = np.exp(word[last]).sum() + np.exp(end[-1])
        assert 0.05 < total <= 1 + 1e-4
        assert np.isfinite(word).all() and np.isfinite(end).all()


def brute_base(rows, held):
    words = [[*spaced_words(t), b"\xff"] for _, t in rows]
    counts = collections.Counter(w for (i, _), own in zip(rows, words) if not held(i) for w in own)
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for (i, _), own in zip(rows, words):
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in own)
        out.append((i, held(i), len(own), sum(counts[w] > 0 for w in own), total, round(base, 6)))
    return sorted(out, key=str)


def test_lm_scores(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(i, prose(rng, rng.randrange(0, 80), 400).title()) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    for head in (lm.HEAD_WORDS, 20):  # the second way most words are joined
        monkeypatch.setattr(lm, "HEAD_WORDS", head)
        got = lm.score_texts(docs, remainder("doc_id", 10) == 0, BYTE).collect()
        mine = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got]
        assert sorted(mine, key=str) == brute_base(rows, held)
        scores = {r.doc_id: r.score for r in got}
        assert all(s < 0 for s in scores.values())
        if head == 20:
            assert all(abs(scores[i] - first[i]) < 1e-9 * (1 + abs(first[i])) for i in scores)
        first = scores


def test_lm_odd_rows(spark):
    rows = lm.score_texts(odd_docs(spark), F.lit(False), BYTE).collect()
    mine = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows]
    assert sorted(mine, key=str) == brute_base([(r[0], r[1]) for r in odd_rows()], lambda i: False)
    assert lm.score_texts(no_docs(spark), F.lit(False), BYTE).count() == 0


def test_lm_scores_of_unknown_words(spark):
    """Words that training lacks, however long and odd, cost no more than in the base but for a weight."""
    rng = random.Random(8)
    rows = [(i, prose(rng, 20, 60)) for i in range(200)]
    odd = ["".join(rng.choice("qxzjk0123456789\u0436\u4e2d") for _ in range(n)) for n in (5, 40, 200)]
    rows += [(1000 + i, " ".join(odd[: i + 1])) for i in range(3)] + [(1003, " ".join(odd * 5)), (1004, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = lm.score_texts(docs, F.col("doc_id") >= 1000, BYTE).filter("held_out").collect()
    assert len(got) == 5 and all(math.isfinite(r.score) for r in got)
    assert all(r.score >= r.base_score - r.n_tokens for r in got)


def test_word_counts_are_passed_on(spark, monkeypatch):
    monkeypatch.setattr(lm, "HELD_WORDS", 3)
    docs = spark.createDataFrame([("a b c d",), ("e f g h a",), ("a i j",), (None,)], "text string").coalesce(1)
    rows = lm.word_counts(docs).collect()
    assert sorted(r.n for r in rows) == [1] * 9 + [3, 4]


def test_fitting_helpers(spark):
    frame = spark.range(10_000)
    n = bounded_sample(frame, F.col("id"), 1000).count()
    assert 800 < n < 1200 and bounded_sample(frame, F.col("id"), 20_000).count() == 10_000
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 2))
    y = (rng.random(2000) < sigmoid(2 * x[:, 0] - x[:, 1] + 0.5)).astype(float)
    assert np.allclose(logistic(x, y), [2, -1, 0.5], atol=0.3)
    assert 0.3 < best_threshold(np.array([0.1, 0.2, 0.8, 0.9]), np.array([0, 0, 1, 1])) < 0.7


def test_lm_learns_from_all_texts(spark):
    """What stands outside the sample of first texts is counted, classed and trained on."""
    rng = random.Random(4)
    rows = [(i, prose(rng, 40, 50)) for i in range(200)]
    rows += [(1000 + i, " ".join(["zebra quagga okapi"] * 15)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    counts = lm.word_counts(docs.select("text")).cache()
    few, more = (lm.fit(docs, counts, BYTE, sample=n) for n in (4, 10_000))
    ids = lm._ids([t.encode() for _, t in rows], BYTE)
    end = few.attention.end
    true = np.bincount(np.concatenate([np.append(i, end) for i in ids]), minlength=end + 1)
    assert np.array_equal(few.attention.kind, more.attention.kind)
    assert np.allclose(few.attention.inner, attention.inner(true, few.attention.kind))
    text = ids[-1]
    start = attention.train([np.empty(0, np.int64)], end + 1, end).log_chances([text]).mean()
    assert few.attention.log_chances([text]).mean() > start + 2


def test_rounds_train_on_every_text(spark):
    text = np.tile(np.arange(1, 9), 20)
    stored = spark.createDataFrame([(i, 1, bytearray(text.astype(np.uint16).tobytes())) for i in range(30)],
                                   "doc_id bigint, turn int, ids binary")
    counts, learned = lm._gathered(stored, 10, 9)
    assert counts[:, 0].tolist() == [0, *[600] * 8, 30] and learned.tolist() == counts[:, 0].tolist()
    assert np.array_equal(counts, attention.gathered([text] * 30, 10, 9))
    model = attention.start(counts, 9)
    before = model.log_chances([text]).mean()
    for _ in range(4):
        lm._round(stored, model, 3, 0.004)
    assert model.log_chances([text]).mean() > before + 0.2
    assert np.array_equal(model.table[0], attention.start(counts, 9).table[0])


def test_lm_texts_are_encoded_once(spark, tmp_path, monkeypatch):
    """Stored ids and numbers of ids give the streams of the texts without the tokenizer."""
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randrange(0, 30), 50)) for i in range(40)] + [(40, None), (41, "x" * 3000 + " \u4e2d 1's\t")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    stored = lm._stored(docs, BYTE, str(tmp_path / "texts"))
    assert stored.columns == ["doc_id", "text", "turn", "ids", "per_word"]
    held = stored.orderBy("doc_id").select("text", "ids", "per_word").collect()
    columns = [pa.array([r[i] for r in held], pa.string() if not i else pa.binary()) for i in range(3)]
    texts = [(t or "").encode() for _, t in rows]
    whole = lm.WordStream(texts, BYTE)
    net = attention.start(np.ones((encoder(BYTE).mark_id + 1, 1 + 2 * attention.BESIDE)), encoder(BYTE).mark_id)
    model = lm.Model(*[np.empty(0)] * 2, 0, 0, (1, 0, 0), net, encoder(BYTE).leads(), BYTE)
    monkeypatch.setattr(lm, "encoder", lambda *_: pytest.fail("encoded again"))
    batch = pa.RecordBatch.from_arrays(columns, ["text", "ids", "per_word"])
    (got, a, b), = lm._streams(batch, model)
    assert (a, b) == (0, len(rows))
    for name in ("keys", "first", "ids", "per_word"):
        assert np.array_equal(getattr(got, name), getattr(whole, name)), name


def test_learning_keeps_single_precision_and_its_moments():
    """A step neither turns the parameters' arithmetic into doubles nor makes the moments of a table anew."""
    net = attention.train([np.arange(20)], 50, 49, epochs=0)
    learner = attention.Learner(net)
    x, target = attention.windows([np.arange(20)] * 3, 49)
    learner.learn(x, target, (0.01, 0.01))
    held = learner.moments["table"]
    learner.learn(x, target, (0.01, 0.01))
    assert learner.moments["table"] is held and all(m.dtype == np.float32 for m in held)
    assert all(g.dtype == np.float32 for _, _, g in attention._gradients(net, x, net.kind[target]))


def test_forward_of_late_places_only():
    net = attention.train([np.arange(40)], 50, 49, epochs=1)
    x = np.random.default_rng(1).integers(0, 50, (5, attention.WINDOW))
    whole = net.forward(x)[0].reshape(5, attention.WINDOW, -1)
    assert np.allclose(net.forward(x, 8)[0].reshape(5, attention.WINDOW - 8, -1), whole[:, 8:], atol=1e-5)
    wide = np.linspace(-50, 50, 1001).astype(np.float32)
    assert np.allclose(attention._tanh(wide.copy()), np.tanh(wide), atol=1e-6)


def test_mixing_weights_by_counts():
    rng = np.random.default_rng(1)
    ratios = rng.integers(-40, 40, (500, 2)) * lm.RATIO_STEP
    number = rng.integers(1, 5, 500)
    once = lm._mixing_weights(ratios, number)
    assert np.allclose(once, lm._mixing_weights(np.repeat(ratios, number, axis=0), np.ones(number.sum())))


def test_attention_learns_short_texts_and_ends():
    texts = [np.arange(n) for n in (0, 1, 30, 31, 32, 33, 70)]
    x, target = attention.windows(texts, 99)
    assert (target >= 0).sum() == sum(len(t) + 1 for t in texts)
    assert (target == 99).sum() == len(texts) and x.shape[1] == attention.WINDOW
    short = [np.array([3, 1, 2])] * 200
    new, old = (attention.train(short, 6, 5, epochs=n) for n in (20, 0))
    assert new.log_chances(short[:1])[3] > old.log_chances(short[:1])[3] + 1  # the end
    assert np.exp(new.log_chances(short[:1])[3]) > 0.5


def test_toxicity_thresholds_over_all_labels(spark):
    docs, labels = labelled(spark)
    rare = F.when(F.col("doc_id") == 0, "xx").otherwise(F.col("lang"))
    docs, asked = docs.withColumn("lang", rare), []
    counted = toxicity._score_counts
    toxicity._score_counts = lambda *a: asked.append(counted(*a)) or asked[-1]
    try:
        net = toxicity.fit(docs, labels, sample=300)
    finally:
        toxicity._score_counts = counted
    assert asked[0]["n"].sum() > 900  # all but the texts trained on
    assert set(net.thresholds) == {"en", "de"}  # one row does not set a threshold


def test_weighted_fitting():
    rng = np.random.default_rng(5)
    logit, y, n = rng.normal(size=300), rng.integers(0, 2, 300).astype(float), rng.integers(1, 6, 300)
    each = np.repeat(logit, n), np.repeat(y, n)
    assert np.allclose(calibration(logit, y, n), calibration(*each))
    assert best_threshold(sigmoid(logit), y, number=n) == best_threshold(sigmoid(each[0]), each[1])
