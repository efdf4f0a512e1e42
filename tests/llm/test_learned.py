"""op1 and op3: held-out accuracy, gradients, kernels against plain sets, awkward rows."""

import os
import random

import numpy as np
import pytest
from llm_data import SF, awkward, empty, prose
from pyspark.sql import functions as F

from tidemark.llm import language_id, toxicity
from tidemark.llm.common import bounded_sample


def test_gradients_by_differences():
    net = toxicity.Network(["aa", "bb", "cc"], seed=1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    r = np.random.default_rng(0)
    x = r.standard_normal((5, 4, 2 * toxicity.DIM))
    mask = np.ones((5, 4))
    mask[3:, 1] = 0
    toward = r.standard_normal(4)

    def loss():
        return float(net.forward(x @ net.p["wf"] + net.p["bf"], x @ net.p["wb"] + net.p["bb"], mask) @ toward)

    keep = {}
    net.forward(x @ net.p["wf"] + net.p["bf"], x @ net.p["wb"] + net.p["bb"], mask, keep)
    grads, _ = net.backward(toward, x, keep)
    for name in ("wf", "uf", "bf", "wb", "ub", "bb", "aw", "ab", "av", "ow"):
        flat = net.p[name].reshape(-1)
        for at in r.choice(len(flat), 3):
            old = flat[at]
            flat[at] = old + 1e-3
            up = loss()
            flat[at] = old - 1e-3
            down = loss()
            flat[at] = old
            assert grads[name].reshape(-1)[at] == pytest.approx((up - down) / 2e-3, rel=0.02, abs=1e-4), name


def test_windows_cover_every_word():
    for n in range(1, 70):
        starts = toxicity.windows_of(n)
        covered = {w for s in starts for w in range(s, min(n, s + toxicity.WINDOW))}
        assert covered == set(range(n))
        assert all(b - a <= toxicity.WINDOW // 2 for a, b in zip(starts, starts[1:], strict=False))


def test_long_runs_are_read_whole():
    """No character of a run is left out, ordinary words stay as they are, and a phrase behind the first 64 bytes tells."""
    assert toxicity.words_of("Ab cd") == ["ab", "cd"] and toxicity.words_of("x" * 64 + " é") == ["x" * 64, "é"]
    for run in ("a" * 65, "0123456789" * 30, "天気が良い" * 40, "é" * 33):
        pieces = toxicity.words_of(run)
        half = toxicity.PIECE // 2
        assert all(len(p.encode()) <= toxicity.LONGEST for p in pieces)
        assert pieces[0] + "".join(p[half:] for p in pieces[1:]) == run
    texts, labels = [], []
    for i in range(300):
        words = prose(i, 40).split()
        if i % 2:
            words.insert(20, "zorblekrugg")
        texts.append((" " if i % 3 else "_").join(words))
        labels.append(i % 2)
    scorer = toxicity.Scorer(toxicity.train(texts, labels))
    right = 0
    for i in range(1000, 1100):
        words = prose(i, 40).split()
        clean, bad = scorer.score(["_".join(words), "_".join([*words[:30], "zorblekrugg", *words[30:]])])
        right += int(clean < 0.5) + int(bad >= 0.5)
    assert right >= 180, right


def test_toxicity_learns_words_and_stems(spark):
    r = random.Random(5)
    rows, labels = [], []
    for i in range(900):
        words = prose(i, r.randint(20, 120)).split()
        toxic = i % 3 == 0
        if toxic:
            for _ in range(3):
                words.insert(r.randrange(len(words)), r.choice(["zorble", "krugg", "zorble!", "Krugg", "vlaxa" + r.choice(["th", "er", "on", "ti"])]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = toxicity.toxicity(docs, marks).join(marks, "doc_id").where("held_out").select("predicted", "toxic").collect()
    assert sum(r["predicted"] == r["toxic"] for r in got) >= 0.95 * len(got) > 0
    odd = toxicity.toxicity(awkward(spark), marks).collect()
    assert len(odd) == awkward(spark).count() and all(0 <= x["score"] <= 1 for x in odd)
    assert all(x["score"] == 0 for x in toxicity.toxicity(docs.limit(5), marks.where("false")).collect())
    assert toxicity.toxicity(empty(spark), marks).count() == 0


def test_kernel_is_the_blended_presence_kernel():
    texts = [prose(i, 60) for i in range(20)] + [prose(i, 60, "que la de es ó ñ ra ción") for i in range(20)]
    model = language_id.KernelClassifier(texts, ["a"] * 20 + ["b"] * 20, landmarks=5)

    def grams(t):
        return set(model.present(t).tolist())

    marks = [*texts[:5], *texts[20:25]]
    want = [[len(grams(t) & grams(m)) / np.sqrt(len(grams(t)) * len(grams(m))) for m in marks] for t in texts[:8]]
    assert np.allclose(model.kernel([model.present(t) for t in texts[:8]]), want, atol=1e-5)
    flat = "ab c"
    codes = [int(model.codes[ord(c)]) for c in flat]
    plain = {c for c in codes} | {64 + (a << 6 | b) for a, b in zip(codes, codes[1:], strict=False)} | {64 + 4096 + (a << 12 | b << 6 | c) for a, b, c in zip(codes, codes[1:], codes[2:], strict=False)}
    assert grams(flat) == plain


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data missing")
def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.where("lang = lang_pred").count() >= 0.98 * got.count()


def test_language_awkward(spark):
    model = language_id.KernelClassifier([prose(1, 50), prose(2, 50, "que la de es")], ["en", "es"])
    got = {r["doc_id"]: r for r in language_id.predict(awkward(spark), model).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (0, 1, 2, 12))
    assert got[5]["lang_pred"] == "en" and got[5]["source"] == awkward(spark).where("doc_id = 5").first()["source"]
    assert language_id.identify(empty(spark)).count() == 0
    assert {r["lang_pred"] for r in language_id.predict(awkward(spark), None).collect()} == {"und"}


def test_bounded_sample_is_even_and_repeatable(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 7 == 0).cast("int").alias("y"))
    a, b = (bounded_sample(df.repartition(n), "y", 100) for n in (3, 8))
    assert [r["doc_id"] for r in a] == [r["doc_id"] for r in b]
    assert sum(r["y"] for r in a) == 100 and len(a) == 200
