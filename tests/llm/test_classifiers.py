import random

import pytest
from pyspark.sql import functions as F

from tidewater.llm import quality, toxicity
from tidewater.llm.labelled import all_labelled, best_threshold, fold, platt, sigmoid

import numpy as np


def corpus(make_docs, spark, n=700, seed=1):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "ba be bi bo ca ce ci co da de di do".split() for b in "ran len tin mos rup".split()]
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(20, 120))]
        toxic, good = i % 4 == 0, i % 3 != 0
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                text.insert(rng.randrange(len(text)), rng.choice(["nastyword", "vilest", "gruntling"]))
        if not good:
            text = [w + "%%%" for w in text]
        docs.append((i, " ".join(text), rng.choice(["en", "de"]), "s"))
        labels.append((i, int(good), int(toxic), "clash"))
    return make_docs(docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")


@pytest.mark.parametrize("name", ["toxic", "quality"])
def test_held_out_accuracy(spark, make_docs, name):
    docs, labels = corpus(make_docs, spark)
    run = toxicity.toxicity if name == "toxic" else quality.quality
    out = run(docs, labels, fold(F.col("doc_id"), 4) != 2, rows=400)
    held = out.join(labels.select("doc_id", name), "doc_id").where(fold(F.col("doc_id"), 4) == 2).collect()
    assert sum(r["predicted"] == r[name] for r in held) >= 0.9 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in held)


@pytest.mark.parametrize("name", ["toxic", "quality"])
def test_odd_rows(spark, make_docs, odd_docs, name):
    docs, labels = corpus(make_docs, spark, 200)
    run = toxicity.toxicity if name == "toxic" else quality.quality
    odd_labels = labels.select("doc_id", "quality", "toxic").unionByName(spark.createDataFrame([(None, 1, 1), (3, None, None), (5, 7, 7)], "doc_id long, quality int, toxic int"))
    out = run(docs.where("doc_id >= 20").unionByName(odd_docs), odd_labels, F.lit(True), rows=150).collect()
    assert len(out) == 180 + odd_docs.count() and all(r["score"] is not None for r in out)
    assert len({r["score"] for r in out if r["doc_id"] == 4}) == 1
    assert run(odd_docs.limit(0), odd_labels, F.lit(True)).count() == 0
    none = run(odd_docs, labels.limit(0), F.lit(True)).collect()
    assert len({r["score"] for r in none}) == 1


def test_factorisation_machine_equals_the_sum_over_pairs():
    fm = quality.FactorisationMachine(bits=6, rank=3, meta=4)
    rng = np.random.default_rng(0)
    fm.w[:] = rng.normal(size=len(fm.w))
    ids = rng.choice(len(fm.w), 9, replace=False)
    x = rng.normal(size=9).astype(np.float32)
    pairs = sum(fm.v[ids[i]] @ fm.v[ids[j]] * x[i] * x[j] for i in range(9) for j in range(i))
    assert fm.raw(ids, x, np.array([9]))[0] == pytest.approx(fm.w0 + fm.w[ids] @ x + pairs, rel=1e-4)


def test_convolution_equals_the_plain_sum_over_windows():
    model = toxicity.TextCNN(bits=8, dim=2, widths=(1, 3), filters=4)
    rng = np.random.default_rng(1)
    vectors = np.concatenate([rng.normal(size=(50, 4)), np.zeros((1, 4))]).astype(np.float32)
    texts = [rng.integers(0, 50, n) for n in (0, 1, 2, 7, 100, 1)]
    got = model.raw(vectors, texts, piece=16, group=40)
    for text, value in zip(texts, got):
        x = np.concatenate([vectors[text], np.zeros((3, 4), np.float32)])
        best = []
        for j, k in enumerate(model.widths):
            h = np.stack([np.concatenate(x[i : i + k]) @ model.kernels[j] for i in range(len(x) - k + 1)])
            best.append(np.maximum(h.max(axis=0) + model.biases[j], 0))
        assert value == pytest.approx(np.concatenate(best) @ model.out, rel=1e-3, abs=1e-4)


def test_calibration_helpers():
    raw = np.array([-2.0, -1, -1, 1, 2, 3] * 20)
    y = np.array([0, 0, 1, 1, 1, 1] * 20)
    a, b = platt(raw, y)
    assert a > 0 and 0.3 < sigmoid(a * -1 + b) < 0.7
    assert platt(raw, np.ones(len(raw))) == (1.0, 0.0)
    assert 0.2 < best_threshold(np.repeat([0.1, 0.2, 0.9], 20), np.repeat([0, 0, 1], 20)) < 0.9
    assert best_threshold(np.array([0.5]), np.array([1])) == 0.3


def test_toxicity_learns_from_every_labelled_document(spark, make_docs, monkeypatch):
    """However small the shares: rare words are counted, and scores calibrated, over all of them."""
    docs, labels = corpus(make_docs, spark)
    rare = [f"zq{c}" for c in "abcdefghij"]
    words = F.element_at(F.array(*map(F.lit, rare)), (F.col("doc_id") % 10 + 1).cast("int"))
    docs = docs.withColumn("text", F.when(F.col("doc_id") < 100, F.concat_ws(" ", "text", words)).otherwise(F.col("text")))
    models, calibrated = [], []
    train, platt_ = toxicity.train, toxicity.platt
    monkeypatch.setattr(toxicity, "train", lambda *a: models.append(train(*a)) or models[-1])
    monkeypatch.setattr(toxicity, "platt", lambda raw, label: calibrated.append(len(label)) or platt_(raw, label))
    first = toxicity.toxicity(docs, labels, F.lit(True), rows=100)
    assert models[0].embed(models[0].rows_of(toxicity.word_parts([w.encode() for w in rare]))).any(axis=1).all()
    assert 700 / 5 - 7 <= calibrated[0] <= 700 / 5
    # the shares and the sum of their moves depend on no order and no partitioning
    again = toxicity.toxicity(docs.repartition(7), labels.repartition(2), F.lit(True), rows=100)
    assert sorted(first.collect()) == sorted(again.collect())


def test_state_of_a_model_is_whole():
    model = toxicity.TextCNN(bits=4, dim=3, widths=(1, 2), filters=5)
    model.start(np.ones((2, 17), bool))
    state = np.random.default_rng(2).normal(size=model.state().shape).astype(np.float32)
    model.restore(state)
    filled = sum(x.size for x in model._dense()) + 1
    assert (model.state()[:32] == state[:32]).all()
    for side in (slice(0, 3), slice(3, 6)):
        assert (model.state()[32:, side].ravel()[:filled] == state[32:, side].ravel()[:filled]).all()
    assert not model.tables[0][-1].any() and not model.tables[1][-1].any()


def test_all_labelled_rows_by_either_join(spark, make_docs):
    docs, labels = corpus(make_docs, spark, 120)
    docs = docs.unionByName(docs.where("doc_id = 7"))
    for most in (0, 1000):
        found, n = all_labelled(docs, labels, "toxic", F.col("doc_id") != 3, ["lang"], broadcast=most)
        got = found.select("doc_id", "label").collect()
        assert n == 119 and sorted(got) == sorted((i, int(i % 4 == 0)) for i in [*range(120), 7] if i != 3)


def test_units_hold_every_labelled_document(spark, make_docs):
    """A share that is far too long (here one id repeated) is several units; none of its rows is lost."""
    docs, labels = corpus(make_docs, spark, 90)
    docs = docs.unionByName(docs.where("doc_id = 8").crossJoin(spark.range(50).select()))
    model = toxicity.TextCNN(bits=10)
    found, n = all_labelled(docs, labels, "toxic", F.lit(True), ["lang"])
    units = toxicity._units(found, 9, 10, model).toArrow().to_batches()
    opened = [u for b in units for u in toxicity._opened(b, model.bits)]
    assert n == 90 and sum(len(label) for _, _, label, _, _ in opened) == 140 and max(len(u[2]) for u in opened) <= 20
    words = sum(len(r["text"].split()) for r in found.collect())
    assert sum(len(t) for _, texts, _, _, _ in opened for t in texts) == words
    assert sum(label.sum() for _, _, label, _, _ in opened) == sum(r["label"] for r in found.collect())
    assert all(rows.shape[0] == 2 and all((t < rows.shape[1]).all() for t in texts) for rows, texts, _, _, _ in opened)
