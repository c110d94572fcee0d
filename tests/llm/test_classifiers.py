import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barfold.llm import labelled, quality, toxicity

BAD = ("grumpf", "snarl", "blech")


def documents(spark, texts, first, count):
    draw, rows = random.Random(first), []
    for n in range(first, first + count):
        label = n % 2
        lines = [texts("en", 100 * n + k, 12) for k in range(5)]
        if label:
            at = draw.randrange(5)
            lines[at] = f"{texts('en', n, 4)[:-1]} {draw.choice(BAD)} and {draw.choice(BAD)}."
        rows.append((n, " ".join(lines), label))
    return spark.createDataFrame(rows, "doc_id long, text string, label int")


@pytest.mark.parametrize("kind", [toxicity, quality])
def test_held_out_rows(spark, texts, kind):
    model = kind.fit(documents(spark, texts, 0, 160).select("text", "label"))
    found = kind.score(documents(spark, texts, 1000, 80), model).collect()
    right = np.mean([(r["score"] >= 0.5) == (r["label"] == 1) for r in found])
    assert right > 0.9
    assert all(0 <= r["score"] <= 1 for r in found)


def test_offending_sentences(spark, texts):
    model = toxicity.fit(documents(spark, texts, 0, 160).select("text", "label"))
    text = f"{texts('en', 9001, 12)} You é snarl and grumpf! {texts('en', 9002, 12)}"
    found = toxicity.sentences(spark.createDataFrame([(text,), (None,), ("",)], "text string"), model).collect()
    parts = [text.encode()[s["start"]:s["end"]].decode() for s in found[0]["sentences"]]
    assert parts == [" You é snarl and grumpf"]
    assert found[1]["sentences"] == found[2]["sentences"] == []


@pytest.mark.parametrize("kind", [toxicity, quality])
def test_odd_rows(spark, texts, kind, odd_rows, no_rows):
    model = kind.fit(documents(spark, texts, 0, 40).select("text", "label"))
    found = kind.score(odd_rows, model).collect()
    assert len(found) == odd_rows.count()
    assert all(r["score"] is not None and 0 <= r["score"] <= 1 for r in found)
    assert kind.score(no_rows, model).count() == 0
    scores = [r["score"] for r in found if r["doc_id"] == 1]
    assert scores[0] == scores[1]
    if kind is toxicity:
        assert {r["score"] for r in found if r["doc_id"] in (2, 3, 4)} == {toxicity.EMPTY_SCORE}


@pytest.mark.parametrize("kind", [toxicity, quality])
def test_one_class_teaches_nothing(spark, odd_rows, kind):
    model = kind.fit(spark.createDataFrame([("a b c", 1)], "text string, label int"))
    assert {r["score"] for r in kind.score(odd_rows, model).collect()} == {0.0 if kind is toxicity else 0.5}
    nothing = kind.fit(spark.createDataFrame([], "text string, label int"))
    assert nothing.weights is None


def test_sample_of_labels(spark):
    docs = spark.createDataFrame([(n, f"t{n}") for n in range(100)] + [(None, "x"), (3, None)], "doc_id long, text string")
    rows = [(n, n % 2) for n in range(60)] + [(1, 0), (None, 1), (70, None), (71, 5), (2, 0)]
    labels = spark.createDataFrame(rows, "doc_id long, toxic int")
    found = labelled.sample(docs, labels, "toxic", F.lit(True), 1000).collect()
    # 1 has two labels; 2 is labelled twice alike; 3 is there twice, once without a text.
    assert len(found) == 60 - 1 + 1
    assert sum(r["text"] == "" for r in found) == 1
    few = labelled.sample(docs, labels, "toxic", F.col("doc_id") >= 10, 10).collect()
    assert 4 < len(few) < 40


def test_noisy_or_by_hand():
    model = toxicity.Model(np.zeros(toxicity.DIMENSIONS), 0.0)
    z = model.sentence_scores(np.array([1, 2, 3]), np.array([0, 0, 1]), 2)
    assert np.allclose(-np.expm1(-toxicity._clean_log(z).sum()), 1 - 0.5 * 0.5)


def test_worst_sentences_of_flagged_documents_only(spark, texts):
    model = toxicity.fit(documents(spark, texts, 0, 160).select("text", "label"))
    rows = [(f"{texts('en', 9001, 12)} You snarl and grumpf!", True), (f"You snarl and grumpf! {texts('en', 5, 9)}", False),
            (texts("en", 9003, 12), True), (None, True), ("", None)]
    found = toxicity.sentences(spark.createDataFrame(rows, "text string, flag boolean"), model, where="flag").collect()
    parts = [[r["text"].encode()[s["start"]:s["end"]].decode() for s in r["sentences"]] for r in found]
    assert parts == [[" You snarl and grumpf"], [], [rows[2][0][:-1]], [], []]


def test_noisy_or_gradient_by_differences():
    draw = np.random.default_rng(3)
    word, sentence = draw.integers(0, 20, 90), np.sort(draw.integers(0, 30, 90))
    document = np.sort(draw.integers(0, 8, 30))
    label = np.array([0, 1] * 4)
    balance = np.where(label == 1, 1.5, 0.5)

    def loss(state):
        z = state[-1] + np.bincount(sentence, weights=state[word], minlength=30)
        p = 1 / (1 + np.exp(-z))
        total = 0.0
        for doc in range(8):
            toxic = 1 - np.prod(1 - p[document == doc])
            total -= balance[doc] * np.log(toxic if label[doc] else 1 - toxic)
        return total / 8

    state = 0.3 * draw.normal(size=21)
    state[-1] = -1.0
    found = toxicity._gradient(state, word, sentence, document, label, balance)
    for k in range(21):
        step = np.zeros(21)
        step[k] = 1e-5
        assert abs((loss(state + step) - loss(state - step)) / 2e-5 - found[k]) < 1e-6


def test_ftrl_is_the_plain_rule(monkeypatch):
    """Per coordinate, in pure Python, against the update by arrays."""
    import math

    monkeypatch.setattr(quality, "DIMENSIONS", 12)
    draw = np.random.default_rng(5)
    rows = [(np.append(np.sort(draw.choice(12, 4, replace=False)), 12), np.append(draw.random(4), 1.0)) for _ in range(30)]
    labels = np.array([float(r[0][0] % 2) for r in rows])
    how = {"epochs": 2, "alpha": 0.3, "beta": 1.0, "l1": 0.05, "l2": 0.1}
    z, n = [0.0] * 13, [0.0] * 13

    def weight(k):
        if abs(z[k]) <= how["l1"]:
            return 0.0
        return -(z[k] - math.copysign(how["l1"], z[k])) / ((how["beta"] + math.sqrt(n[k])) / how["alpha"] + how["l2"])

    order, ones = np.random.default_rng(1), labels.sum()
    for _ in range(2):
        for row in order.permutation(30).tolist():
            w = {int(k): weight(int(k)) for k in rows[row][0]}
            p = 1 / (1 + math.exp(-sum(w[int(k)] * v for k, v in zip(*rows[row]))))
            cost = 30 / (2 * ones) if labels[row] else 30 / (2 * (30 - ones))
            for k, value in zip(rows[row][0].tolist(), rows[row][1].tolist()):
                g = cost * (p - labels[row]) * value
                z[k] += g - (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / how["alpha"] * w[k]
                n[k] += g * g
    weights, bias = quality._ftrl(rows, labels, seed=1, **how)
    assert np.allclose(weights, [weight(k) for k in range(12)], atol=1e-6) and abs(bias - weight(12)) < 1e-9
    assert np.count_nonzero(weights)
