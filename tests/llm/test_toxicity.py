import random

import numpy as np

from corpusloom.llm import toxicity as T
from corpusloom.llm.queries import categories

BAD, GOOD = ["vile", "rotten", "foul"], [f"word{i}" for i in range(60)]


def corpus(n, seed=0):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        toxic = int(rng.random() < 0.2)
        words = [rng.choice(GOOD) for _ in range(rng.randint(20, 60))]
        for _ in range(3 * toxic):
            words.insert(rng.randint(0, len(words)), rng.choice(BAD))
        low = int(rng.random() < 0.3)
        words += ["spam"] * (5 * low)
        rows.append((i, " ".join(words)))
        labels.append((i, 1 - low, toxic))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus(900)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = spark.createDataFrame(labels[:600], "doc_id long, quality int, toxic int")
    chain = T.train(docs, seen, categories(), "toxic", sample=500)
    assert set(BAD) <= set(chain.vocabulary)
    got = {r.doc_id: r.rejected for r in T.score(docs, chain, "toxic").collect()}
    held = labels[600:]
    assert sum(got[i] == bool(t) for i, _, t in held) / len(held) > 0.97
    assert not any(got[i] for i, _, t in held if not t)


def test_later_models_see_earlier_probabilities_out_of_fold():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2, (400, 5)).astype(float)
    y = np.stack([x[:, 0], np.where(rng.random(400) < 0.9, x[:, 0], 1 - x[:, 0])], axis=1).astype(int)
    chain = T.Chain(["a", "b"], list("vwxyz"))
    held = T.fit_chain(x, y, np.arange(400), chain)
    assert [len(w) for w in chain.weights] == [6, 7]
    assert held.shape == (400, 2) and ((held[:, 0] > 0.5) == y[:, 0]).mean() > 0.98
    # fold f's probabilities don't depend on fold f's labels
    flipped = y.copy()
    flipped[np.arange(400) % 3 == 0, 0] ^= 1
    other = T.fit_chain(x, flipped, np.arange(400), T.Chain(["a", "b"], list("vwxyz")))
    assert np.allclose(other[::3, 0], held[::3, 0])


def test_logistic_matches_its_optimum():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((300, 3))
    y = (rng.random(300) < T._sigmoid(x @ [1, -2, 0.5] + 0.3)).astype(float)
    w = T.fit_logistic(x, y)
    p = T._predict(x, w)
    gradient = np.hstack([x, np.ones((300, 1))]).T @ (y - p) - np.array([1, 1, 1, 1e-6]) * w
    assert np.abs(gradient).max() < 1e-4


def test_threshold():
    p, y = np.array([0.9, 0.8, 0.7, 0.7, 0.3]), np.array([1, 1, 0, 1, 1])
    assert T.lowest_threshold(p, y, 1.0) == 0.8 and T.lowest_threshold(p, y, 0.75) == 0.3
    assert T.lowest_threshold(p, 1 - y, 0.9) == 1.1 and T.lowest_threshold(p[:0], y[:0], 0.9) == 1.1


def test_edges(spark, weird, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    chain = T.train(weird, none, categories(), "toxic")
    assert {r.rejected for r in T.score(weird, chain, "toxic").collect()} == {False}
    odd = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (None, 1, 1), (77, 0, 0), (3, None, 1), (8, 1, None), (5, 1, 0)], none.schema)
    chain = T.train(weird, odd, categories(), "toxic")
    rows = T.score(weird.withColumnRenamed("lang", "rejected"), chain, "toxic").collect()
    assert len(rows) == 11 and all(0 <= r.p_toxic <= 1 for r in rows)
    assert T.score(nothing, chain, "toxic").count() == 0


def test_long_texts_count_whole(spark):
    rows, labels = corpus(300)
    docs = spark.createDataFrame([*rows, (999, "word1 " * 30_000 + "vile rotten foul vile")], "doc_id long, text string")
    chain = T.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), categories(), "toxic")
    assert {r.doc_id: r.rejected for r in T.score(docs, chain, "toxic").collect()}[999]


def test_noisy_labels_do_not_switch_the_verdict_off(spark):
    """With 3 in 100 labels wrong no threshold has the precision, and known toxic documents still go."""
    rows, labels = corpus(900, 3)
    rng = random.Random(4)
    noisy = [(i, q, 1 - t if rng.random() < 0.03 else t) for i, q, t in labels]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    chain = T.train(docs, spark.createDataFrame(noisy, "doc_id long, quality int, toxic int"), categories(), "toxic")
    assert chain.threshold <= 0.5
    got = {r.doc_id: r.rejected for r in T.score(docs, chain, "toxic").collect()}
    toxic = [i for i, _, t in labels if t]
    assert sum(got[i] for i in toxic) / len(toxic) > 0.9
