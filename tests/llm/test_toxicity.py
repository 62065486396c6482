"""FTRL against a version that follows the update rule one coordinate at a time; repeated, long and clashing rows."""

import math

import numpy as np
import pytest

from pelagia.llm import toxicity
from pelagia.llm.toxicity import Settings


def plain_ftrl(rows, s):
    """z and n of each coordinate as the published per-coordinate rule updates them; the bias has neither L1 nor L2."""
    z, n, bias = {}, {}, [0.0, 0.0]

    def weight(i):
        if abs(z.get(i, 0.0)) <= s.l1:
            return 0.0
        return -(z[i] - math.copysign(s.l1, z[i])) / ((s.beta + math.sqrt(n[i])) / s.alpha + s.l2)

    intercept = lambda: -bias[0] / ((s.beta + math.sqrt(bias[1])) / s.alpha)
    for _ in range(s.epochs):
        for x, y in rows:
            w = {i: weight(i) for i in x.tolist()}
            b = intercept()
            g = 1 / (1 + math.exp(-(sum(w.values()) + b))) - y
            for i in w:
                rate = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / s.alpha
                z[i] = z.get(i, 0.0) + g - rate * w[i]
                n[i] = n.get(i, 0.0) + g * g
            bias[0] += g - (math.sqrt(bias[1] + g * g) - math.sqrt(bias[1])) / s.alpha * b
            bias[1] += g * g
    return {i: weight(i) for i in z if weight(i)}, intercept()


@pytest.mark.parametrize("l1", [0.0, 0.5, 3.0])
def test_ftrl_is_the_published_rule(l1):
    rng = np.random.default_rng(3)
    s = Settings(bits=8, l1=l1, epochs=3)
    rows = [(np.unique(rng.integers(0, 40 if y else 60, 12)), y) for y in rng.integers(0, 2, 150).tolist()]
    at, weights, bias = toxicity.ftrl(rows, s)
    want, b = plain_ftrl(rows, s)
    assert set(at.tolist()) == set(want) and abs(bias - b) < 1e-9
    assert all(abs(want[i] - w) < 1e-9 for i, w in zip(at.tolist(), weights.tolist(), strict=True))


def test_scores_are_sums_of_weights(spark):
    rng = np.random.default_rng(5)
    texts = [(i, " ".join(("vile " if i % 3 == 0 else "kind ") * int(rng.integers(1, 4)) + f"w{c}" for c in rng.integers(0, 30, 20))) for i in range(120)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(0, 120, 2)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(*t, "old") for t in texts], "doc_id long, text string, Score string")
    model = toxicity.train(docs, labels, settings=Settings(l1=0.5))
    order = {r["doc_id"]: r["o"] for r in docs.selectExpr("doc_id", "xxhash64('toxic', doc_id) AS o").collect()}
    trained = sorted((order[i], i) for i in range(0, 120, 2))
    weights, bias = plain_ftrl([(np.unique(toxicity.features(texts[i][1], 20)), int(i % 3 == 0)) for _, i in trained], Settings(l1=0.5))
    scored = toxicity.scored(docs, model)
    assert scored.columns == ["doc_id", "text", "score"]
    for r in scored.collect():
        logit = bias + sum(weights.get(i, 0.0) for i in np.unique(toxicity.features(r["text"], 20)).tolist())
        assert abs(r["score"] - 1 / (1 + math.exp(-logit))) < 1e-5


def test_a_repeated_id_trains_once(spark, monkeypatch):
    texts = [(i, f"{'vile' if i % 2 else 'kind'} word{i % 7} again") for i in range(50)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(50)], "doc_id long, quality int, toxic int")
    schema = "doc_id long, text string"
    once = toxicity.train(spark.createDataFrame(texts, schema), labels, settings=Settings(l1=0.1))
    often = toxicity.train(spark.createDataFrame(texts + [texts[7]] * 3000, schema), labels, settings=Settings(l1=0.1))
    assert once.index.tolist() == often.index.tolist() and np.allclose(once.weight, often.weight) and once.bias == often.bias


def test_texts_beyond_the_bound_do_not_train(spark):
    rows = [(i, ("vile " if i % 2 else "kind ") * 100) for i in range(40)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    few = toxicity.train(docs, labels, settings=Settings(l1=0.0, max_chars=499))
    assert few.bias == -35.0 and not len(few.index)
    long = spark.createDataFrame([*rows, (99, "vile " * 400_000)], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.scored(long, toxicity.train(docs, labels, settings=Settings(l1=0.0))).collect()}
    assert got[99] == got[1] > 0.5 > got[0]
