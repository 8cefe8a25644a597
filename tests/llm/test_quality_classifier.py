"""The quality classifier's bounded sample, its forward pass, its gradients and its scores of unseen rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierlake.llm import quality_classifier as q


@pytest.fixture(scope="module")
def bags():
    rng = np.random.default_rng(3)
    bounds = np.array([0, 1, 4, 9, 11])
    x = rng.normal(size=(11, q.N_FEATURES))
    shapes = {
        "encode": (q.N_FEATURES, q.HIDDEN), "shift": (q.HIDDEN,), "view": (q.HIDDEN, q.ATTENTION), "gate": (q.HIDDEN, q.ATTENTION),
        "attend": (q.ATTENTION,), "out": (q.HIDDEN,), "bias": (1,),
    }
    return {k: rng.normal(0, 0.5, s) for k, s in shapes.items()}, x, bounds, np.array([1.0, 0.0, 1.0, 0.0])


def plain_score(w, passages):
    """One document, passage by passage."""
    hidden, energies = [], []
    for passage in passages:
        h = np.tanh(passage @ w["encode"] + w["shift"])
        gated = np.tanh(h @ w["view"]) / (1 + np.exp(-(h @ w["gate"])))
        hidden.append(h)
        energies.append(float(gated @ w["attend"]))
    shares = np.exp(energies) / np.sum(np.exp(energies))
    pooled = sum(share * h for share, h in zip(shares, hidden, strict=True))
    return 1 / (1 + np.exp(-(pooled @ w["out"] + w["bias"][0])))


def test_forward_pass_is_the_plain_one(bags):
    w, x, bounds, _ = bags
    expected = [plain_score(w, x[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert q._forward(w, x, bounds)["score"] == pytest.approx(expected)


def test_gradients_are_the_slopes_of_the_loss(bags):
    w, x, bounds, labels = bags

    def loss(weights):
        score = q._forward(weights, x, bounds)["score"]
        fitted = -(labels * np.log(score) + (1 - labels) * np.log(1 - score)).mean()
        return fitted + q.PENALTY / 2 * sum((v**2).sum() for v in weights.values())

    step = 1e-6
    for name, gradient in q._gradients(w, x, bounds, labels).items():
        for place in [(0,) * w[name].ndim, tuple(n - 1 for n in w[name].shape)]:
            up, down = ({k: v.copy() for k, v in w.items()} for _ in range(2))
            up[name][place] += step
            down[name][place] -= step
            assert gradient[place] == pytest.approx((loss(up) - loss(down)) / (2 * step), rel=1e-4, abs=1e-8)


def test_passages_of_the_sample_are_spread_over_the_text():
    assert q.spread_passages(5, 8).tolist() == [0, 1, 2, 3, 4]
    found = q.spread_passages(10_000, 100)
    assert len(set(found.tolist())) == 100
    assert np.histogram(found, 10, (0, 10_000))[0].min() >= 8


def test_sample_is_bounded_in_documents_rows_and_passages(spark):
    long = "word " * (64 * 40)
    rows = [(7, f"copy {k} of one id") for k in range(200)] + [(k, long) for k in range(100, 160)] + [(None, "nameless"), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in [7, 7, 8, *range(100, 160)]], "doc_id bigint, quality int")
    found = q.sample(docs, labels, max_documents=30, max_passages=10).collect()
    assert len(found) == len({r.doc_id for r in found}) == 30
    assert max(len(r.features) for r in found) <= 10 * q.N_FEATURES * 4
    every = q.sample(docs, labels).filter(~q.held_out()).count()
    assert every == labels.distinct().filter(~q.held_out()).count()
    again = q.sample(docs.orderBy(F.rand(1)).repartition(5), labels, 30, 10).collect()
    assert sorted(found) == sorted(again)
    assert q.train(docs, labels, 30, 10) is not None


def test_unseen_documents_are_ranked(spark):
    """The area under the curve over documents that were not learned from."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    scored = q.score(docs, q.train(docs, labels)).filter("held_out").join(labels, "doc_id").collect()
    good = np.array([r.score for r in scored if r.quality == 1])
    poor = np.array([r.score for r in scored if r.quality == 0])
    assert len(good) > 5 and len(poor) > 5
    wins = (good[:, None] > poor).mean() + (good[:, None] == poor).mean() / 2
    assert wins > 0.9
