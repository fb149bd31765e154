from __future__ import annotations

import math
import random

import numpy as np
import pytest
from odd_documents import documents, empty, prose

from linetone.llm import quality as module
from linetone.llm.quality import FEATURES, described, estimated_prior, features, fit, held_out, score


def spoiled(seed: int) -> str:
    picks, words = random.Random(seed), prose(seed, 60).split()
    kind = seed % 3
    if kind == 0:
        return " ".join(w for w in words[:12] for _ in range(8))
    return " ".join(w + picks.choice(["###", "$$$"]) for w in words) if kind == 1 else "!! ".join(words).upper()


@pytest.fixture(scope="module")
def labelled(spark):
    """A fifth is spoiled; a third of the sound ones is known to be."""
    rows = []
    for i in range(1500):
        bad = i % 5 == 0
        text = spoiled(i) if bad else prose(i, 50 + i % 40) + "."
        rows.append((i, text, int(not bad), None if i % 3 else int(not bad)))
    return spark.createDataFrame(rows, "doc_id long, text string, truth int, label int").repartition(4)


@pytest.fixture(scope="module")
def learned(labelled):
    rows = described(labelled.select("doc_id", "text"))
    return fit(rows.where(~held_out()), labelled.where(~held_out()).select("doc_id", "label"))


def test_held_out_rows(labelled, learned):
    found = score(described(labelled), learned).where(held_out()).collect()
    assert len(found) > 250 and all(0 <= r["score"] <= 1 for r in found)
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in found)
    wrong = [r for r in found if r["predicted"] != r["truth"]]
    assert len(wrong) <= 0.05 * len(found)
    order = sorted(found, key=lambda r: r["score"])
    assert sum(r["truth"] for r in order[: len(found) // 6]) <= 2


def test_prior_of_learned_rows(learned):
    assert 0.72 < learned.prior < 0.84


def test_prior_from_histograms():
    cells = np.arange(module.CELLS)
    good = np.exp(-(((cells - 800) / 60) ** 2))
    bad = np.exp(-(((cells - 200) / 60) ** 2))
    for share in (0.1, 0.5, 0.9):
        counts = np.array([(share * good + (1 - share) * bad) * 1e5, good * 1e5]).round()
        assert estimated_prior(counts) == pytest.approx(share, abs=0.01)
    assert estimated_prior(np.zeros((2, module.CELLS))) == 0.0


def brute(x, positive, prior, multiplier):
    """Plain gradient descent of the risk with the ridge."""
    p, w, keep = x[positive], np.zeros(x.shape[1]), np.ones(x.shape[1])
    keep[-1] = 0
    held = module.RIDGE / math.sqrt(len(p))
    sigmoid = lambda z: 1 / (1 + np.exp(-z))
    for _ in range(60000):
        slope = prior * (sigmoid(p @ w) - 1).dot(p) / len(p) - multiplier * prior * sigmoid(p @ w).dot(p) / len(p)
        w = w - 0.2 * (slope + multiplier * sigmoid(x @ w).dot(x) / len(x) + held * keep * w)
    return w


@pytest.mark.parametrize("multiplier", [1.0, 0.4])
def test_minimum_of_the_risk(spark, multiplier):
    picks = np.random.default_rng(3)
    sound = picks.random(300) < 0.7
    values = np.round(picks.standard_normal((300, 2)) + 2 * sound[:, None], 1).astype(np.float32)
    positive = sound & (picks.random(300) < 0.5)
    rows = [([float(v) for v in row], int(p), i % 2) for i, (row, p) in enumerate(zip(values, positive, strict=True))]
    cuts = [[-0.5, 0.5, 1.5], [0.0, 2.0]]
    table = module._Rows(
        spark.createDataFrame(rows, "features array<float>, positive int, half int").repartition(3), cuts
    )
    weights, sums = table.minimise(np.zeros(8), 0.6, 0.6 * multiplier, multiplier)
    steps = module._steps(values, cuts)
    assert steps.min() == 0 and steps.max() == 6
    x = module._indicators(steps, 8)
    assert np.allclose(weights, brute(x, positive, 0.6, multiplier), atol=0.02)
    assert sums["positive"]["n"] == positive.sum() and sums["unlabelled"]["n"] == 300


def test_the_negative_part_of_the_risk_stays(labelled, learned, monkeypatch):
    """With too large a prior the multiplier falls until the part is zero."""
    monkeypatch.setattr(module, "estimated_prior", lambda _: 0.9)
    seen = []
    plain = module._Rows.minimise

    def watched(self, *args, **named):
        found = plain(self, *args, **named)
        if args[2]:
            seen.append((args[3], module._excess(found[1], 0.9)))
        return found

    monkeypatch.setattr(module._Rows, "minimise", watched)
    rows = described(labelled.select("doc_id", "text"))
    fit(rows, labelled.select("doc_id", "label"))
    assert seen[0][0] == 1.0 and seen[0][1] < 0 and len(seen) == 1 + module.HALVINGS
    assert abs(seen[-1][1]) < abs(seen[0][1]) / 4


def test_features():
    assert features(None) == features("") == features(" \n\t") == [0.0] * len(FEATURES)
    named = dict(zip(FEATURES, features("THE THE cat!! ##1\nsat"), strict=True))
    assert named["repeats"] == pytest.approx(1 / 5) and named["exclaims"] == pytest.approx(2 / 5)
    assert named["symbols"] == pytest.approx(2 / 5) and named["lines"] == pytest.approx(math.log(3))
    assert named["capitals"] == pytest.approx(6 / 12) and named["top_word"] == pytest.approx(2 / 5)


def test_odd_documents(spark, learned):
    odd = documents(spark)
    found = score(described(odd), learned)
    assert found.columns == [*(c for c in odd.columns if c not in ("text", "score")), "score", "predicted"]
    assert found.count() == odd.count() and found.where("score is null or predicted is null").count() == 0
    assert score(described(empty(spark)), learned).count() == 0


def test_odd_labels(spark):
    odd = described(documents(spark).select("doc_id", "text"))
    schema = "doc_id long, label int"
    none = fit(odd, spark.createDataFrame([(1, None), (None, 1), (2, 0), (3, 0), (3, 1)], schema))
    assert none.prior == 0.0 and score(odd, none).where("score <> 0").count() == 0
    some = fit(odd, spark.createDataFrame([(i, 1) for i in range(6)] * 2, schema))
    assert 0 < some.prior < 1 and score(odd, some).where("score between 0 and 1").count() == odd.count()
    assert fit(odd.limit(0), spark.createDataFrame([], schema)).prior == 0.0
