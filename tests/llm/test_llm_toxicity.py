from __future__ import annotations

import bisect
import math
import re

import pytest
from odd_documents import documents, empty, prose
from pyspark.sql import functions as F

from linetone.llm import toxicity as module
from linetone.llm.toxicity import FEATURES, Lexicon, features, fit, held_out, score


@pytest.fixture(scope="module")
def labelled(spark):
    rows = []
    for i in range(500):
        words = prose(i, 30).split()
        if i % 4 == 0:
            words[3:3] = ["grobnix", "snarl" + "abcdefgh"[i % 8]]
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, label int")


@pytest.fixture(scope="module")
def model(labelled):
    return fit(labelled.select("doc_id", "text"), labelled.where(~held_out()).select("doc_id", "label"))


def test_held_out_rows(labelled, model):
    found = score(labelled, model).where(held_out()).collect()
    assert len(found) > 60
    assert sum(r["predicted"] != r["label"] for r in found) <= 0.05 * len(found)
    assert {r["predicted"] for r in found} == {0, 1}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found)


def test_lexicon_learns_words_and_stems(model):
    assert model.lexicon.words["grobnix"] > 1 and "snar" in model.lexicon.stems
    assert "that" not in model.lexicon.words


def test_features():
    lexicon = Lexicon({"moron": 2.0}, {})
    named = dict(zip(FEATURES, features("You MORON! what a m0ron, s.c.u.m", lexicon), strict=True))
    assert named["peak"] == 2 and named["toward_you"] > 0 and named["capitals"] > 0.1
    assert named["masked"] > 0 and named["masked_hits"] == 1
    assert features(None, lexicon) == features("", lexicon) == [0.0] * len(FEATURES)


def test_odd_documents(spark, model):
    odd = documents(spark)
    found = score(odd, model)
    assert found.columns == [*(c for c in odd.columns if c != "score"), "score", "predicted"]
    assert found.count() == odd.count() and found.where("score is null").count() == 0
    assert score(empty(spark), model).count() == 0


def test_without_labels_of_both_kinds(spark, labelled):
    documents_ = labelled.select("doc_id", "text")
    only = fit(documents_, labelled.where("label = 0").select("doc_id", "label"))
    assert {r["score"] for r in score(documents_, only).select("score").distinct().collect()} == {0.0}
    none = fit(documents_, labelled.limit(0).select("doc_id", "label"))
    assert score(documents_, none).where("score <> 0").count() == 0


def plain_margin(described: str, values: list[float]) -> float:
    """The weighted sum of the trees' leaves, walked along their printed form."""
    total, skipped, weight = 0.0, None, 0.0
    for line in described.splitlines()[1:]:
        depth = len(line) - len(line.lstrip())
        if found := re.match(r" *Tree \d+ \(weight (\S+)\)", line):
            weight, skipped = float(found[1]), None
        elif skipped is not None and depth > skipped:
            continue
        elif found := re.match(r" *(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line):
            below = values[int(found[1])] <= float(found[3])
            skipped = None if below == (found[2] == "<=") else depth
        elif found := re.match(r" *Predict: (\S+)", line):
            total += weight * float(found[1])
    return total


def plain_score(model, text):
    p = 1 / (1 + math.exp(-2 * plain_margin(model.trees.toDebugString, features(text, model.lexicon))))
    at, levels = model.boundaries, model.levels
    if p <= at[0]:
        level = levels[0]
    elif p >= at[-1]:
        level = levels[-1]
    else:
        i = bisect.bisect_right(at, p)
        level = levels[i - 1] + (p - at[i - 1]) * (levels[i] - levels[i - 1]) / (at[i] - at[i - 1])
    return min(1.0, max(0.0, (1 - module.OWN) * level + module.OWN * p))


def test_equal_to_plain_python(spark, labelled, model):
    odd = documents(spark).select("doc_id", "text").unionByName(labelled.select("doc_id", "text"))
    for row in score(odd, model).collect():
        assert row["score"] == pytest.approx(plain_score(model, row["text"]), abs=1e-9)


def test_repeated_rows_make_the_sample_no_larger(labelled, monkeypatch):
    seen = []
    plain = module.learn_lexicon
    monkeypatch.setattr(module, "learn_lexicon", lambda rows: seen.append(rows.count()) or plain(rows))
    texts, labels = labelled.select("doc_id", "text"), labelled.select("doc_id", "label")
    fit(texts, labels)
    fit(texts.withColumn("_", F.explode(F.sequence(F.lit(1), F.lit(5)))).drop("_"), labels)
    assert seen[0] == seen[1]
