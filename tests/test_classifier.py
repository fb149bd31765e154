from __future__ import annotations

import warnings

import pytest
from conftest import rows

from linetone.operators import (
    add_words,
    check_labels,
    fit_classifier,
    fit_vectoriser,
    score_phrases,
)
from linetone.plans.training import train_and_score, vectorise
from linetone.sources import load_classifier, save_classifier

TRAIN = [
    ("awful terrible mess", 0),
    ("terrible waste", 0),
    ("rather weak story", 1),
    ("weak acting", 1),
    ("story about acting", 2),
    ("some film", 2),
    ("rather good acting", 3),
    ("good story", 3),
    ("superb wonderful film", 4),
    ("wonderful acting superb", 4),
]
LINES = [(1, "what a terrible mess"), (1, "wonderful"), (2, "good acting"), (2, "12"), (3, "zzz")]


@pytest.fixture(scope="module")
def fitted(spark):
    train = spark.createDataFrame(
        [(i, p, s) for i, (p, s) in enumerate(TRAIN)], "PhraseId long, Phrase string, Sentiment int"
    )
    lines = spark.createDataFrame(LINES, "movieId long, Phrase string")
    train, lines = add_words(train).coalesce(1), add_words(lines).coalesce(1)
    # A penalty, so that the optimum is finite and the margins are well apart.
    return train_and_score(train, lines, regParam=0.05)


def test_predictions(fitted):
    found = dict(rows(fitted.lines, "Phrase", "Sentiment_Predicted"))
    assert found["what a terrible mess"] == 0.0
    assert found["wonderful"] == 4.0
    assert found["good acting"] == 3.0
    assert {"rawPrediction", "probability"} <= set(fitted.lines.columns)
    assert fitted.classifier.numClasses == 5


def test_save_twice_and_load(fitted, tmp_path):
    path = str(tmp_path / "model")
    save_classifier(fitted.classifier, path)
    save_classifier(fitted.classifier, path)
    plain = fitted.lines.drop("rawPrediction", "probability", "Sentiment_Predicted")
    loaded = load_classifier(path).transform(plain)
    assert rows(loaded, "Phrase", "Sentiment_Predicted") == rows(
        fitted.lines, "Phrase", "Sentiment_Predicted"
    )


def test_options_reach_the_estimator(spark):
    train = spark.createDataFrame([("good", 1), ("bad", 0)], "Phrase string, Sentiment int")
    words = add_words(train)
    vectors = fit_vectoriser(words).transform(words)
    model = fit_classifier(vectors, maxIter=3, regParam=0.5, prediction="p")
    assert (model.getMaxIter(), model.getRegParam(), model.getPredictionCol()) == (3, 0.5, "p")


def test_vocabulary_source(spark):
    train = add_words(spark.createDataFrame([("good", 1)], "Phrase string, Sentiment int"))
    lines = add_words(spark.createDataFrame([("sequel",)], "Phrase string"))
    assert vectorise(train, lines)[0].vocabulary == ["good", "sequel"]
    assert vectorise(train, lines, vocabulary_from="train")[0].vocabulary == ["good"]
    with pytest.raises(ValueError, match="vocabulary_from"):
        vectorise(train, lines, vocabulary_from="test")


@pytest.mark.parametrize(
    "labels, message",
    [
        ([], "empty"),
        ([0.0, None], "no Sentiment"),
        ([0.0, -1.0], "whole number"),
        ([0.0, 1.5], "whole number"),
        ([2.0, 2.0], "all training rows"),
    ],
)
def test_bad_labels(spark, labels, message):
    df = spark.createDataFrame([(x,) for x in labels], "Sentiment double")
    with pytest.raises(ValueError, match=message):
        check_labels(df)


def test_missing_classes_warn(spark):
    df = spark.createDataFrame([(0,), (1,), (4,)], "Sentiment int")
    with pytest.warns(UserWarning, match="2 of 5 classes"):
        assert check_labels(df) == 5
    whole = spark.createDataFrame([(0,), (1,)], "Sentiment int")
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        assert check_labels(whole) == 2
