"""From two sets of phrases to scored lines."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame

from linetone.operators import VOCAB_SIZE, combined_corpus, fit_classifier, fit_vectoriser


def vectorise(
    train: DataFrame,
    lines: DataFrame,
    vocab_size: int = VOCAB_SIZE,
    vocabulary_from: str = "both",
) -> tuple[CountVectorizerModel, DataFrame, DataFrame]:
    """The vectoriser and both sets with their ``features``.

    The vocabulary covers both sets, so the training features depend on the lines;
    ``vocabulary_from="train"`` makes them independent.
    """
    if vocabulary_from not in ("both", "train"):
        raise ValueError(f"vocabulary_from must be 'both' or 'train', not {vocabulary_from!r}")
    parts = [train, lines] if vocabulary_from == "both" else [train]
    model = fit_vectoriser(combined_corpus(*parts), vocab_size)
    return model, model.transform(train), model.transform(lines)


@dataclass(frozen=True)
class Scored:
    """A fitted pair of models and the lines they scored."""

    vectoriser: CountVectorizerModel
    classifier: LogisticRegressionModel
    lines: DataFrame


def train_and_score(
    train: DataFrame, lines: DataFrame, vocab_size: int = VOCAB_SIZE, **options
) -> Scored:
    """Fit on ``train``, predict ``lines``.

    Both are read several times and should be staged first. Scoring is a projection:
    the models travel to the tasks and no line moves.
    """
    vectoriser, vectors, line_vectors = vectorise(train, lines, vocab_size)
    classifier = fit_classifier(vectors, **options)
    return Scored(vectoriser, classifier, classifier.transform(line_vectors))
