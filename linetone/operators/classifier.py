"""Multinomial logistic regression on count vectors."""

from __future__ import annotations

import warnings

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.sql import DataFrame, functions as F


def check_labels(train: DataFrame, label: str = "Sentiment") -> int:
    """Number of classes, highest label plus one. Raises on labels no fit can use.

    Classes below the highest that do not occur are legal, but usually a sign that a
    limited training set is too small, so they give a warning.
    """
    value = F.col(label).cast("double")
    facts = train.agg(
        F.count("*").alias("rows"),
        F.count(label).alias("labelled"),
        F.min(value).alias("lowest"),
        F.max(value).alias("highest"),
        F.count(F.when(value != F.floor(value), 1)).alias("fractional"),
    ).first()
    if not facts["rows"]:
        raise ValueError("the training set is empty")
    if facts["labelled"] < facts["rows"]:
        raise ValueError(f"{facts['rows'] - facts['labelled']} training rows have no {label}")
    if facts["fractional"] or facts["lowest"] < 0:
        raise ValueError(f"{label} must be a whole number from 0")
    if facts["lowest"] == facts["highest"]:
        raise ValueError(f"all training rows have {label} {facts['lowest']:g}")
    classes = int(facts["highest"]) + 1
    present = train.select(label).distinct().limit(classes).count()
    if present < classes:
        warnings.warn(f"{classes - present} of {classes} classes have no training row")
    return classes


def fit_classifier(
    train: DataFrame,
    label: str = "Sentiment",
    features: str = "features",
    prediction: str = "Sentiment_Predicted",
    **options,
) -> LogisticRegressionModel:
    """Fit on ``train``; further ``options`` go to the estimator as they are.

    Every iteration sums a gradient of classes x terms over all tasks. On many
    executors ``aggregationDepth`` above 2 keeps those sums off the driver.
    """
    check_labels(train, label)
    estimator = LogisticRegression(
        featuresCol=features, labelCol=label, predictionCol=prediction, **options
    )
    return estimator.fit(train)
