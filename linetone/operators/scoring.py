"""Linear scoring of phrases with given term weights."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from linetone.operators.vocabulary import word_runs

MARGIN, WEIGHT, PROBABILITY = "margin_{}", "weight_{}", "probability_{}"

Weights = Mapping[str, Sequence[float]] | DataFrame


def weight_table(spark: SparkSession, weights: Mapping[str, Sequence[float]]) -> DataFrame:
    """Term weights as a table: ``term`` and one ``weight_<class>`` per class.

    Made from an Arrow table, which Spark keeps as rows of known size and joins accordingly.
    """
    columns = {WEIGHT.format(k): pa.array(map(float, of)) for k, of in enumerate(zip(*weights.values(), strict=True))}
    return spark.createDataFrame(pa.table({"term": pa.array(weights, pa.string()), **columns}))


def margins(
    phrases: DataFrame,
    weights: Weights,
    intercepts: Sequence[float],
    column: str = "filtered",
) -> DataFrame:
    """Replace ``column`` by ``margin_<class>``: intercept plus the weights of its words.

    ``weights`` is a mapping, or a table of ``term`` and one ``weight_<class>`` per class. One
    plan for any number of weights: a row for each distinct word of a phrase meets the
    weight table, and the products are added up by phrase. A phrase is named by a digest
    of its words, whose text stays behind, and by its other columns; so the work per word
    does not depend on the length of a line. ``phrase_key`` is not carried along.
    """
    others = [c for c in phrases.columns if c not in (column, "phrase_key")]
    named = phrases.select(
        *others, F.unhex(F.md5(F.array_join(column, " "))).alias("_phrase"), column
    )
    # A phrase without a word has a row, too, of the empty word.
    filled = F.when(F.size(column) > 0, F.col(column)).otherwise(F.array(F.lit("")))
    runs = word_runs(named.withColumn(column, filled), [*others, "_phrase"], column)
    sums = [
        (F.coalesce(F.sum(F.col("n") * F.col(WEIGHT.format(k))), F.lit(0.0)) + F.lit(float(b))).alias(
            MARGIN.format(k)
        )
        for k, b in enumerate(intercepts)
    ]
    known = isinstance(weights, DataFrame)
    table = weights if known else weight_table(phrases.sparkSession, weights)
    scored = runs.join(table, "term", "left").groupBy(*others, "_phrase").agg(*sums)
    return scored.drop("_phrase")


def predicted_class(classes: int) -> Column:
    """Class with the highest margin as a double; the lowest of equals."""
    all_margins = F.array(*(F.col(MARGIN.format(k)) for k in range(classes)))
    return (F.array_position(all_margins, F.array_max(all_margins)) - 1).cast("double")


def class_probabilities(scored: DataFrame, classes: int) -> DataFrame:
    """Append ``probability_<class>``, the softmax of the margins.

    The greatest margin is taken off all of them first, so that no power overflows and at
    least one is 1, however large the margins are.
    """
    all_margins = [F.col(MARGIN.format(k)) for k in range(classes)]
    top = F.greatest(*all_margins) if classes > 1 else all_margins[0]
    powers = scored.withColumns({PROBABILITY.format(k): F.exp(m - top) for k, m in enumerate(all_margins)})
    total = sum(F.col(PROBABILITY.format(k)) for k in range(classes))
    return powers.withColumns(
        {PROBABILITY.format(k): F.col(PROBABILITY.format(k)) / total for k in range(classes)}
    )


def score_phrases(
    phrases: DataFrame,
    weights: Weights,
    intercepts: Sequence[float],
    prediction: str = "Sentiment_Predicted",
) -> DataFrame:
    """Margins and predicted class of every phrase."""
    scored = margins(phrases, weights, intercepts)
    return scored.withColumn(prediction, predicted_class(len(intercepts)))
