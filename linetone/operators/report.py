"""Mean predicted class per title."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Fixed value: the class that counts as neutral.
NEUTRAL = 2.0


def mean_score(scored: DataFrame, prediction: str = "Sentiment_Predicted") -> DataFrame:
    """Mean class of all phrases of a title, as ``score``."""
    return scored.groupBy("movieId").agg(F.avg(prediction).alias("score"))


def mean_score_without_neutral(
    scored: DataFrame, prediction: str = "Sentiment_Predicted", neutral: float = NEUTRAL
) -> DataFrame:
    """Mean class of the other phrases of a title, as ``score_without_neutral``."""
    rest = scored.where(F.col(prediction) != neutral)
    return rest.groupBy("movieId").agg(F.avg(prediction).alias("score_without_neutral"))


def genre_report(
    titles: DataFrame, scored: DataFrame, prediction: str = "Sentiment_Predicted"
) -> DataFrame:
    """Mean class of all phrases of the titles of a genre, as ``genre``, ``score``.

    ``titles`` has ``movieId`` and ``genres``, names with a bar between. A title counts for
    each of its genres. Sums per title are added up, so phrases are not multiplied.
    """
    value = F.col(prediction)
    sums = scored.groupBy("movieId").agg(F.sum(value).alias("total"), F.count(value).alias("n"))
    genres = titles.select("movieId", F.explode_outer(F.split("genres", r"\|")).alias("genre"))
    per_genre = genres.where(F.col("genre").isNotNull()).join(sums, "movieId").groupBy("genre")
    return per_genre.agg((F.sum("total") / F.sum("n")).alias("score"))


def title_report(
    titles: DataFrame,
    scored: DataFrame,
    prediction: str = "Sentiment_Predicted",
    neutral: float = NEUTRAL,
    keep_all_titles: bool = False,
) -> DataFrame:
    """Both means per title, ordered by ``movieId``.

    One pass over ``scored`` gives both. A title without a phrase that is not
    neutral has no second mean and is left out unless ``keep_all_titles``.
    """
    value = F.col(prediction)
    means = scored.groupBy("movieId").agg(
        F.avg(value).alias("score"),
        F.avg(F.when(value != neutral, value)).alias("score_without_neutral"),
    )
    if not keep_all_titles:
        means = means.where(F.col("score_without_neutral").isNotNull())
    joined = titles.select("movieId", "title").join(
        means, "movieId", "left" if keep_all_titles else "inner"
    )
    return joined.orderBy("movieId")
