"""The report over a stream: totals per title that a repeated batch leaves as they are."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from linetone.functions import key_words
from linetone.operators.report import NEUTRAL
from linetone.session import complete_folders, delete_folder
from linetone.streaming.phrases import phrase_changes, rank_value

TOTALS = "movieId long, total double, n long, rest_total double, rest_n long"

# Batches that are added up at a time into totals of their own.
EVERY = 20


def _sums(rows: DataFrame) -> DataFrame:
    sums = ("total", "n", "rest_total", "rest_n")
    return rows.groupBy("movieId").agg(*(F.sum(c).alias(c) for c in sums))


def merge_batch(
    changes: DataFrame,
    batch_id: int,
    folder: str,
    score: Callable[[DataFrame], DataFrame],
    prediction: str = "Sentiment_Predicted",
    neutral: float = NEUTRAL,
) -> None:
    """Write what a batch of ``phrase_changes`` adds to each title's totals.

    ``score`` gives rows with ``filtered`` a class as ``prediction``. The title, first in the
    order of the changes, that a phrase now counts for gains its class, the one it counted for
    before loses it. The totals of a batch are a folder named by it: a batch that is run again
    after a failure replaces its own and nothing counts twice.
    """
    named = changes.select(
        key_words(F.col("phrase_key")).alias("filtered"),
        rank_value(F.col("rank"), 0).alias("now"),
        rank_value(F.col("before"), 0).alias("earlier"),
        F.col("before").isNotNull().alias("moved"),
    )
    value = F.col(prediction)
    gain = F.struct(F.col("now").alias("movieId"), F.lit(1).alias("sign"))
    loss = F.struct(F.col("earlier").alias("movieId"), F.lit(-1).alias("sign"))
    both = F.when(F.col("moved"), F.array(gain, loss)).otherwise(F.array(gain))
    signed = score(named).select(value.alias("value"), F.explode(both).alias("side"))
    signed = signed.select("side.movieId", "side.sign", "value")
    rest = F.col("value") != neutral
    parts = signed.select(
        F.col("movieId").cast("long"),
        (F.col("sign") * F.col("value")).alias("total"),
        F.col("sign").cast("long").alias("n"),
        F.when(rest, F.col("sign") * F.col("value")).otherwise(0.0).alias("rest_total"),
        F.when(rest, F.col("sign")).otherwise(0).cast("long").alias("rest_n"),
    )
    _sums(parts).write.mode("overwrite").parquet(f"{folder}/totals/batch={batch_id}")


def _totals_folders(spark: SparkSession, folder: str) -> tuple[list[str], list[str]]:
    """Folders that make up the totals, and those that later ones stand for."""
    number = lambda path: int(path.rsplit("=", 1)[1])
    batches = sorted(complete_folders(spark, f"{folder}/totals"), key=number)
    added_up = sorted(complete_folders(spark, f"{folder}/added_up"), key=number)
    done = number(added_up[-1]) if added_up else -1
    current = [*added_up[-1:], *(b for b in batches if number(b) > done)]
    return current, [*added_up[:-1], *(b for b in batches if number(b) <= done)]


def title_totals(spark: SparkSession, folder: str) -> DataFrame:
    """``movieId``, sum and number of classes, and the same without neutral ones."""
    current, _ = _totals_folders(spark, folder)
    if not current:
        return spark.createDataFrame([], TOTALS)
    return _sums(spark.read.schema(TOTALS).parquet(*current))


def compact_totals(spark: SparkSession, folder: str, batch_id: int) -> None:
    """Add up all batches to ``batch_id`` and delete the folders that are not needed any more.

    Called between batches. If it fails half-way the batches are still there and count.
    """
    title_totals(spark, folder).write.mode("overwrite").parquet(f"{folder}/added_up/to={batch_id}")
    for path in _totals_folders(spark, folder)[1]:
        delete_folder(spark, path)


def stream_title_report(titles: DataFrame, totals: DataFrame, keep_all_titles: bool = False) -> DataFrame:
    """Both means per title from its totals, as ``title_report`` gives them, in order."""
    means = totals.where("n > 0").select(
        "movieId",
        (F.col("total") / F.col("n")).alias("score"),
        F.when(F.col("rest_n") > 0, F.try_divide("rest_total", "rest_n")).alias("score_without_neutral"),
    )
    if not keep_all_titles:
        means = means.where(F.col("score_without_neutral").isNotNull())
    how = "left" if keep_all_titles else "inner"
    return titles.select("movieId", "title").join(means, "movieId", how).orderBy("movieId")


def start_title_report(
    lines: DataFrame,
    order: Sequence[str],
    score: Callable[[DataFrame], DataFrame],
    folder: str,
    every: int = EVERY,
    **trigger,
) -> StreamingQuery:
    """Start a query that keeps the totals in ``folder`` up to date with a stream of ``lines``.

    ``order`` begins with ``movieId``. ``trigger`` goes to the stream's trigger; with
    ``availableNow=True`` the query ends when it has caught up. State, offsets and totals are in
    ``folder``, from which a query started again carries on.
    """

    def merge(changes: DataFrame, batch_id: int) -> None:
        merge_batch(changes, batch_id, folder, score)
        if batch_id % every == every - 1:
            compact_totals(changes.sparkSession, folder, batch_id)

    return (
        phrase_changes(lines, order)
        .writeStream.outputMode("update")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(**trigger)
        .foreachBatch(merge)
        .start()
    )
