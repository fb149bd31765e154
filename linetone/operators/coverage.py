"""Which titles have text and which have none."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def titles_with_text(titles: DataFrame, texts: DataFrame, on: str) -> DataFrame:
    """Titles whose key occurs in ``texts``, unchanged."""
    return titles.join(_keys(texts, on), on, "left_semi")


def titles_without_text(titles: DataFrame, texts: DataFrame, on: str) -> DataFrame:
    """Titles whose key does not occur in ``texts``; a title without a key is one."""
    return titles.join(_keys(texts, on), on, "left_anti")


def coverage_counts(titles: DataFrame, texts: DataFrame, on: str) -> DataFrame:
    """One row, ``found`` and ``missing``, from one pass over both sides."""
    flagged = titles.select(on).join(_keys(texts, on).withColumn("found", F.lit(1)), on, "left")
    return flagged.agg(
        F.count("found").alias("found"),
        F.count(F.when(F.col("found").isNull(), 1)).alias("missing"),
    )


def _keys(texts: DataFrame, on: str) -> DataFrame:
    # Distinct first: a key may repeat without bound, and the partial aggregate
    # reduces it to one row per task before anything is moved.
    return texts.select(on).where(F.col(on).isNotNull()).distinct()
