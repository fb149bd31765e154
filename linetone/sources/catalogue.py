"""The title catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linetone.sources.records import read_records

SCHEMA = "movieId long, title string, genres string"


def read_catalogue(
    spark: SparkSession, path: str, limit: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(titles, rejects)`` of a comma-separated catalogue; rows need a ``movieId``.

    A quote inside a quoted title is written twice, as spreadsheets do. ``limit``
    takes the lowest ids, so the same titles every time.
    """
    titles, rejects = read_records(spark, path, SCHEMA, ["movieId"], escape='"')
    return first_titles(titles, limit), rejects


def first_titles(titles: DataFrame, limit: int | None) -> DataFrame:
    """The ``limit`` titles with the lowest ids, or all."""
    return titles if limit is None else titles.orderBy("movieId").limit(limit)


def title_names(titles: DataFrame, limit: int | None = None) -> DataFrame:
    """Only the names, of the first ``limit`` titles."""
    return first_titles(titles, limit).select("title")
