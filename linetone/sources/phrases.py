"""Labelled phrases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linetone.sources.records import read_records

SCHEMA = "PhraseId long, SentenceId long, Phrase string, Sentiment int"


def read_labelled_phrases(
    spark: SparkSession, path: str, limit: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(phrases, rejects)`` of a tab-separated file.

    Quotes are plain characters: a phrase that opens one and never closes it would
    otherwise swallow the following columns. Rows need an id, a phrase and a label.
    ``limit`` takes the lowest ids.
    """
    phrases, rejects = read_records(
        spark, path, SCHEMA, ["PhraseId", "Phrase", "Sentiment"], sep="\t", quote=""
    )
    return first_phrases(phrases, limit), rejects


def first_phrases(phrases: DataFrame, limit: int | None) -> DataFrame:
    """The ``limit`` phrases with the lowest ids, or all."""
    return phrases if limit is None else phrases.orderBy("PhraseId").limit(limit)
