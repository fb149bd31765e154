"""Parquet tables standing in for catalogue, texts and labelled phrases.

A conversation is a title, each line of its turns a text line. A document is a title
as well; one with a label is a labelled phrase.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from linetone.sources import split_lines


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def conversation_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``movieId``, ``turn``, ``line_no``, ``Phrase``."""
    turns = table(spark, folder, "conversations")
    return split_lines(turns.select(F.col("conv_id").alias("movieId"), "turn", "text"))


def conversation_titles(spark: SparkSession, folder: str) -> DataFrame:
    """``movieId`` and, as ``title``, the first line of the opening turn."""
    opening = table(spark, folder, "conversations").where(F.col("turn") == 0)
    return opening.select(
        F.col("conv_id").alias("movieId"), F.substring_index("text", "\n", 1).alias("title")
    )


def document_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``movieId``, ``line_no``, ``Phrase``."""
    documents = table(spark, folder, "documents")
    return split_lines(documents.select(F.col("doc_id").alias("movieId"), "text"))


def document_titles(spark: SparkSession, folder: str) -> DataFrame:
    """``movieId``, ``title``, ``genres``."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("movieId"),
        F.col("source").alias("title"),
        F.col("lang").alias("genres"),
    )


def labelled_keys(spark: SparkSession, folder: str) -> DataFrame:
    """``movieId`` of the documents that count as having a text."""
    return table(spark, folder, "labels").select(F.col("doc_id").alias("movieId"))


def labelled_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """``PhraseId``, ``Phrase`` and ``Sentiment`` of the labelled documents."""
    labels = table(spark, folder, "labels").select(
        F.col("doc_id").alias("PhraseId"),
        (2 * F.col("quality") + 1 - F.col("toxic")).alias("Sentiment"),
    )
    texts = table(spark, folder, "documents").select(
        F.col("doc_id").alias("PhraseId"), F.col("text").alias("Phrase")
    )
    return texts.join(labels, "PhraseId")
