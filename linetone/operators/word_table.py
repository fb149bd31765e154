"""Dropping the words of a table, of any size, from streams and lists of words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# A word with more than this share of all words is hot; there are at most so many of them.
HOT_SHARE = 1 / 64


def _hot_words(stream: DataFrame, column: str) -> list[str]:
    """Words with an outsized share of the stream, at most ``1 / HOT_SHARE``."""
    counts = stream.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    return [r[column] for r in counts.where(F.col("n") > total * HOT_SHARE).collect()]


def drop_listed_words(
    stream: DataFrame, listed: DataFrame, column: str = "word", listed_column: str = "word"
) -> DataFrame:
    """Rows of ``stream`` whose word is not in the table ``listed``; null words stay.

    An anti join, so the list may be larger than any task's memory. The few hot words, which
    would each be one task's work, are looked up in the list by themselves and never joined.
    """
    hot = _hot_words(stream, column)
    words = listed.select(F.lower(listed_column).alias("_listed"))
    hot_listed = {r[0] for r in words.where(F.col("_listed").isin(hot)).distinct().collect()}
    word = F.col(column)
    usual = word.isNotNull() & ~word.isin(hot)
    rest = stream.where(usual).join(words, word == F.col("_listed"), "left_anti")
    stays = [w for w in hot if w not in hot_listed]
    return rest.unionByName(stream.where(word.isNull() | word.isin(stays)))


def content_words_by_table(
    lines: DataFrame,
    listed: DataFrame,
    key: Sequence[str],
    column: str = "filtered",
    listed_column: str = "word",
) -> DataFrame:
    """``key`` and the word lists in ``column`` without the words of the table ``listed``.

    Words are numbered, the listed ones dropped, and lists put together again in order, each
    by its ``key``, which must tell the lines apart. Null lists stay null, empty ones empty.
    """
    numbered = lines.select(*key, F.posexplode_outer(column).alias("_place", "_word"))
    numbered = numbered.where(F.col("_word").isNotNull())
    kept = drop_listed_words(numbered, listed, "_word", listed_column)
    in_order = F.array_sort(F.collect_list(F.struct("_place", "_word")))
    lists = kept.groupBy(*key).agg(F.transform(in_order, lambda w: w["_word"]).alias("_kept"))
    lists = lists.select("_kept", *(F.col(c).alias(f"_{c}") for c in key))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key]
    joined = lines.select(*key, F.col(column).isNull().alias("_null")).join(lists, same, "left")
    empty = F.array().cast("array<string>")
    found = F.when(~F.col("_null"), F.coalesce("_kept", empty))
    return joined.select(*key, found.alias(column))
