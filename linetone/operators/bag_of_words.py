"""Phrases to word lists, one row per distinct list."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F

from linetone.functions import ENGLISH, content_words, key_words, phrase_key, words


def add_words(phrases: DataFrame, text: str = "Phrase", stop: Iterable[str] = ENGLISH) -> DataFrame:
    """Append ``words_regex`` and ``filtered``. Rows without text are left out.

    The null test reaches the scan; :func:`null_phrases` gives the rows it drops.
    """
    return (
        phrases.where(F.col(text).isNotNull())
        .withColumn("words_regex", words(F.col(text)))
        .withColumn("filtered", content_words(F.col("words_regex"), stop))
    )


def null_phrases(phrases: DataFrame, text: str = "Phrase") -> DataFrame:
    """The rows :func:`add_words` leaves out."""
    return phrases.where(F.col(text).isNull())


def unique_phrases(
    phrases: DataFrame,
    order: Sequence[str],
    keep: Sequence[str] = (),
    scope: Sequence[str] = (),
    drop_empty: bool = False,
) -> DataFrame:
    """One row per distinct ``filtered`` list: the first in ``order``.

    Returns ``filtered``, ``phrase_key``, the ``order`` and the ``keep`` columns.
    ``scope`` names columns within which lists are compared (none: the whole set).
    The row without any word counts as a phrase unless ``drop_empty``.

    An aggregate, not a window: every input task first reduces its own rows to one
    per list, so the list all wordless lines share costs one row per task in the
    shuffle, not a partition of its own. With a single ``order`` column the minimum
    is a plain long and Spark aggregates by hash; with more it sorts on the key.
    """
    source = phrases.withColumn("phrase_key", phrase_key(F.col("filtered")))
    if drop_empty:
        source = source.where(F.col("phrase_key") != "")
    fields = [c for c in dict.fromkeys([*order, *keep]) if c not in scope]
    groups = source.groupBy(*scope, "phrase_key")
    if not fields:
        first = source.select(*scope, "phrase_key").distinct()
    elif len(fields) == 1:
        first = groups.agg(F.min(fields[0]).alias(fields[0]))
    else:
        first = groups.agg(F.min(F.struct(*fields)).alias("first")).select(
            *scope, "phrase_key", *(F.col("first")[c].alias(c) for c in fields)
        )
    return first.withColumn("filtered", key_words(F.col("phrase_key")))


def bag_of_words(
    phrases: DataFrame,
    order: Sequence[str],
    keep: Sequence[str] = (),
    scope: Sequence[str] = (),
    text: str = "Phrase",
    stop: Iterable[str] = ENGLISH,
    drop_empty: bool = False,
) -> DataFrame:
    """Tokenise, drop stop words and keep one row per distinct word list."""
    return unique_phrases(add_words(phrases, text, stop), order, keep, scope, drop_empty)
