"""Texts as streams of words, and lines put back together."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from linetone.functions import ENGLISH, blank_separated, content_words, letters_only


def word_stream(lines: DataFrame, text: str = "Phrase", stop: Iterable[str] = ENGLISH) -> DataFrame:
    """One row per word of every line, ``text`` replaced by ``word``.

    Unlike the tokeniser this deletes what is not a letter (``don't`` gives
    ``dont``), then splits on blanks and drops stop words.
    """
    others = [c for c in lines.columns if c != text]
    cleaned = lines.where(F.col(text).isNotNull()).select(
        *others, content_words(blank_separated(letters_only(F.col(text))), stop).alias("words")
    )
    # Outer for the reason given in vocabulary.explode_terms; it also drops the
    # lines that are empty once cleaned.
    exploded = cleaned.select(*others, F.explode_outer("words").alias("word"))
    return exploded.where(F.col("word").isNotNull())


def word_counts(stream: DataFrame, by: Sequence[str] = ("movieId",)) -> DataFrame:
    """Occurrences ``n`` of each word of a :func:`word_stream`."""
    return stream.groupBy(*by, "word").agg(F.count("*").alias("n"))


def title_text(
    lines: DataFrame, order: Sequence[str], part: Column, text: str = "Phrase"
) -> DataFrame:
    """Lines of a title joined by blanks, in ``order``, as ``movieId``, ``part``, ``text``.

    ``part`` cuts the text into numbered pieces of bounded size, so that no title,
    however long, is collected into one cell. The pieces in turn are the whole text.
    """
    pieces = lines.where(F.col(text).isNotNull()).groupBy("movieId", part.alias("part"))
    rows = F.array_sort(F.collect_list(F.struct(*order, text)))
    joined = F.concat_ws(" ", F.transform(rows, lambda row: row[text]))
    return pieces.agg(joined.alias("text"))
