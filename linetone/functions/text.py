"""Column functions that turn a phrase into words. All are built-in, JVM-side."""

from __future__ import annotations

from collections.abc import Iterable
from string import ascii_letters

from pyspark.sql import Column, functions as F

from linetone.functions.stopwords import ENGLISH


def words(phrase: Column) -> Column:
    """Lower-cased runs of ASCII letters and apostrophes; null stays null.

    Everything else separates words, so an accented letter cuts a word in two.
    """
    return F.regexp_extract_all(F.lower(phrase), F.lit("[a-z']+"), F.lit(0))


def content_words(word_list: Column, stop: Iterable[str] = ENGLISH) -> Column:
    """``word_list``, which is lower-cased already, without stop words."""
    stop = sorted({s.lower() for s in stop})
    return F.filter(word_list, lambda w: ~w.isin(stop)) if stop else word_list


def phrase_key(word_list: Column) -> Column:
    """One string per word list, equal exactly when the lists are equal.

    Words hold no blank and are never empty, so joining on a blank loses nothing.
    A string groups, sorts and shuffles in less than half the bytes of an array.
    """
    return F.array_join(word_list, " ")


def key_words(key: Column) -> Column:
    """The word list behind a :func:`phrase_key`."""
    empty = F.array().cast("array<string>")
    return F.when(key == "", empty).otherwise(F.split(key, " "))


def letters_only(phrase: Column) -> Column:
    """The draft clean-up: delete all but ASCII letters and blanks, trim the left.

    The class lists its letters one by one because Java then looks each character up
    in a table. With ranges it tries one after the other, at ten times the cost.
    """
    return F.ltrim(F.regexp_replace(phrase, f"[^ {ascii_letters}]", ""))


def blank_separated(phrase: Column) -> Column:
    """Lower-cased pieces between blanks, without empty ones."""
    return F.filter(F.split(F.lower(phrase), " "), lambda w: w != "")
