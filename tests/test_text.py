from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.ml.feature import RegexTokenizer, StopWordsRemover
from pyspark.sql import functions as F

from linetone.functions import ENGLISH, key_words, phrase_key
from linetone.operators import add_words, null_phrases, title_text, word_counts, word_stream


@pytest.mark.parametrize(
    "phrase, words, filtered",
    [
        ("cliched dialogue and", "cliched dialogue and", "cliched dialogue"),
        ("'s", "'s", "'s"),
        ("is a plodding mess .", "is a plodding mess", "plodding mess"),
        ("And Carlo.", "and carlo", "carlo"),
        ("But, George, we haven't", "but george we haven't", "george"),
        (
            "Hello, WORLD's   café 123 -- 'quoted' don't",
            "hello world's caf 'quoted' don't",
            "hello world's caf 'quoted'",
        ),
        ("00:00:14,482 --> 00:00:19,696", "", ""),
        ("'", "'", "'"),
        ("the THE The", "the the the", ""),
        ("", "", ""),
    ],
)
def test_expected_words(phrases, phrase, words, filtered):
    found = add_words(phrases([(1, phrase)])).first()
    assert found["words_regex"] == words.split()
    assert found["filtered"] == filtered.split()


def test_same_as_ml_stages(spark):
    rng = random.Random(7)
    alphabet = "aábcDEÉfghZz'’\"-.,;0189 \t\r é İK ſß漢🎬"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(2000)]
    texts += [" ".join(rng.choices(ENGLISH, k=5)).title() for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "movieId long, Phrase string")
    tokenizer = RegexTokenizer(inputCol="Phrase", outputCol="ml_words", pattern="[^a-zA-Z']")
    remover = StopWordsRemover(inputCol="ml_words", outputCol="ml_filtered")
    both = remover.transform(tokenizer.transform(add_words(df)))
    different = both.where("words_regex <> ml_words OR filtered <> ml_filtered")
    assert different.count() == 0
    assert both.count() == len(texts)


def test_pinned_list_is_the_default_of_this_version():
    assert list(ENGLISH) == StopWordsRemover.loadDefaultStopWords("english")


def test_null_phrases_are_set_apart(phrases):
    df = phrases([(1, "good"), (2, None), (3, "null")])
    assert rows(add_words(df), "movieId") == [(1,), (3,)]
    assert rows(null_phrases(df), "movieId") == [(2,)]


def test_own_stop_words(phrases):
    df = add_words(phrases([(1, "the good film")]), stop=["Good"])
    assert df.first()["filtered"] == ["the", "film"]
    assert add_words(phrases([(1, "the film")]), stop=[]).first()["filtered"] == ["the", "film"]


def test_phrase_key_round_trip(spark):
    lists = [[], ["a"], ["a", "b"], ["'"], ["ab"]]
    df = spark.createDataFrame([(x,) for x in lists], "w array<string>")
    df = df.withColumn("k", phrase_key(F.col("w")))
    assert df.select("k").distinct().count() == len(lists)
    assert [list(r[0]) for r in df.select(key_words(F.col("k"))).collect()] == lists


def test_word_stream_deletes_instead_of_splitting(phrases):
    df = phrases([(1, "  Don't go-there, the END"), (1, "12:30"), (2, None), (2, "café café")])
    assert rows(word_stream(df), "movieId", "word") == [
        (1, "dont"),
        (1, "end"),
        (1, "gothere"),
        (2, "caf"),
        (2, "caf"),
    ]
    assert (2, "caf", 2) in rows(word_counts(word_stream(df)))
    only = word_stream(phrases([(1, "one two")]), stop=["two"])
    assert rows(only, "word") == [("one",)]


def test_title_text_is_ordered_and_bounded(phrases):
    df = phrases([(1, f"l{i}") for i in range(10)] + [(2, "x"), (2, None)], partitions=3)
    found = title_text(df, ["line_no"], F.floor(F.col("line_no") / 4))
    assert rows(found) == [
        (1, 0, "l0 l1 l2 l3"),
        (1, 1, "l4 l5 l6 l7"),
        (1, 2, "l8 l9"),
        (2, 2, "x"),
    ]
