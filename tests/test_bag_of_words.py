from __future__ import annotations

import pytest
from conftest import plan_of, rows

from linetone.operators import add_words, bag_of_words, unique_phrases

SHARED = [
    (2, "Good film!"),
    (1, "a GOOD film"),
    (1, "1"),
    (1, "00:00:14,482 --> 00:00:19,696"),
    (2, ""),
    (2, "the and of"),
    (3, "Bad film"),
    (3, "good   film"),
]


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_lowest_id_survives_at_any_partitioning(phrases, partitions):
    df = bag_of_words(phrases(SHARED, partitions), ["movieId", "line_no"], ["Phrase"])
    assert rows(df, "movieId", "Phrase", "filtered") == [
        (1, "1", ()),
        (1, "a GOOD film", ("good", "film")),
        (3, "Bad film", ("bad", "film")),
    ]


def test_title_scope_keeps_one_per_title(phrases):
    df = bag_of_words(phrases(SHARED), ["line_no"], scope=["movieId"])
    assert rows(df, "movieId", "line_no", "phrase_key") == [
        (1, 1, "good film"),
        (1, 2, ""),
        (2, 0, "good film"),
        (2, 4, ""),
        (3, 6, "bad film"),
        (3, 7, "good film"),
    ]
    assert rows(bag_of_words(phrases(SHARED), ["movieId"], scope=["movieId"]), "movieId") == [
        (1,), (1,), (2,), (2,), (3,), (3,)
    ]


def test_wordless_lines_are_one_row_unless_dropped(phrases):
    assert ("",) in rows(bag_of_words(phrases(SHARED), ["movieId"]), "phrase_key")
    dropped = bag_of_words(phrases(SHARED), ["movieId"], drop_empty=True)
    assert rows(dropped, "movieId", "phrase_key") == [(1, "good film"), (3, "bad film")]


def test_conflicting_labels_keep_the_first(spark):
    df = spark.createDataFrame(
        [(7, "great fun", 3), (4, "Great, fun", 1), (9, "dull", 0)],
        "PhraseId long, Phrase string, Sentiment int",
    )
    found = bag_of_words(df, ["PhraseId"], ["Sentiment"])
    assert rows(found, "PhraseId", "Sentiment") == [(4, 1), (9, 0)]


def test_word_order_and_repeats_distinguish_phrases(phrases):
    df = phrases([(1, "big small"), (1, "small big"), (1, "big big small")])
    assert bag_of_words(df, ["movieId", "line_no"]).count() == 3


def test_hot_phrase_is_reduced_before_the_shuffle(phrases, spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        hot = phrases([(i, "...") for i in range(900)] + [(i, f"w{'x' * i}") for i in range(9)], 4)
        df = unique_phrases(add_words(hot), ["movieId"])
        plan = plan_of(df)
        assert plan.count("Exchange hashpartitioning") == 1
        assert plan.count("HashAggregate") == 2 and "Window" not in plan
        assert df.count() == 10
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
