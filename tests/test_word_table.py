from __future__ import annotations

import pytest
from conftest import rows

from linetone.functions import ENGLISH
from linetone.operators import add_words, content_words_by_table, drop_listed_words, word_counts, word_stream

LINES = [
    (1, "The cat, the hat"),
    (1, ""),
    (2, "the the the"),
    (2, "Cat's and DOGS"),
    (3, "no word of the list"),
    (3, None),
]


def words_of(spark, words):
    return spark.createDataFrame([(w,) for w in words], "word string")


def test_equal_to_the_pinned_list(spark, phrases):
    lines = phrases(LINES, 3)
    kept = drop_listed_words(word_stream(lines, stop=()), words_of(spark, ENGLISH))
    assert rows(word_counts(kept)) == rows(word_counts(word_stream(lines)))
    lists = content_words_by_table(add_words(lines, stop=()), words_of(spark, ENGLISH), ["movieId", "line_no"])
    want = add_words(lines).select("movieId", "line_no", "filtered")
    assert rows(lists) == rows(want) and lists.count() == 5


def test_a_million_words_and_hot_ones(spark):
    """Every second of the usual words is listed, and one of two hot words."""
    listed = spark.range(1_000_000).selectExpr("concat('w', 2 * id) AS word")
    listed = listed.unionByName(words_of(spark, ["hot", "Hot", None]))
    stream = spark.range(60_000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN 'warm' ELSE concat('w', id) END AS word"
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = drop_listed_words(stream, listed).selectExpr("id", "word").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = {i for i in range(60_000) if i % 3 == 1 or (i % 3 == 2 and i % 2 == 1)}
    assert len(kept) == len(want) and {r["id"] for r in kept} == want


@pytest.mark.parametrize("share", [1.0, 1e-9])
def test_hot_or_not_makes_no_difference(spark, phrases, monkeypatch, share):
    monkeypatch.setattr("linetone.operators.word_table.HOT_SHARE", share)
    stream = word_stream(phrases(LINES, 2), stop=())
    found = drop_listed_words(stream, words_of(spark, ["the", "NO", "unknown"]))
    assert sorted(r["word"] for r in found.collect()) == [
        "and", "cat", "cats", "dogs", "hat", "list", "of", "word"
    ]


def test_nulls_repeats_and_empty_tables(spark):
    lists = spark.createDataFrame(
        [(1, ["b", "a", "b"]), (2, []), (3, None), (4, ["x"]), (None, ["a", "x"])], "k long, filtered array<string>"
    )
    none = words_of(spark, [])
    same = [tuple(r) for r in lists.collect()]
    found = content_words_by_table(lists, none, ["k"])
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(same, key=repr)
    found = content_words_by_table(lists, words_of(spark, ["a", "x", "x"]), ["k"])
    assert {r["k"]: r["filtered"] for r in found.collect()} == {1: ["b", "b"], 2: [], 3: None, 4: [], None: []}
    stream = spark.createDataFrame([("a",), (None,), ("b",)], "word string")
    assert rows(drop_listed_words(stream, words_of(spark, ["a"]))) == [("b",), (None,)]
    assert rows(drop_listed_words(stream.limit(0), words_of(spark, ["a"]))) == []
