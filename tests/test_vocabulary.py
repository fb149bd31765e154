from __future__ import annotations

from collections import Counter

import pytest
from conftest import plan_of, rows
from pyspark.ml.feature import CountVectorizer

from linetone.operators import (
    add_words,
    combined_corpus,
    fit_vectoriser,
    ranked_vocabulary,
    term_counts,
)

TIED = [
    (1, "pear apple fig"),
    (2, "fig apple pear"),
    (3, "plum plum plum"),
    (4, "zebra"),
    (5, "..."),
    (6, "kiwi plum"),
]


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_ties_rank_by_term(phrases, partitions):
    corpus = add_words(phrases(TIED, partitions))
    expected = [("plum", 4), ("apple", 2), ("fig", 2), ("pear", 2), ("kiwi", 1), ("zebra", 1)]
    ranked = ranked_vocabulary(corpus).orderBy("idx").collect()
    assert [tuple(r) for r in ranked] == [(i, t, n) for i, (t, n) in enumerate(expected)]
    assert fit_vectoriser(corpus).vocabulary == [t for t, _ in expected]
    assert fit_vectoriser(corpus, size=2).vocabulary == ["plum", "apple"]


@pytest.mark.parametrize("size", range(1, 8))
def test_cut_off_keeps_every_rank(phrases, size):
    corpus = add_words(phrases(TIED, 3))
    whole = [tuple(r) for r in ranked_vocabulary(corpus).orderBy("idx").collect()]
    assert [tuple(r) for r in ranked_vocabulary(corpus, size).orderBy("idx").collect()] == (
        whole[:size]
    )


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_single_occurrences_are_ranked_over_all_tasks(spark, phrases, partitions):
    letters = "abcdefghij"
    words = [f"w{a}{b}{c}" for a in letters for b in letters for c in letters]
    corpus = add_words(phrases([(i, f"{w} top") for i, w in enumerate(words)], partitions))
    ranked = ranked_vocabulary(corpus)
    found = [tuple(r) for r in ranked.orderBy("idx").collect()]
    expected = [("top", 1000)] + [(w, 1) for w in sorted(words)]
    assert found == [(i, t, n) for i, (t, n) in enumerate(expected)]
    windows = [line for line in plan_of(ranked).splitlines() if "Window [" in line]
    assert len(windows) == 2 and sum("[_part" in line for line in windows) == 2


def test_same_counts_as_the_ml_estimator(phrases):
    corpus = add_words(phrases(TIED))
    theirs = CountVectorizer(inputCol="filtered", outputCol="f").fit(corpus).vocabulary
    assert sorted(theirs) == sorted(fit_vectoriser(corpus).vocabulary)


def test_union_keeps_repeats(phrases):
    left, right = add_words(phrases([(1, "twin")])), add_words(phrases([(2, "twin"), (2, "new")]))
    corpus = combined_corpus(left, right)
    assert corpus.columns == ["filtered"]
    assert rows(ranked_vocabulary(corpus)) == [(0, "twin", 2), (1, "new", 1)]


def test_long_form_equals_vectors(phrases):
    corpus = add_words(phrases(TIED + [(7, "plum outside plum")]))
    seen = corpus.where("movieId <> 7")
    model = fit_vectoriser(seen)
    expected = Counter()
    for row in model.transform(corpus).collect():
        vector = row["features"]
        for index, n in zip(vector.indices, vector.values):
            expected[row["movieId"], int(index)] = int(n)
    long = term_counts(corpus.select("movieId", "filtered"), ranked_vocabulary(seen))
    assert {(r["movieId"], r["idx"]): r["n"] for r in long.collect()} == dict(expected)


def test_empty_corpus(phrases):
    with pytest.raises(ValueError, match="no term"):
        fit_vectoriser(add_words(phrases([(1, "...")])))
