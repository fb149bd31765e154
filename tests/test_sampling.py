from __future__ import annotations

import hashlib
import random

import pytest
from conftest import plan_of, rows

from linetone.operators import row_hash, sample_per_label


def table(spark, sizes, partitions=3):
    """Rows ``(PhraseId, Phrase, Sentiment)`` in any order."""
    found = [(100 * k + i, f"p{i % 3}", label) for k, (label, n) in enumerate(sizes.items()) for i in range(n)]
    random.Random(1).shuffle(found)
    return found, spark.createDataFrame(found, "PhraseId long, Phrase string, Sentiment int").repartition(partitions)


def plain_hash(value, seed=""):
    return hashlib.md5(f"{seed}\x1f={value}".encode()).hexdigest()


def plain_sample(found, n, seed=""):
    by_label: dict = {}
    for row in found:
        by_label.setdefault(row[2], []).append(row)
    picked = [sorted(of, key=lambda r: plain_hash(r[0], seed))[:n] for of in by_label.values()]
    return sorted((r for of in picked for r in of), key=repr)


SIZES = {0: 90, 1: 7, 2: 3, None: 20}


@pytest.mark.parametrize("n", [1, 3, 7, 50, 1000])
def test_first_rows_of_each_label_by_hash(spark, n):
    found, df = table(spark, SIZES)
    assert rows(sample_per_label(df, n, ["PhraseId"])) == plain_sample(found, n)


def test_partitioning_does_not_matter_but_the_seed_does(spark):
    found, df = table(spark, SIZES, partitions=1)
    first = rows(sample_per_label(df, 5, ["PhraseId"], seed="a"))
    assert first == rows(sample_per_label(df.repartition(7), 5, ["PhraseId"], seed="a"))
    assert first == plain_sample(found, 5, "a") != plain_sample(found, 5, "b")


def test_ties_take_the_other_columns_and_repeats_are_rows(spark):
    found = [(1, "b", 0), (1, "a", 0), (1, "c", 0), (None, "x", 0), (2, "r", 1), (2, "r", 1), (2, "r", 1)]
    df = spark.createDataFrame(found, "PhraseId long, Phrase string, Sentiment int").repartition(3)
    ones = [r for r in rows(sample_per_label(df, 3, ["PhraseId"])) if r[2] == 0]
    nulls_first = df.where("Sentiment = 0").orderBy(row_hash(["PhraseId"]), "Phrase").limit(3)
    assert ones == rows(nulls_first)
    assert rows(sample_per_label(df, 2, ["PhraseId"]).where("Sentiment = 1")) == [(2, "r", 1)] * 2
    assert rows(sample_per_label(df.limit(0), 2, ["PhraseId"])) == []


def test_ranges_of_a_large_label(spark):
    """The cut falls in the middle of the ranges; only one of them is sorted."""
    df = spark.range(20_000).selectExpr("id AS PhraseId", "cast(id % 2 AS int) AS Sentiment")
    sample = sample_per_label(df, 6_000, ["PhraseId"])
    assert sample.groupBy("Sentiment").count().where("count <> 6000").count() == 0
    assert plan_of(sample).count("Window") >= 2
    kept = {r["PhraseId"] for r in sample.where("Sentiment = 0").collect()}
    assert kept == set(sorted(range(0, 20_000, 2), key=plain_hash)[:6_000])
