"""Stateless operators on a stream, and what is kept up to date with one."""

from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

import linetone.streaming.phrases
from linetone.operators import add_words, bag_of_words, fit_vectoriser, score_phrases, title_report
from linetone.session import complete_folders
from linetone.streaming import (
    compact_totals,
    keep_changes,
    merge_batch,
    phrase_changes,
    rank_value,
    start_title_report,
    stream_title_report,
    surviving_phrases,
    title_totals,
)
from linetone.streaming.phrases import row_rank


def test_lines_of_arriving_files(spark, tmp_path):
    known = spark.createDataFrame([("good film",), ("bad film",)], "Phrase string")
    model = fit_vectoriser(add_words(known))
    folder = tmp_path / "arriving"
    folder.mkdir()
    (folder / "one.en.srt").write_text("A good, good film\n12:30\n")
    stream = spark.readStream.text(str(folder)).withColumnRenamed("value", "Phrase")
    query = (
        model.transform(add_words(stream))
        .writeStream.format("memory")
        .queryName("arrived")
        .option("checkpointLocation", str(tmp_path / "state"))
        .start()
    )
    try:
        query.processAllAvailable()
        (folder / "two.en.srt").write_text("bad\n")
        query.processAllAvailable()
    finally:
        query.stop()
    arrived = spark.table("arrived")
    assert rows(arrived, "filtered") == [(("bad",),), (("good", "good", "film"),), ((),)]
    assert {r["features"].numNonzeros() for r in arrived.collect()} == {0, 1, 2}


ORDER = ["movieId", "turn"]
SCHEMA = "movieId long, turn long, Phrase string"
WEIGHTS = {"bad": (0.0, 0.0, 0.0), "good": (0.0, 0.0, 5.0), "dull": (4.0, 0.0, 0.0)}
INTERCEPTS = (0.0, 1.0, 0.0)


def some_lines(seed):
    picks = random.Random(seed)
    words = ["good", "dull", "bad", "film", "the", "12:30", "plot"]
    found = [
        (picks.choice([-3, 1, 2, 3, 1 << 40]), i, " ".join(picks.choices(words, k=picks.randrange(4))))
        for i in range(120)
    ]
    return [*found, (7, None, "good plot twist"), (None, 1, "nobody good"), (4, 1, None), found[5], found[5]]


def arrive(spark, folder, batches, run):
    """Each batch is written and met by a query started anew."""
    for batch in batches:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/arrived")
        query = run(spark.readStream.schema(SCHEMA).parquet(f"{folder}/arrived"))
        query.awaitTermination()


def unique_run(kept):
    return lambda lines: (
        phrase_changes(lines, ORDER)
        .writeStream.outputMode("update")
        .option("checkpointLocation", f"{kept}/checkpoint")
        .trigger(availableNow=True)
        .foreachBatch(lambda changes, batch_id: keep_changes(changes, batch_id, kept))
        .start()
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_survivors_do_not_depend_on_the_order_of_arrival(spark, tmp_path, seed):
    lines = some_lines(seed)
    whole = bag_of_words(spark.createDataFrame(lines, SCHEMA), ORDER)
    want = rows(whole, "phrase_key", *ORDER)
    random.Random(seed).shuffle(lines)
    kept = str(tmp_path / "kept")
    arrive(spark, tmp_path, [lines[:40], lines[40:90], lines[90:]], unique_run(kept))
    assert rows(surviving_phrases(spark, kept, ORDER), "phrase_key", *ORDER) == want
    assert rows(surviving_phrases(spark, str(tmp_path / "none"), ORDER)) == []


def test_a_late_earlier_row_takes_the_place_over(spark, tmp_path):
    kept = str(tmp_path / "kept")
    batches = [[(9, 1, "good film")], [(9, 2, "good film"), (5, 1, "Good FILM")], [(6, 1, "good film")]]
    arrive(spark, tmp_path, batches, unique_run(kept))
    assert rows(surviving_phrases(spark, kept, ORDER), *ORDER) == [(5, 1)]
    changes = spark.read.parquet(*complete_folders(spark, f"{kept}/changes"))
    moves = rows(changes.select(rank_value(F.col("rank"), 0), rank_value(F.col("before"), 0)))
    assert moves == [(5, 9), (9, None)]  # the third batch changes nothing


def score(df):
    return score_phrases(df, WEIGHTS, INTERCEPTS, "Sentiment_Predicted")


def totals_of(scored):
    """What the totals of a table of classes are, in plain sums."""
    value, rest = F.col("Sentiment_Predicted"), F.col("Sentiment_Predicted") != 2.0
    return scored.groupBy("movieId").agg(
        F.sum(value).alias("total"),
        F.count("*").alias("n"),
        F.coalesce(F.sum(F.when(rest, value)), F.lit(0.0)).alias("rest_total"),
        F.count(F.when(rest, 1)).alias("rest_n"),
    )


def test_report_over_a_stream(spark, tmp_path):
    """Restarted for every batch, and added up on the way."""
    lines = some_lines(3)
    unique = bag_of_words(spark.createDataFrame(lines, SCHEMA), ORDER)
    scored = score(unique.select("movieId", "filtered"))
    want = rows(totals_of(scored))
    random.Random(3).shuffle(lines)
    kept = str(tmp_path / "kept")
    run = lambda df: start_title_report(df, ORDER, score, kept, every=2, availableNow=True)
    arrive(spark, tmp_path, [lines[:30], lines[30:60], lines[60:100], lines[100:]], run)
    assert rows(title_totals(spark, kept).where("n > 0")) == want
    assert len(complete_folders(spark, f"{kept}/totals")) < 4  # earlier ones are added up
    titles = spark.createDataFrame([(i, f"t{i}") for i in (-3, 1, 2, 3, 7, 8)], "movieId long, title string")
    assert rows(stream_title_report(titles, title_totals(spark, kept))) == rows(title_report(titles, scored))
    every = title_report(titles, scored, keep_all_titles=True)
    assert rows(stream_title_report(titles, title_totals(spark, kept), keep_all_titles=True)) == rows(every)


def test_a_repeated_batch_counts_once(spark, tmp_path):
    kept = str(tmp_path)
    first = [(f"good film {i}", i % 3, None) for i in range(9)]
    second = [("good film 1", 0, 1), ("dull plot", 2, None)]
    schema = "phrase_key string, now long, earlier long"
    batches = []
    for moves in (first, second):
        moved = spark.createDataFrame(moves, schema)
        ranked = moved.withColumn("movieId", F.col("now")).withColumn("turn", F.lit(0))
        earlier = F.when(F.col("earlier").isNotNull(), row_rank(["earlier", "turn"]))
        batches.append(ranked.select("phrase_key", row_rank(ORDER).alias("rank"), earlier.alias("before")))
    for i in (0, 1, 1, 0):
        merge_batch(batches[i], i, kept, score)
    once = rows(title_totals(spark, kept))
    assert once == [(0, 8.0, 4, 0.0, 0), (1, 4.0, 2, 0.0, 0), (2, 6.0, 4, 0.0, 1)]
    compact_totals(spark, kept, 1)
    assert rows(title_totals(spark, kept)) == once
    assert complete_folders(spark, f"{kept}/totals") == []
    merge_batch(batches[0].limit(0), 2, kept, score)
    compact_totals(spark, kept, 2)
    compact_totals(spark, kept, 2)
    assert rows(title_totals(spark, kept)) == once


def test_ranks_sort_as_their_columns(spark):
    values = [None, -(1 << 63), -5, -1, 0, 1, 77, (1 << 63) - 1]
    pairs = spark.createDataFrame([(a, b) for a in values for b in values], "movieId long, turn long")
    ranked = pairs.withColumn("rank", row_rank(ORDER))
    by_rank = [tuple(r)[:2] for r in ranked.orderBy("rank").collect()]
    assert by_rank == [tuple(r) for r in pairs.orderBy(*ORDER).collect()]
    back = ranked.select("movieId", "turn", *(rank_value(F.col("rank"), i).alias(f"v{i}") for i in (0, 1)))
    assert all(r["movieId"] == r["v0"] and r["turn"] == r["v1"] for r in back.collect())


def test_phrases_share_a_value_of_the_state(spark, tmp_path, monkeypatch):
    """The state is called and written per bucket, not per phrase, and late rows still take over."""
    monkeypatch.setattr(linetone.streaming.phrases, "BUCKETS", 2)
    words = [f"word{chr(97 + i)}" for i in range(20)]
    later = [(2, i, w) for i, w in enumerate(words)]
    earlier = [(1, i, w) for i, w in enumerate(words[:5])]
    kept, values = str(tmp_path / "kept"), []

    def run(lines):
        query = (
            phrase_changes(lines, ORDER)
            .writeStream.outputMode("update")
            .option("checkpointLocation", f"{kept}/checkpoint")
            .trigger(availableNow=True)
            .foreachBatch(lambda changes, batch_id: keep_changes(changes, batch_id, kept))
            .start()
        )
        query.awaitTermination()
        values.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
        return query

    arrive(spark, tmp_path, [later, earlier], run)
    assert values == [2, 2]
    found = rows(surviving_phrases(spark, kept, ORDER), "phrase_key", "movieId", "turn")
    assert found == sorted((w, 1 if i < 5 else 2, i) for i, w in enumerate(words))
    moved = spark.read.parquet(f"{kept}/changes/batch=1").where("before is not null")
    assert moved.count() == 5
