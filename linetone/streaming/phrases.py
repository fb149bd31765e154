"""Unique phrases of a stream: which row stands for a word list, as lines arrive in any order."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import chain

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from linetone.functions import ENGLISH, key_words, phrase_key
from linetone.operators.bag_of_words import add_words
from linetone.session import complete_folders

# Characters that a rank has for each column, and the least long, which has the sign bit only.
WIDTH = 16
LEAST = -(1 << 63)

# Values of the state that the digests are dealt to. A stream that goes on keeps its number.
BUCKETS = 4096

CHANGES = "phrase_key string, rank string, before string"


def row_rank(order: Sequence[str]) -> Column:
    """A string that sorts as the whole-number columns ``order`` do, nulls first."""
    digits = [
        F.lpad(F.hex(F.col(c).cast("long").bitwiseXOR(F.lit(LEAST))), WIDTH, "0") for c in order
    ]
    return F.concat(*(F.coalesce(d, F.lit("-" * WIDTH)) for d in digits))


def rank_value(rank: Column, place: int) -> Column:
    """The value that column number ``place`` of the order has in a :func:`row_rank`."""
    digits = F.substring(rank, place * WIDTH + 1, WIDTH)
    value = F.conv(digits, 16, -10).cast("long").bitwiseXOR(F.lit(LEAST))
    return F.when(~digits.startswith("-"), value)


def _least_of_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per phrase of an Arrow batch, so that a hot phrase is not shuffled row by row."""
    for batch in batches:
        yield batch.sort_values("rank").drop_duplicates("phrase")


def _first_rows(key: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Keep the least rank of each phrase of a bucket; give the changes, if there are any."""
    kept = state.get[0].split(" ") if state.exists else []
    held = dict(zip(kept[::2], kept[1::2], strict=True))
    least: dict[str, tuple[str, str]] = {}
    for batch in batches:
        for phrase, text, rank in zip(batch["phrase"], batch["phrase_key"], batch["rank"], strict=True):
            before = least[phrase][0] if phrase in least else held.get(phrase)
            if before is None or rank < before:
                least[phrase] = rank, text
    if least:
        changes = [(text, rank, held.get(phrase)) for phrase, (rank, text) in least.items()]
        held |= {phrase: rank for phrase, (rank, _) in least.items()}
        state.update((" ".join(chain.from_iterable(held.items())),))
        yield pd.DataFrame(changes, columns=["phrase_key", "rank", "before"])


def phrase_changes(
    lines: DataFrame, order: Sequence[str], text: str = "Phrase", stop: Iterable[str] = ENGLISH
) -> DataFrame:
    """Changes of the row that stands for each distinct word list of a stream of lines.

    ``phrase_key`` is the list, ``rank`` the place in ``order`` (whole numbers) of the row that
    stands for it now and ``before`` of the one that did, null for a new list. A row that comes
    late and is earlier in ``order`` takes the place over, so what is left does not depend on
    the order of arrival. State is one rank per distinct list, under a digest of it, and lists
    share a call and a value of the state by ``BUCKETS``: a call per list costs far more than
    what it does.
    """
    keyed = add_words(lines, text, stop).select(
        phrase_key(F.col("filtered")).alias("phrase_key"), row_rank(order).alias("rank")
    )
    named = keyed.select(F.md5("phrase_key").alias("phrase"), "phrase_key", "rank")
    least = named.mapInPandas(_least_of_batch, named.schema)
    least = least.withColumn("bucket", F.pmod(F.xxhash64("phrase"), F.lit(BUCKETS)))
    return least.groupBy("bucket").applyInPandasWithState(
        _first_rows, CHANGES, "ranks string", "update", GroupStateTimeout.NoTimeout
    )


def keep_changes(changes: DataFrame, batch_id: int, folder: str) -> None:
    """Write a batch of :func:`phrase_changes`; a batch that comes again replaces itself."""
    changes.write.mode("overwrite").parquet(f"{folder}/changes/batch={batch_id}")


def surviving_phrases(spark: SparkSession, folder: str, order: Sequence[str]) -> DataFrame:
    """``phrase_key``, ``filtered`` and ``order`` of the rows that stand for the lists so far.

    Of all changes of a list the least rank counts, so a repeated batch makes no difference.
    """
    paths = complete_folders(spark, f"{folder}/changes")
    changes = spark.read.schema(CHANGES).parquet(*paths) if paths else spark.createDataFrame([], CHANGES)
    least = changes.groupBy("phrase_key").agg(F.min("rank").alias("rank"))
    values = (rank_value(F.col("rank"), i).alias(c) for i, c in enumerate(order))
    return least.select("phrase_key", key_words(F.col("phrase_key")).alias("filtered"), *values)
