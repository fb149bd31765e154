"""Ranked vocabulary and term counts."""

from __future__ import annotations

from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame, functions as F

from linetone.operators.ordered import running_totals
from linetone.session import new_path

# Fixed value: the default vocabulary size of Spark's count vectoriser.
VOCAB_SIZE = 262_144


def combined_corpus(*parts: DataFrame, column: str = "filtered") -> DataFrame:
    """All ``column`` values of all parts, repeats kept."""
    corpus, *rest = (part.select(column) for part in parts)
    for part in rest:
        corpus = corpus.unionByName(part)
    return corpus


def explode_terms(rows: DataFrame, column: str = "filtered") -> DataFrame:
    """One row per word in place of the list; a row without words gives one null.

    The outer form, because Spark guards the inner form with a filter on the list's
    size, and pushing that filter down evaluates the whole tokeniser twice.
    """
    others = [c for c in rows.columns if c != column]
    return rows.select(*others, F.explode_outer(column).alias("term"))


def term_frequencies(corpus: DataFrame, column: str = "filtered") -> DataFrame:
    """``term`` and its ``count`` over the corpus."""
    terms = explode_terms(corpus.select(column), column).where(F.col("term").isNotNull())
    return terms.groupBy("term").agg(F.count("*").alias("count"))


def ranked_vocabulary(
    corpus: DataFrame, size: int | None = None, column: str = "filtered"
) -> DataFrame:
    """All terms, or the ``size`` most frequent, as ``idx`` (from 0), ``term``, ``count``.

    Equal counts are ranked by term, so the result does not depend on partitioning. The
    terms are sorted over all tasks and numbered by the totals of the partitions before:
    no task sees more than a partition, however many terms are equally rare.
    """
    order = [F.desc("count"), F.asc("term")]
    one = F.lit(1).cast("long")
    ranked = running_totals(term_frequencies(corpus, column), order, {"rank": one})
    if size is not None:
        ranked = ranked.where(F.col("rank") <= size)
    return ranked.select((F.col("rank") - 1).cast("int").alias("idx"), "term", "count")


def fit_vectoriser(
    corpus: DataFrame,
    size: int = VOCAB_SIZE,
    column: str = "filtered",
    output: str = "features",
) -> CountVectorizerModel:
    """Count vectoriser over the ranked vocabulary.

    The model takes its terms as one list, which ``size`` bounds. Handing that list
    over from Python costs one call per term, so Spark writes it into a saved model
    instead, in the form such a model has on disk, and the model is loaded from there.
    """
    spark = corpus.sparkSession
    path = new_path(spark, "vectoriser")
    shell = CountVectorizerModel.from_vocabulary([""], inputCol=column, outputCol=output)
    shell.set(shell.vocabSize, size)
    shell.write().save(path)
    in_order = F.array_sort(F.collect_list(F.struct("idx", "term")))
    terms = ranked_vocabulary(corpus, size, column).agg(in_order["term"].alias("vocabulary"))
    terms.write.mode("overwrite").parquet(f"{path}/data")
    ranked = spark.read.parquet(f"{path}/data").select(F.size("vocabulary")).first()[0]
    if not ranked:
        raise ValueError("the corpus holds no term to build a vocabulary from")
    model = CountVectorizerModel.load(path)
    if len(model.vocabulary) != ranked:
        raise RuntimeError(f"{len(model.vocabulary)} terms were loaded, {ranked} ranked")
    return model


def term_counts(
    rows: DataFrame, vocabulary: DataFrame, column: str = "filtered"
) -> DataFrame:
    """Long form of the count vectors: the other columns of ``rows``, ``idx``, ``n``.

    A row holds all its words, so it is counted where it lies and gives a row per distinct
    word. How these meet the vocabulary Spark decides by its bytes. Words outside the
    vocabulary are ignored. ``phrase_key`` is not carried along.
    """
    others = [c for c in rows.columns if c not in (column, "phrase_key")]
    index = vocabulary.select("term", "idx")
    return word_runs(rows, others, column).join(index, "term").select(*others, "idx", "n")


def word_runs(rows: DataFrame, others: list[str], column: str) -> DataFrame:
    """Distinct words ``term`` of each row with their number ``n``; a row without words has none.

    Sorts the list and measures the runs of equal words. The list and the run starts
    are columns of their own, so that neither is worked out again for every word.
    """
    last = F.size("sorted") - 1
    starts = F.filter(
        F.when(last >= 0, F.sequence(F.lit(0), last)),
        lambda i: (i == 0) | (F.get("sorted", i) != F.get("sorted", i - 1)),
    )
    runs = F.transform(
        "starts",
        lambda start, k: F.struct(
            F.get("sorted", start).alias("term"),
            (F.coalesce(F.get("starts", k + 1), F.size("sorted")) - start)
            .cast("long")
            .alias("n"),
        ),
    )
    return (
        rows.select(*others, F.sort_array(column).alias("sorted"))
        .select(*others, "sorted", starts.alias("starts"))
        .select(*others, F.explode_outer(runs).alias("run"))
        .where(F.col("run").isNotNull())
        .select(*others, "run.term", "run.n")
    )
