"""Fitted classifiers on disk."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from linetone.operators.scoring import WEIGHT


def model_path(folder: str, titles: int | None, phrases: int) -> str:
    """Path that names the sizes of the run: title limit and training phrases."""
    return f"{folder.rstrip('/')}/phrase_classifier-{titles or "all"}-titles-{phrases}-phrases"


def save_classifier(model: LogisticRegressionModel, path: str) -> str:
    """Write ``model`` to ``path``, replacing an earlier one."""
    model.write().overwrite().save(path)
    return path


def load_classifier(path: str) -> LogisticRegressionModel:
    return LogisticRegressionModel.load(path)


# The place of an intercept, before all terms.
INTERCEPT = -1

# A saved classifier's one record, as plain columns.
RECORD = (
    "numClasses int, numFeatures int, isMultinomial boolean, "
    "interceptVector struct<type: tinyint, size: int, indices: array<int>, values: array<double>>, "
    "coefficientMatrix struct<type: tinyint, numRows: int, numCols: int, colPtrs: array<int>, "
    "rowIndices: array<int>, values: array<double>, isTransposed: boolean>"
)


def read_weights(spark: SparkSession, path: str) -> DataFrame:
    """``idx``, ``class`` and ``weight`` of the classifier saved at ``path``, without zeros.

    ``idx`` is the place of a term in the vocabulary, -1 for the intercept. The record is taken
    apart in a task, so the weights never pass through Python or a driver's list. A classifier
    of two classes has one row of weights, which are those of class 1; class 0 has none, with
    which the softmax of the margins gives the same probabilities.
    """
    record = spark.read.schema(RECORD).parquet(f"{path.rstrip('/')}/data")
    shift = F.when(F.col("isMultinomial"), 0).otherwise(1)
    turned = F.col("coefficientMatrix.isTransposed")
    # The list is a column of its own: exploded beside the record, every cell would be given a
    # copy of the whole matrix. The outer form, as the plain one works the list out twice.
    cells = record.select(
        turned.alias("turned"), shift.alias("shift"), _cells(F.col("coefficientMatrix")).alias("cells")
    )
    cells = cells.select("turned", "shift", F.explode_outer("cells").alias("cell")).select(
        F.when(F.col("turned"), F.col("cell.fast")).otherwise(F.col("cell.slow")).alias("idx"),
        (F.when(F.col("turned"), F.col("cell.slow")).otherwise(F.col("cell.fast")) + F.col("shift")).alias("class"),
        F.col("cell.weight").alias("weight"),
    )
    constants = record.select(shift.alias("shift"), _entries(F.col("interceptVector")).alias("cells"))
    constants = constants.select("shift", F.explode_outer("cells").alias("cell")).select(
        F.lit(INTERCEPT).alias("idx"),
        (F.col("cell.place") + F.col("shift")).alias("class"),
        F.col("cell.weight").alias("weight"),
    )
    return cells.unionByName(constants).where("weight <> 0")


def save_vectoriser(model: CountVectorizerModel, path: str) -> str:
    """Write ``model`` to ``path``, replacing an earlier one."""
    model.write().overwrite().save(path)
    return path


def read_terms(spark: SparkSession, path: str) -> DataFrame:
    """``idx`` and ``term`` of the vectoriser saved at ``path``; ``vocab_size`` bounds the list."""
    record = spark.read.schema("vocabulary array<string>").parquet(f"{path.rstrip('/')}/data")
    return record.select(F.posexplode("vocabulary").alias("idx", "term"))


def _cells(matrix: Column) -> Column:
    """Cells of a matrix, dense or sparse: place in the dimension that runs fast, in the other, value."""
    fast_size = F.when(matrix["isTransposed"], matrix["numCols"]).otherwise(matrix["numRows"])

    def cell(fast: Column, slow: Column, weight: Column) -> Column:
        return F.struct(
            fast.cast("int").alias("fast"), slow.cast("int").alias("slow"), weight.alias("weight")
        )

    def line(slow: Column) -> Column:
        # By place, so that no line depends on how a part of a list is taken.
        start, end = F.get(matrix["colPtrs"], slow), F.get(matrix["colPtrs"], slow + 1)
        places = F.when(end > start, F.sequence(start, end - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(
            places, lambda p: cell(F.get(matrix["rowIndices"], p), slow, F.get(matrix["values"], p))
        )

    dense = F.transform(matrix["values"], lambda v, i: cell(i % fast_size, F.floor(i / fast_size), v))
    lines = F.sequence(F.lit(0), F.size(matrix["colPtrs"]) - 2)
    return F.when(matrix["type"] == 1, dense).otherwise(F.flatten(F.transform(lines, line)))


def _entries(vector: Column) -> Column:
    entry = lambda v, i: F.struct(i.cast("int").alias("place"), v.alias("weight"))
    sparse = F.zip_with(vector["values"], vector["indices"], entry)
    return F.when(vector["type"] == 1, F.transform(vector["values"], entry)).otherwise(sparse)


def term_weights(
    weights: DataFrame, vocabulary: DataFrame, classes: int
) -> tuple[DataFrame, list[float]]:
    """``term`` with one ``weight_<class>`` per class, and the intercepts.

    ``weights`` as :func:`read_weights` gives them, ``vocabulary`` with ``idx`` and ``term``.
    Terms without a weight other than zero are left out. Only the intercepts are collected.
    """
    value = lambda k: F.coalesce(F.sum(F.when(F.col("class") == k, F.col("weight"))), F.lit(0.0))
    of_terms = weights.where(F.col("idx") != INTERCEPT).groupBy("idx")
    wide = of_terms.agg(*(value(k).alias(WEIGHT.format(k)) for k in range(classes)))
    named = wide.join(vocabulary.select("idx", "term"), "idx").drop("idx")
    rows = weights.where(F.col("idx") == INTERCEPT).select("class", "weight").collect()
    constants = {r["class"]: r["weight"] for r in rows}
    return named, [constants.get(k, 0.0) for k in range(classes)]
