"""A sample of so many rows per label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Ranges that the hashes are counted in, by their first hexadecimal digits.
DIGITS = 3


def row_hash(by: Sequence[str], seed: str = "") -> Column:
    """Hexadecimal MD5 of ``seed`` and the columns ``by`` as text, nulls told from texts."""
    parts = (F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in by)
    return F.md5(F.concat_ws("\x1f", F.lit(seed), *parts))


def sample_per_label(
    rows: DataFrame, n: int, by: Sequence[str], label: str = "Sentiment", seed: str = ""
) -> DataFrame:
    """The ``n`` rows of each ``label`` that come first by hash of ``by``; all of a label with fewer.

    The same rows every time, whatever the partitioning; another ``seed`` gives others. Rows
    with equal ``by`` are taken in the order of their other columns, equal rows as they come.
    A null label is a label.

    Any ``n`` and any label sizes: hashes are counted per label and range first, which tells
    the range where the last row falls. Ranges before it are taken as they are, and only that
    one is sorted, a small share of its label. No label is sorted, nor collected, as a whole.
    """
    hashed = rows.withColumn("_hash", row_hash(by, seed))
    hashed = hashed.withColumn("_range", F.substring("_hash", 1, DIGITS))
    counts = hashed.groupBy(F.col(label).alias("_label"), "_range").agg(F.count("*").alias("_n"))
    upward = Window.partitionBy("_label").orderBy("_range")
    counts = counts.withColumn("_before", F.sum("_n").over(upward) - F.col("_n"))
    # The range in which row number n lies, or the last.
    last = counts.where(F.col("_before") < n).groupBy("_label").agg(
        F.max(F.struct("_range", "_before")).alias("_last")
    )
    same = F.col(label).eqNullSafe(F.col("_label"))
    placed = hashed.join(last, same).where(F.col("_range") <= F.col("_last._range"))
    whole = placed.where(F.col("_range") < F.col("_last._range"))
    others = [c for c in rows.columns if c != label and _sortable(rows, c)]
    first = Window.partitionBy(label).orderBy("_hash", *by, *others)
    cut = placed.where(F.col("_range") == F.col("_last._range"))
    cut = cut.withColumn("_place", F.row_number().over(first))
    cut = cut.where(F.col("_place") <= n - F.col("_last._before"))
    return whole.select(*rows.columns).unionByName(cut.select(*rows.columns))


def _sortable(rows: DataFrame, column: str) -> bool:
    return rows.schema[column].dataType.typeName() not in ("map", "variant")
