"""Running totals over a whole table in a global order, without one task seeing all rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from linetone.session import stage

PART, ROW = "_part", "_row"


def running_totals(
    df: DataFrame, order: Sequence[Column], sums: Mapping[str, Column], ties: bool = False
) -> DataFrame:
    """``df`` with, for each name in ``sums``, its total up to and including the row.

    Rows are range-partitioned by ``order`` and written with their partition number. The
    partitions' totals, one row each, give every partition its offset; the rest is a
    window within the partition. Rows equal in ``order`` count in either sequence and are
    one task's; with ``ties``, for orders that many rows may be equal in, a number of the row
    comes last in the order and they are dealt out, too. An empty table gives an empty table.
    ``df`` must not have a column named ``_part``, ``_row`` or like one of ``sums``.
    """
    ranged = df.select("*", *(total.alias(name) for name, total in sums.items()))
    if ties:
        ranged = ranged.withColumn(ROW, F.monotonically_increasing_id())
        order = [*order, F.col(ROW)]
    ranged = ranged.repartitionByRange(*order).withColumn(PART, F.spark_partition_id())
    ranged = stage(ranged, "ranged")
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(PART)
        .agg(*(F.sum(name).alias(name) for name in sums))
        .select(PART, *(F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_{n}") for n in sums))
    )
    within = Window.partitionBy(PART).orderBy(*order)
    within = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        ranged.join(offsets, PART)
        .withColumns({n: F.col(f"_{n}") + F.sum(n).over(within) for n in sums})
        .drop(PART, ROW, *(f"_{n}" for n in sums))
    )
