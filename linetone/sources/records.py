"""Delimited files read with a fixed schema, bad rows set apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

RAW = "rejected_record"


def read_records(
    spark: SparkSession, path: str, schema: str, required: Sequence[str], **options
) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)`` of a delimited file with a header.

    A record is rejected when it has a cell too many or too few, a quote that stays open,
    a cell that does not parse, or an empty ``required`` column. Rejects carry the raw
    record. Rows and rejects are two filters over one scan definition, so nothing is lost.
    """
    full = spark.read.csv(
        path,
        schema=f"{schema}, {RAW} string",
        header=True,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=RAW,
        **options,
    )
    complete = is_complete(full, required)
    return full.where(complete).drop(RAW), full.where(~complete)


def is_complete(full: DataFrame, required: Sequence[str]) -> Column:
    """Whether a record of a scan with the raw record beside it is accepted."""
    columns = [c for c in full.columns if c != RAW]
    # Spark checks the cells of the columns that a query reads. The count of filled cells
    # reads them all, so that the verdict on a record is the same for every query.
    filled = sum(F.col(f"`{c}`").isNotNull().cast("int") for c in columns)
    complete = F.col(RAW).isNull() & (filled <= len(columns))
    for column in required:
        complete = complete & F.col(f"`{column}`").isNotNull()
    return complete
