"""Types of columns of text, found from all their cells."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from linetone.sources.records import RAW, is_complete

# From narrow to wide. A column has the first type that all of its cells have; numbers widen
# within numbers, and what fits nothing else is a string.
LATTICE = ("int", "bigint", "decimal(38,0)", "double", "boolean", "timestamp", "string")

# How cells of these types are written, as the CSV reader knows them.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?[dDfF]?$"
SPECIAL = ("NaN", "Inf", "-Inf", "+Inf", "Infinity", "-Infinity")
STAMP = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:\d{2})?)?$"


def _fits(cell: Column, of: str) -> Column:
    if of in ("int", "bigint", "decimal(38,0)"):
        return cell.rlike(r"^[+-]?\d+$") & cell.try_cast(of).isNotNull()
    if of == "double":
        return cell.rlike(NUMBER) | cell.isin(*SPECIAL)
    if of == "boolean":
        return F.lower(cell).isin("true", "false")
    if of == "timestamp":
        return cell.rlike(STAMP) & cell.try_cast("timestamp").isNotNull()
    return F.lit(True)


def inferred_types(cells: DataFrame, columns: Sequence[str] | None = None) -> dict[str, str]:
    """The narrowest type of ``LATTICE`` that fits all non-null cells of each text column.

    One aggregate over all rows: per column and type it counts the cells that do not fit, so a
    single late cell widens its column. A column without cells is a string.
    """
    columns = list(cells.columns if columns is None else columns)
    misfits = [
        F.count(F.when(F.col(f"`{c}`").isNotNull() & ~_fits(F.col(f"`{c}`"), of), 1)).alias(f"{i} {of}")
        for i, c in enumerate(columns)
        for of in LATTICE
    ]
    filled = [F.count(f"`{c}`").alias(f"{i} filled") for i, c in enumerate(columns)]
    found = cells.agg(*misfits, *filled).first()
    return {
        c: next(of for of in LATTICE if not found[f"{i} {of}"]) if found[f"{i} filled"] else "string"
        for i, c in enumerate(columns)
    }


def as_types(cells: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Text columns cast to ``types``; other columns stay."""
    special = {"Inf": "Infinity", "+Inf": "Infinity", "-Inf": "-Infinity"}

    def value(column: str) -> Column:
        cell = F.col(f"`{column}`")
        if types.get(column, "string") == "double":
            cell = reduce(lambda c, s: F.when(cell == s, special[s]).otherwise(c), special, cell)
        return cell.cast(types[column]).alias(column) if column in types else cell

    return cells.select(*(value(c) for c in cells.columns))


def read_inferred(
    spark: SparkSession, path: str, required: Sequence[str] = (), **options
) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)`` of a delimited file with a header, with whatever columns it has.

    Column types are those that all accepted cells have. Rejects, with the raw record, have a
    cell too many or too few, or an empty ``required`` column. A column that is required and
    not there is an error.
    """
    names = spark.read.csv(path, header=True, **options).columns
    missing = [c for c in required if c not in names]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    schema = ", ".join(f"`{n}` string" for n in names)
    full = spark.read.csv(
        path,
        schema=f"{schema}, {RAW} string",
        header=True,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=RAW,
        **options,
    )
    complete = is_complete(full, required)
    rows = full.where(complete).drop(RAW)
    return as_types(rows, inferred_types(rows, names)), full.where(~complete)
