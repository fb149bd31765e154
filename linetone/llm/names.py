"""Columns of any name beside an operator's own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns ``c0``, ``c1`` …, which no operator uses, and these by their old names."""
    names = {c: f"c{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def restored(names: dict[str, str], but: tuple[str, ...] = ()) -> list[Column]:
    """The old columns under their old names, without those named in ``but``."""
    return [F.col(new).alias(old) for old, new in names.items() if old not in but]
