"""Whitening of embeddings: blockwise QR of the centred rows, singular values by dqds, directions
by twisted factorisations."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from linetone.llm.bidiagonal import principal_directions
from linetone.llm.names import numbered, restored
from linetone.session import stage

# Steps to a unit in fixed-point vectors, and directions kept.
SCALE = 256
COMPONENTS = 4

# Rows in a block of a factorisation, and triangles that one task puts together.
BLOCK = 4096
FAN = 32

_LONG = 1 << 63


class Whitening(NamedTuple):
    """A fit: ``n`` distinct vectors, their ``sums`` and, for the first directions, variance and unit vector."""

    n: int
    sums: list[int]
    variances: list[float]
    directions: np.ndarray
    trace: float


def fixed_point(vector: str, scale: int = SCALE) -> Column:
    """``floor(scale * c)`` of each entry, as longs (beyond their range: the nearest), without the
    zeros at the end. Null if the vector is null or an entry is null, NaN or infinite."""
    entries = F.col(vector).cast("array<double>")
    infinite = F.lit(float("inf"))
    sound = ~F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == infinite))
    steps = F.transform(entries, lambda c: F.floor(c * scale).cast("long"))
    last = F.array_position(F.transform(F.reverse(steps), lambda x: x != 0), True)
    length = F.when(last == 0, 0).otherwise(F.size(steps) - last + 1).cast("int")
    return F.when(entries.isNotNull() & sound, F.slice(steps, F.lit(1), length))


def _matrix(lists: pa.Array, dims: int) -> np.ndarray:
    """Fixed-point vectors as rows, shorter ones ending in zeros."""
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    values = lists.flatten().to_numpy(zero_copy_only=False)
    found = np.zeros((len(lengths), dims), np.int64)
    found[np.arange(dims) < lengths[:, None]] = values
    return found


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``x - sums / n``: whole parts are subtracted exactly, so a far mean costs no digits."""
    whole = [s // n for s in sums]
    if max((abs(w) for w in whole), default=0) >= _LONG // 2 or np.any(np.abs(x // 2) >= _LONG // 4):
        differences = np.array(x.astype(object) - np.array(whole, object), float).reshape(x.shape)
    else:
        differences = (x - np.array(whole, np.int64)).astype(float)
    return differences - np.array([(s - w * n) / n for s, w in zip(sums, whole, strict=True)])


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The exact sum of ``(n * x - sums) ** 2`` of each row; none beyond a long's range."""
    bound = (max((abs(s) for s in sums), default=0) + n * float(np.abs(x.astype(float)).max(initial=0))) ** 2
    if bound * max(1, x.shape[1]) < _LONG / 4:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    exact = [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x.tolist()]
    return [value if value < _LONG else None for value in exact]


def _sums(points: DataFrame, dims: int) -> list[int]:
    """Exact sums of the entries at each place, whatever their size.

    Tasks add the upper and the lower half of each long, which cannot overflow.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper, lower = np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for batch in batches:
            x = _matrix(batch.column("x"), dims)
            upper += (x >> 32).sum(axis=0)
            lower += (x & 0xFFFFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dims), pa.int32()), pa.array(upper), pa.array(lower)],
            ["place", "upper", "lower"],
        )

    halves = points.select("x").mapInArrow(partial, "place int, upper long, lower long")
    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("upper", "lower")]
    found = {r["place"]: (int(r["upper"]) << 32) + int(r["lower"]) for r in halves.groupBy("place").agg(*wide).collect()}
    return [found.get(i, 0) for i in range(dims)]


def _reduced(blocks: Iterable[np.ndarray], dims: int) -> np.ndarray:
    """The triangle ``R`` of all rows of ``blocks``, holding one block and one triangle at a time."""
    triangle = np.zeros((0, dims))
    for block in blocks:
        for at in range(0, len(block), BLOCK):
            triangle = np.linalg.qr(np.vstack([triangle, block[at : at + BLOCK]]), mode="r")
    return triangle


def _triangle(points: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """``R`` of the centred rows: one triangle a task, then triangles of ``FAN`` triangles, and so on."""
    dims = len(sums)
    schema = "part int, rows int, r array<double>"

    def record(part: int, triangle: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([part], pa.int32()),
                pa.array([len(triangle)], pa.int32()),
                pa.array([triangle.ravel()], pa.list_(pa.float64())),
            ],
            ["part", "rows", "r"],
        )

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        blocks = (_centred(_matrix(b.column("x"), dims), n, sums) for b in batches)
        yield record(TaskContext.get().partitionId(), _reduced(blocks, dims))

    def merge(batches: pa.Table) -> pa.Table:
        triangles = (np.array(r["r"], float).reshape(-1, dims) for r in batches.to_pylist())
        part = batches.column("part")[0].as_py() // FAN
        return pa.Table.from_batches([record(part, _reduced(triangles, dims))])

    found = stage(points.select("x").mapInArrow(first, schema), "triangles")
    while found.agg(F.max("part")).first()[0] > 0:
        found = stage(found.groupBy((F.col("part") / FAN).cast("int")).applyInArrow(merge, schema), "triangles")
    row = found.first()
    square = np.zeros((dims, dims))
    square[: row["rows"]] = np.array(row["r"], float).reshape(-1, dims)
    return square


def fit(vectors: DataFrame, components: int = COMPONENTS) -> tuple[Whitening, DataFrame]:
    """The whitening of the distinct vectors in column ``x`` (see ``fixed_point``), and these.

    Nulls don't count. The dimension is the longest vector's, or the largest ``dims`` where
    there is a column of that name; its square is what a task, and the driver, hold. Without
    vectors ``n`` is 0 and there are no directions. Directions without variance have variance 0.
    """
    dims = F.col("dims") if "dims" in vectors.columns else F.size("x")
    known = vectors.where("x is not null").select("x", dims.cast("int").alias("dims"))
    points = stage(known.groupBy("x").agg(F.max("dims").alias("dims")), "points")
    totals = points.agg(F.count("*"), F.max("dims")).first()
    n, dims = totals[0], totals[1] or 0
    if n == 0 or dims == 0:
        return Whitening(n, [], [], np.zeros((0, 0)), 0.0), points
    sums = _sums(points, dims)
    squares, directions = principal_directions(_triangle(points, n, sums), min(components, dims))
    variances = [float(v) / n for v in squares[: len(directions)]]
    return Whitening(n, sums, variances, directions, float(squares.sum()) / n), points


def _whitened(x: np.ndarray, model: Whitening) -> np.ndarray:
    """Rows by directions; NaN where a direction has no variance."""
    deviation = np.sqrt(np.array(model.variances))
    with np.errstate(divide="ignore", invalid="ignore"):
        found = _centred(x, model.n, model.sums) @ model.directions.T / deviation
    found[:, deviation == 0.0] = np.nan
    return found


def identity_error(points: DataFrame, model: Whitening) -> float | None:
    """Largest entry of the whitened points' covariance minus the identity, over directions with
    variance; none without such."""
    kept = [i for i, v in enumerate(model.variances) if v > 0.0]
    if not kept:
        return None
    dims, k = len(model.sums), len(kept)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            w = _whitened(_matrix(batch.column("x"), dims), model)[:, kept]
            total += np.vstack([w.sum(axis=0), w.T @ w])
        places = pa.array(np.arange(total.size), pa.int32())
        yield pa.RecordBatch.from_arrays([places, pa.array(total.ravel())], ["place", "total"])

    found = points.select("x").mapInArrow(moments, "place int, total double")
    total = np.zeros((k + 1) * k)
    for row in found.groupBy("place").agg(F.sum("total").alias("total")).collect():
        total[row["place"]] = row["total"] / model.n
    total = total.reshape(k + 1, k)
    covariance = total[1:] - np.outer(total[0], total[0])
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(rows: DataFrame, vector: str, model: Whitening, scale: int = SCALE) -> DataFrame:
    """``rows`` with ``whitened``, an array of a value for each direction, and ``deviation``.

    ``deviation`` is the exact sum of ``(n * x - sums) ** 2``, null beyond a long's range. Rows
    whose vector is null or unsound are left out; shorter vectors count as ending in zeros,
    longer ones than the fit's have no place in it and are cut. Values along a direction
    without variance are null. Columns of these names are replaced.
    """
    dims = len(model.sums)

    @F.pandas_udf("whitened array<double>, deviation long")
    def values(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for vectors in batches:
            x = _matrix(pa.array(vectors, pa.list_(pa.int64())), dims)
            found = _whitened(x, model).astype(object)
            found[found != found] = None
            deviations = _deviations(x, model.n, model.sums) if model.n else [0] * len(x)
            yield pd.DataFrame(
                {"whitened": list(found), "deviation": pd.array(deviations, dtype="Int64")}
            )

    known, names = numbered(rows)
    known = known.withColumn("_x", fixed_point(names[vector], scale)).where("_x is not null")
    known = known.withColumn("_v", values(F.slice("_x", 1, dims) if dims else F.slice("_x", 1, 0)))
    return known.select(
        *restored(names, ("whitened", "deviation")),
        F.col("_v.whitened").alias("whitened"),
        F.col("_v.deviation").alias("deviation"),
    )


def digest(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per sound embedding (``vec_id``, ``embedding``) and component, numbered from 1.

    Besides the whitened value: ``n``, ``deviation``, the component's share of the variance as
    ``explained`` and the fit's ``identity_error``. There are as many components as the vectors
    have dimensions, at most ``components``; one without variance has null for ``whitened``,
    and for ``explained`` if there is no variance at all. Repeated rows each give their rows.
    """
    rows = embeddings.select("vec_id", "embedding")
    vectors = rows.select(fixed_point("embedding").alias("x"), F.size("embedding").alias("dims"))
    model, points = fit(vectors, components)
    share = [v / model.trace if model.trace else None for v in model.variances]
    shares = F.lit(None) if not share else F.array(*map(F.lit, share))
    parts = whiten(rows, "embedding", model).select(
        "vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")
    )
    return parts.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        (F.get(shares, F.col("place")) if share else F.lit(None)).cast("double").alias("explained"),
        F.lit(identity_error(points, model)).cast("double").alias("identity_error"),
    )
