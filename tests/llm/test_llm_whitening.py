from __future__ import annotations

import math
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from linetone.llm import whitening as module
from linetone.llm.bidiagonal import dqds, principal_directions
from linetone.llm.whitening import digest, fit, fixed_point, whiten

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows):
    """By exact sums and a dense eigensolver over the distinct vectors."""
    sound = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dims = max((len(v) for _, v in sound), default=0)
    x = {k: tuple(math.floor(256 * Fraction(c)) for c in v) + (0,) * (dims - len(v)) for k, (_, v) in enumerate(sound)}
    distinct = sorted(set(x.values()))
    n, sums = len(distinct), [sum(c) for c in zip(*distinct, strict=True)]
    centre = lambda row: [float(Fraction(c) - Fraction(s, n)) for c, s in zip(row, sums, strict=True)]
    centred = np.array([centre(row) for row in distinct])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1].T
    deviation = [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x.values()]
    return [i for i, _ in sound], n, deviation, values, vectors, np.array([centre(r) for r in x.values()])


def assert_equal_to_brute(spark, rows, components=4):
    ids, n, deviation, values, vectors, centred = brute(rows)
    found = digest(spark.createDataFrame(rows, SCHEMA).repartition(3), components).collect()
    k = min(components, len(values))
    assert len(found) == k * len(ids)
    mine = Counter((r["vec_id"], r["deviation"]) for r in found if r["component"] == 1)
    assert mine == Counter(zip(ids, deviation, strict=True))
    for c in range(k):
        mine = {(r["vec_id"], r["deviation"]): r for r in found if r["component"] == c + 1}
        want = centred @ vectors[c] / math.sqrt(values[c])
        got = np.array([mine[key]["whitened"] for key in zip(ids, deviation, strict=True)])
        assert np.allclose(got * np.sign(got @ want), want, atol=1e-9)
        assert all(r["n"] == n and r["identity_error"] < 1e-9 for r in mine.values())
        assert all(abs(r["explained"] / (values[c] / values.sum()) - 1) < 1e-9 for r in mine.values())


def vectors(seed, count, dims, scales=1.0, far=0.0):
    return (np.random.default_rng(seed).standard_normal((count, dims)) * scales + far).tolist()


@pytest.mark.parametrize("dims, scales, far", [(6, 1.0, 0.0), (2, 1.0, 0.0), (5, [1, 1e3, 1e-1, 30, 7], 1e9)])
def test_equal_to_a_dense_solver(spark, dims, scales, far):
    rows = list(enumerate(vectors(dims, 60, dims, scales, far)))
    assert_equal_to_brute(spark, rows + [(100 + i, v) for i, v in rows[:5]])


def test_many_triangles(spark, monkeypatch):
    monkeypatch.setattr(module, "FAN", 2)
    monkeypatch.setattr(module, "BLOCK", 4)
    assert_equal_to_brute(spark, list(enumerate(vectors(1, 90, 7))), components=7)


def test_unsound_and_short_vectors(spark):
    rows = list(enumerate(vectors(2, 30, 4)))
    rows += [(50, None), (51, [1.0, None, 0.0, 0.0]), (52, [math.nan] * 4), (53, [math.inf, 0.0, 0.0, 0.0])]
    rows += [(54, [0.5, 0.25]), (55, [0.5, 0.25, 0.0, 0.0]), (56, []), (57, [-0.0] * 4), (None, [1.0, -1.0, 2.0, 0.5])]
    rows += [rows[3], rows[3]]
    assert_equal_to_brute(spark, rows)


def test_degenerate_tables(spark):
    empty = digest(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns[:3] == ["vec_id", "component", "n"]
    one = digest(spark.createDataFrame([(1, [1.0, 2.0, 3.0])], SCHEMA)).collect()
    assert [(r["component"], r["whitened"], r["explained"], r["deviation"]) for r in one] == [
        (c, None, None, 0) for c in (1, 2, 3)
    ]
    flat = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(5)], SCHEMA)
    found = {(r["vec_id"], r["component"]): r for r in digest(flat).collect()}
    assert found[0, 1]["explained"] == pytest.approx(1) and found[0, 2]["explained"] == 0
    assert found[0, 2]["whitened"] is None and abs(found[4, 1]["whitened"]) == pytest.approx(math.sqrt(2))
    assert found[1, 1]["identity_error"] < 1e-12


def test_equal_variances(spark):
    """Any basis of the plane will do, as long as it whitens."""
    rows = [(i, [a, b, 0.0]) for i, (a, b) in enumerate([(1.0, 0.0), (-1.0, 0.0), (0.0, 1.0), (0.0, -1.0)])]
    found = digest(spark.createDataFrame(rows, SCHEMA)).where("component < 3").toPandas()
    w = found.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.allclose(w.T @ w / 4, np.eye(2)) and np.allclose(found["explained"], 0.5)


def test_huge_entries(spark):
    rows = [(0, [1e300, 1.0]), (1, [-1e300, 2.0]), (2, [3.0, 4.0]), (3, [5.0, 7.0])]
    found = digest(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 8 and {r["vec_id"] for r in found if r["deviation"] is None} == {0, 1}
    assert all(math.isfinite(r["whitened"]) for r in found if r["component"] == 1)


def test_other_columns_stay(spark):
    rows = spark.createDataFrame(
        [(i, v, "w", i) for i, v in enumerate(vectors(3, 9, 3))],
        "deviation long, embedding array<double>, whitened string, _x int",
    )
    model, _ = fit(rows.select(fixed_point("embedding").alias("x")), components=2)
    found = whiten(rows, "embedding", model)
    assert found.columns == ["embedding", "_x", "whitened", "deviation"] and found.count() == 9
    assert {len(r["whitened"]) for r in found.collect()} == {2}


@pytest.mark.parametrize("gap", [0.0, 1e-15, 1e-9, 1e-4, 1.0])
def test_directions_of_close_values(gap):
    turn = lambda seed: np.linalg.qr(np.random.default_rng(seed).standard_normal((12, 12)))[0]
    matrix = turn(1) @ np.diag([1 + gap * i for i in range(12)]) @ turn(2)
    values, directions = principal_directions(np.linalg.qr(matrix, mode="r"), 12)
    assert np.allclose(values, np.linalg.svd(matrix, compute_uv=False) ** 2, rtol=1e-13)
    assert np.allclose(directions @ directions.T, np.eye(12), atol=1e-11)
    assert np.allclose(matrix.T @ matrix @ directions.T, directions.T * values, atol=1e-12 * values[0])


def test_small_values_are_as_accurate_as_large_ones():
    a, b = np.logspace(0, -140, 8), np.logspace(0, -140, 8)[:-1] * 1e-3
    exact = np.array([float(x) for x in _exact_values(a, b)])
    assert np.allclose(dqds(a * a, b * b), exact, rtol=1e-12)


def _exact_values(a, b):
    """Far apart as they are, two steps of the transformation in exact numbers are enough."""
    q, e = [Fraction(x) ** 2 for x in a], [Fraction(x) ** 2 for x in b]
    for _ in range(6):
        d = q[0]
        for i in range(len(e)):
            head = d + e[i]
            q[i], e[i], d = head, e[i] * q[i + 1] / head, d * q[i + 1] / head
        q[-1] = d
    return sorted(q, reverse=True)
