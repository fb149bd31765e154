"""Quality scores by positive-unlabelled learning: non-negative unbiased risk over features of a text."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from operator import eq
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from linetone.llm.names import numbered, restored
from linetone.session import stage

FEATURES = (
    "words",
    "word_length",
    "distinct",
    "richness",
    "repeats",
    "top_word",
    "lines",
    "line_words",
    "distinct_lines",
    "short_lines",
    "capitals",
    "capital_words",
    "letters",
    "digits",
    "spaces",
    "punctuation",
    "ends",
    "exclaims",
    "symbols",
    "top_symbol",
    "beyond_ascii",
    "packed",
)

# A line of fewer characters is short.
SHORT_LINE = 25

# Ranks at which a feature's range is cut into steps, each of which gets a weight.
RANKS = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)

# Weight of the squared weights in the risk, times the root of the number of positives: as the
# sampling error of the risk's slope does, it fades with more of them.
RIDGE = 1.0

# Newton steps at most and what ends them; halvings in the search of the multiplier.
STEPS, TOLERANCE, HALVINGS = 25, 1e-5, 5

# Cells of the histogram of scores for the prior, the odds that its bound may fail, and how much
# of what sampling leaves open is taken off.
CELLS, DOUBT, SLACK, CAUTION = 1000, 0.1, 0.01, 0.1

PREDICTED = 0.7

_SYMBOLS = np.frombuffer(rb"#$%&*+/<=>@[\]^_`{|}~", np.uint8)
_PUNCTUATION = np.frombuffer(b".,;:!?'\"()-", np.uint8)


def features(text: str | None) -> list[float]:
    """The values of ``FEATURES``, from the whole text; one without words has zeros."""
    words = (text or "").split()
    if not words:
        return [0.0] * len(FEATURES)
    raw = text.encode("utf-8", "surrogatepass")
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n, size = len(words), len(raw)
    counted = Counter(words)
    lines = text.split("\n")
    upper, lower = int(seen[65:91].sum()), int(seen[97:123].sum())
    beyond = int(seen[128:].sum())
    symbols = seen[_SYMBOLS]
    return [
        math.log1p(n),
        size / n,
        len(counted) / n,
        math.log1p(len(counted)) / math.log1p(n),
        sum(map(eq, words, words[1:])) / n,
        max(counted.values()) / n,
        math.log1p(len(lines)),
        n / len(lines),
        len(set(lines)) / len(lines),
        sum(len(line) < SHORT_LINE for line in lines) / len(lines),
        upper / max(1, upper + lower),
        sum(w[0].isupper() for w in words) / n,
        (upper + lower + beyond) / size,
        int(seen[48:58].sum()) / size,
        int(seen[9:14].sum() + seen[32]) / size,
        int(seen[_PUNCTUATION].sum()) / n,
        int(seen[33] + seen[46] + seen[63]) / n,
        int(seen[33]) / n,
        int(symbols.sum()) / n,
        int(symbols.max()) / n,
        beyond / size,
        len(zlib.compress(raw, 1)) / size,
    ]


class Model(NamedTuple):
    """Cuts of each feature, a weight per step of each, the constant, and the estimated prior."""

    cuts: list[list[float]]
    weights: np.ndarray
    prior: float


def described(documents: DataFrame, column: str = "features") -> DataFrame:
    """``documents`` with the features of ``text`` in place of it."""

    @F.pandas_udf("array<float>")
    def values(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([np.array(features(t), np.float32) for t in texts])

    others = [c for c in documents.columns if c not in ("text", column)]
    return documents.select(*others, values("text").alias(column))


def _cuts(rows: DataFrame) -> list[list[float]]:
    """Distinct values at ``RANKS`` of each feature, over all rows."""
    ranks = F.array(*map(F.lit, RANKS))
    found = rows.agg(
        *(F.percentile_approx(F.get("features", i), ranks, 2000).alias(f) for i, f in enumerate(FEATURES))
    ).first()
    return [sorted(set(found[f] or [])) for f in FEATURES]


def _steps(values: np.ndarray, cuts: list[list[float]]) -> np.ndarray:
    """The step of each value among all features' steps: how many cuts lie below it, and an offset."""
    found = np.empty(values.shape, np.int16)
    offset = 0
    for i, of in enumerate(cuts):
        found[:, i] = offset + np.searchsorted(np.array(of, np.float32), values[:, i], side="left")
        offset += len(of) + 1
    return found


def _floats(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _indicators(steps: np.ndarray, size: int) -> np.ndarray:
    """A row of ones at a row's steps, and at the end for the constant."""
    found = np.zeros((len(steps), size))
    found[np.arange(len(steps))[:, None], steps] = 1.0
    found[:, -1] = 1.0
    return found


class _Rows:
    """Learned rows as steps, with the risks' sums over all of them, made by tasks."""

    def __init__(self, rows: DataFrame, cuts: list[list[float]]) -> None:
        self.size = sum(len(c) + 1 for c in cuts) + 1

        def stepped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                steps = _steps(_floats(batch.column("features")), cuts)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(steps) + 1) * len(cuts), pa.int32()), pa.array(steps.ravel())
                )
                yield pa.RecordBatch.from_arrays(
                    [lists, batch.column("positive"), batch.column("half")], ["steps", "positive", "half"]
                )

        schema = "steps array<short>, positive int, half int"
        self.table = stage(rows.select("features", "positive", "half").mapInArrow(stepped, schema), "steps")

    def sums(self, weights: np.ndarray, half: int | None) -> dict[str, np.ndarray]:
        """For unlabelled (all) and positive rows: number, loss either way, gradients and curvature."""
        size = self.size
        upper = np.triu_indices(size)
        length = 3 + 2 * size + len(upper[0])

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((2, length))
            for batch in batches:
                positive = batch.column("positive").to_numpy(zero_copy_only=False) == 1
                steps = _floats(batch.column("steps"))
                for at in range(0, len(steps), 2048):
                    x = _indicators(steps[at : at + 2048], size)
                    for kind, chosen in enumerate((slice(None), positive[at : at + 2048])):
                        rows = x[chosen]
                        margin = rows @ weights
                        p = 0.5 * (1.0 + np.tanh(margin / 2))
                        total[kind] += np.concatenate(
                            [
                                [len(rows), np.logaddexp(0, -margin).sum(), np.logaddexp(0, margin).sum()],
                                p @ rows,
                                rows.sum(axis=0),
                                (rows.T @ (rows * (p * (1 - p))[:, None]))[upper],
                            ]
                        )
            yield pa.RecordBatch.from_arrays(
                [pa.array([0, 1], pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["kind", "total"]
            )

        rows = self.table if half is None else self.table.where(F.col("half") == half)
        found = rows.select("steps", "positive").mapInArrow(partial, "kind int, total array<double>")
        places = found.select("kind", F.posexplode("total").alias("place", "value"))
        added = places.groupBy("kind", "place").agg(F.sum("value").alias("value")).toArrow()
        kinds, at, values = (added.column(c).to_numpy() for c in ("kind", "place", "value"))
        sums = np.zeros((2, length))
        sums[kinds, at] = values
        named = {}
        for kind, name in enumerate(("unlabelled", "positive")):
            count = max(1.0, sums[kind, 0])
            mean = sums[kind, 1:] / count
            curve = np.zeros((size, size))
            curve[upper] = mean[2 + 2 * size :]
            named[name] = {
                "n": sums[kind, 0],
                "as_positive": mean[0],
                "as_negative": mean[1],
                "p": mean[2 : 2 + size],
                "x": mean[2 + size : 2 + 2 * size],
                "curve": curve + np.triu(curve, 1).T,
            }
        return named

    def minimise(
        self, weights: np.ndarray, plus: float, minus: float, unlabelled: float, half: int | None = None
    ) -> tuple[np.ndarray, dict]:
        """Newton's minimum of ``plus * E_p[l(g)] - minus * E_p[l(-g)] + unlabelled * E_u[l(-g)]``
        with the ridge, ``l`` the logistic loss and ``plus >= minus``, which keeps it convex."""
        best, now, ridge = math.inf, weights, np.ones(self.size)
        ridge[-1] = 0.0
        last, sums = weights, {}
        for _ in range(STEPS):
            found = self.sums(now, half)
            p, u = found["positive"], found["unlabelled"]
            held = RIDGE / math.sqrt(max(1.0, p["n"]))
            risk = plus * p["as_positive"] - minus * p["as_negative"] + unlabelled * u["as_negative"]
            risk += held / 2 * float((ridge * now * now).sum())
            if risk > best + 1e-12:
                now = (last + now) / 2  # a step too long
                if np.abs(now - last).max() < TOLERANCE:
                    break
                continue
            done = best - risk < TOLERANCE
            best, last, sums = risk, now, found
            if done:
                break
            gradient = plus * (p["p"] - p["x"]) - minus * p["p"] + unlabelled * u["p"] + held * ridge * now
            curve = (plus - minus) * p["curve"] + unlabelled * u["curve"] + np.diag(held * ridge + 1e-9)
            now = now - np.linalg.solve(curve, gradient)
        return last, sums

    def histogram(self, weights: np.ndarray, half: int) -> np.ndarray:
        """Scores of unlabelled and positive rows, counted in ``CELLS`` cells."""

        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((2, CELLS), np.int64)
            for batch in batches:
                positive = batch.column("positive").to_numpy(zero_copy_only=False) == 1
                steps = _floats(batch.column("steps"))
                score = 0.5 * (1.0 + np.tanh((weights[steps].sum(axis=1) + weights[-1]) / 2))
                cell = np.minimum((score * CELLS).astype(int), CELLS - 1)
                total += np.array([np.bincount(c, minlength=CELLS) for c in (cell, cell[positive])])
            places = pa.array(np.arange(total.size), pa.int32())
            yield pa.RecordBatch.from_arrays([places, pa.array(total.ravel())], ["place", "n"])

        found = self.table.where(F.col("half") == half).select("steps", "positive")
        found = found.mapInArrow(counted, "place int, n long").groupBy("place").agg(F.sum("n").alias("n"))
        total = np.zeros(2 * CELLS)
        for row in found.collect():
            total[row["place"]] = row["n"]
        return total.reshape(2, CELLS)


def estimated_prior(counts: np.ndarray) -> float:
    """Share of positives among unlabelled rows, from both's histograms of a score.

    Above a score that few negatives reach, the shares of unlabelled and of positive rows differ
    by that factor. Of all scores the one with the least upper bound counts (best-bin estimate).
    """
    unlabelled, positive = (np.cumsum(c[::-1]) for c in counts)
    if not unlabelled[-1] or not positive[-1]:
        return 0.0
    above_u, above_p = unlabelled / unlabelled[-1], positive / positive[-1]
    reach = above_p > 0
    doubt = sum(math.sqrt(math.log(4 / DOUBT) / 2 / n) for n in (unlabelled[-1], positive[-1]))
    bound = (above_u[reach] + (1 + SLACK) * doubt) / above_p[reach]
    at = int(np.argmin(bound))
    return float(min(0.999, max(0.001, (above_u[reach][at] - CAUTION * doubt) / above_p[reach][at])))


def _excess(sums: dict, prior: float) -> float:
    """The negative rows' part of the risk, which must not be negative."""
    return sums["unlabelled"]["as_negative"] - prior * sums["positive"]["as_negative"]


def fit(rows: DataFrame, labels: DataFrame) -> Model:
    """Learn from ``rows`` (``doc_id``, ``features``), all of them, and ``labels`` (``doc_id``, ``label``).

    Trusted positives are rows whose id has label 1 and no other; all rows are the unlabelled
    ones. The prior is estimated on one half (by hash of the id) from a classifier of positive
    against unlabelled rows of the other. The non-negative risk ``prior * E_p[l(g)] +
    max(0, E_u[l(-g)] - prior * E_p[l(-g)])`` is convex with the logistic loss: the largest, over
    a multiplier from 0 to 1 of the second part, of convex functions. With the multiplier 1 its
    minimum is the unbiased risk's; if the second part is negative there, the multiplier at which
    it is zero is searched. Each Newton step is one aggregate over all rows.

    Null labels and ids don't count. Without positives every score is 0.
    """
    trusted = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.min("label").alias("_low"), F.max("label").alias("_high")
    )
    trusted = trusted.where("_low = 1 and _high = 1").select(F.col("doc_id").alias("_id"))
    positive = F.col("_id").isNotNull().cast("int")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int")
    marked = rows.join(trusted, F.col("doc_id") == F.col("_id"), "left")
    marked = marked.select("features", positive.alias("positive"), half.alias("half"))
    cuts = _cuts(rows)
    table = _Rows(marked, cuts)
    start = np.zeros(table.size)
    apart, sums = table.minimise(start, 1.0, 0.0, 1.0, half=0)
    if not sums or not sums["positive"]["n"]:
        apart, sums = table.minimise(start, 1.0, 0.0, 1.0)
        if not sums or not sums["positive"]["n"]:
            return Model(cuts, start, 0.0)
    prior = estimated_prior(table.histogram(apart, half=1))
    prior = prior or estimated_prior(table.histogram(apart, half=0))
    weights, sums = table.minimise(start, prior, prior, 1.0)
    if _excess(sums, prior) < 0.0:
        low, high = 0.0, 1.0
        for _ in range(HALVINGS):
            multiplier = (low + high) / 2
            weights, sums = table.minimise(weights, prior, multiplier * prior, multiplier)
            low, high = (low, multiplier) if _excess(sums, prior) < 0.0 else (multiplier, high)
    return Model(cuts, weights, prior)


def score(rows: DataFrame, model: Model, column: str = "features") -> DataFrame:
    """``rows``, less ``column``, with ``score`` (0 to 1) and ``predicted`` (1 from ``PREDICTED``).

    Existing columns of these names are replaced. An empty table gives no rows.
    """

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            if model.prior == 0.0 or not len(batch):
                yield pd.Series(np.zeros(len(batch)))
                continue
            steps = _steps(np.vstack(batch.to_numpy()), model.cuts)
            margin = model.weights[steps].sum(axis=1) + model.weights[-1]
            yield pd.Series(0.5 * (1.0 + np.tanh(margin / 2)))

    known, names = numbered(rows)
    found = known.select(*restored(names, ("score", "predicted", column)), scored(names[column]).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= PREDICTED).cast("int"))


def held_out(doc_id: str = "doc_id") -> Column:
    """A quarter of the ids, by CRC-32; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))
