"""Toxicity scores: boosted trees over dense features of a text, calibrated by isotonic regression."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, functions as F

from linetone.llm.names import numbered, restored
from linetone.session import stage

# Labelled rows that are learned from, the first by hash; two fifths for the lexicon, two
# for the trees, one for the calibration.
SAMPLE = 30_000
SHARES = (0.4, 0.8)

# Terms of the learned lexicon, and what qualifies one: rows it occurs in, and how much
# likelier it is in toxic rows, as a logarithm.
TERMS = 4_000
LEAST_ROWS = 3
LEAST_WEIGHT = 1.5

STEMS = (4, 5)

TREES = 24
DEPTH = 4

# Words that insult in English, and second-person words of four languages.
INSULTS = (
    "idiot moron stupid dumb loser pathetic worthless disgusting scum trash garbage clown fool "
    "imbecile jerk creep freak filthy vile hate"
).split()
SECOND_PERSON = (
    "you your yours yourself ya u du dich dir dein deine ihr euch euer tu te toi ton ta tes vous "
    "votre vos usted ustedes tú ti tuyo vosotros os vuestro"
).split()
INSULT_WEIGHT = 2.0

_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_MASKED = re.compile(r"\b[^\W\d_]+[0-9@$!*#%+]+[^\W\d_]+\b")
_SPELLED = re.compile(r"\b(?:[^\W\d_][ .\-_*]){3,}[^\W\d_]\b")
_PLAIN = str.maketrans("013457@$!", "oieastasi")

FEATURES = (
    "words",
    "density",
    "peak",
    "hits",
    "stem_density",
    "stem_peak",
    "stem_hits",
    "insults",
    "toward_you",
    "you",
    "capitals",
    "marks",
    "punctuation",
    "masked",
    "masked_hits",
)


class Lexicon(NamedTuple):
    words: Mapping[str, float]
    stems: Mapping[str, float]


def terms(text: str | None) -> set[str]:
    """Distinct words (``w:``) and their opening characters (``s:``) of a text."""
    words = set(_WORD.findall((text or "").lower()))
    return {f"w:{w}" for w in words} | {f"s:{w[:n]}" for w in words for n in STEMS if len(w) >= n}


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """The values of ``FEATURES``; an empty text has zeros."""
    text = text or ""
    words = _WORD.findall(text.lower())
    if not words:
        return [0.0] * len(FEATURES)
    n = len(words)
    weights, at = [], []
    for i, word in enumerate(words):
        if weight := lexicon.words.get(word, 0.0):
            weights.append(weight)
            at.append(i)
    stems = []
    for word in words:
        weight = max(lexicon.stems.get(word[:k], 0.0) if len(word) >= k else 0.0 for k in STEMS)
        if weight:
            stems.append(weight)
    you = np.array([i for i, word in enumerate(words) if word in _SECOND], np.int64)
    toward = 0.0
    if len(you) and at:
        places = np.array(at)
        right = np.searchsorted(you, places)
        gaps = np.minimum(
            np.abs(you[np.minimum(right, len(you) - 1)] - places),
            np.abs(you[np.maximum(right - 1, 0)] - places),
        )
        toward = float((np.array(weights) * np.exp(-gaps / 4.0)).sum())
    counts = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    size = len(text)
    masked = _MASKED.findall(text) + _SPELLED.findall(text)
    unmasked = [re.sub(r"[^a-z]", "", m.lower().translate(_PLAIN)) for m in masked]
    return [
        math.log1p(n),
        100 * sum(weights) / n,
        max(weights, default=0.0),
        math.log1p(len(weights)),
        100 * sum(stems) / n,
        max(stems, default=0.0),
        math.log1p(len(stems)),
        math.log1p(sum(word in _INSULTS for word in words)),
        100 * toward / n,
        100 * len(you) / n,
        float(counts[65:91].sum()) / size,
        float(counts[33] + counts[63]) / size,
        float(counts[33:48].sum() + counts[58:65].sum()) / size,
        100 * len(masked) / n,
        float(sum(lexicon.words.get(m, 0.0) > 0 for m in unmasked)),
    ]


_SECOND, _INSULTS = frozenset(SECOND_PERSON), frozenset(INSULTS)


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """Words and stems that toxic rows have far more often than others.

    ``rows``: ``text``, ``label``. Terms are counted by rows in Spark; the ``TERMS`` with the
    clearest difference come back, a bounded list.
    """

    @F.pandas_udf("array<string>")
    def distinct_terms(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: sorted(terms(t)))

    totals = rows.agg(F.sum("label").alias("toxic"), F.count("*").alias("all")).first()
    toxic, clean = float(totals["toxic"] or 0), float(totals["all"] - (totals["toxic"] or 0))
    counted = (
        rows.select("label", F.explode_outer(distinct_terms("text")).alias("term"))
        .where("term is not null")
        .groupBy("term")
        .agg(F.sum("label").alias("t"), F.count("*").alias("n"))
        .where((F.col("n") >= LEAST_ROWS) & (F.col("t") > 0))
    )
    weight = F.log((F.col("t") + 0.1) / (toxic + 1)) - F.log((F.col("n") - F.col("t") + 0.5) / (clean + 1))
    expected = F.col("n") * F.lit(toxic / max(1.0, toxic + clean))
    strength = (F.col("t") - expected) / F.sqrt(expected + 1)
    best = (
        counted.select("term", weight.alias("weight"), strength.alias("strength"))
        .where((F.col("weight") >= LEAST_WEIGHT) & (F.col("strength") >= 2))
        .orderBy(F.desc("strength"), "term")
        .limit(TERMS)
        .collect()
    )
    words = {w: INSULT_WEIGHT for w in INSULTS}
    words |= {r["term"][2:]: r["weight"] for r in best if r["term"].startswith("w:")}
    return Lexicon(words, {r["term"][2:]: r["weight"] for r in best if r["term"].startswith("s:")})


def feature_vector(lexicon: Lexicon, text: str = "text") -> Column:
    @F.pandas_udf("array<double>")
    def vector(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([features(t, lexicon) for t in texts])

    return vector(text)


def _assembled(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    rows = rows.withColumn("_f", feature_vector(lexicon))
    values = {f"_{name}": F.get("_f", i) for i, name in enumerate(FEATURES)}
    return VectorAssembler(inputCols=list(values), outputCol="_features").transform(
        rows.withColumns(values)
    ).drop("_f", *values)


class Model(NamedTuple):
    lexicon: Lexicon
    trees: GBTClassificationModel | None
    boundaries: list[float]
    levels: list[float]
    rate: float


def fit(documents: DataFrame, labels: DataFrame) -> Model:
    """Lexicon, trees and calibration from ``documents`` (``doc_id``, ``text``) and ``labels``.

    ``labels`` has ``doc_id`` and ``label`` (0 or 1). At most ``SAMPLE`` labels, those first by
    hash of the id, are learned from; being so few they are sent to the texts, which stay
    where they are. Of rows with one id the least text is learned from, so that repeated rows
    make the sample no larger. Null labels don't count. Without rows of both labels every score is the
    rate of label 1, or 0.
    """
    chosen = labels.where("label is not null and doc_id is not null").select(
        "doc_id", F.col("label").cast("int").alias("label"), F.xxhash64("doc_id").alias("_key")
    )
    chosen = stage(chosen.orderBy("_key", "doc_id", "label").limit(SAMPLE), "chosen")
    share = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(10_000)) / 10_000
    sample = documents.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label")
    sample = sample.agg(F.min("text").alias("text")).select("text", "label", share.alias("_share"))
    sample = stage(sample, "labelled")
    totals = sample.agg(F.avg("label"), F.min("label"), F.max("label")).first()
    rate = float(totals[0] or 0.0)
    lexicon = learn_lexicon(sample.where(F.col("_share") < SHARES[0]))
    if totals[1] == totals[2]:
        return Model(lexicon, None, [], [], rate)
    rest = stage(
        _assembled(sample.where(F.col("_share") >= SHARES[0]), lexicon).drop("text"), "features"
    )
    grown = rest.where(F.col("_share") < SHARES[1])
    if grown.select("label").distinct().count() < 2:
        return Model(lexicon, None, [], [], rate)
    trees = GBTClassifier(
        featuresCol="_features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=7
    ).fit(grown.coalesce(8))
    raw = trees.transform(rest.where(F.col("_share") >= SHARES[1]))
    raw = raw.select("label", vector_to_array("probability")[1].alias("p"))
    steps = IsotonicRegression(featuresCol="p", labelCol="label")
    if raw.select("label").distinct().count() < 2:
        return Model(lexicon, trees, [0.0, 1.0], [0.0, 1.0], rate)
    steps = steps.fit(raw.withColumn("label", F.col("label").cast("double")))
    return Model(lexicon, trees, list(map(float, steps.boundaries)), list(map(float, steps.predictions)), rate)


# Share of the trees' own probability in the score: it orders what the calibration levels.
OWN = 0.02


def score(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` with ``score`` (0 to 1) and ``predicted`` (1 from a score of 0.5).

    Every whole text is scored from its features; null and empty texts have zeros for all.
    Existing columns ``score`` and ``predicted`` are replaced. An empty table gives no rows.
    """
    rows, names = numbered(documents)
    value = F.lit(model.rate)
    if model.trees is not None:
        rows = _assembled(rows.withColumn("text", F.col(names["text"])), model.lexicon)
        p = vector_to_array("probability")[1]
        rows = model.trees.transform(rows).withColumn("_p", p)
        calibrated = _interpolate(F.col("_p"), model.boundaries, model.levels)
        value = (1 - OWN) * calibrated + OWN * F.col("_p")
        value = F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))
    scored = rows.select(*restored(names, ("score", "predicted")), value.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _interpolate(x: Column, boundaries: list[float], levels: list[float]) -> Column:
    """The isotonic steps, straight between their boundaries."""
    value = F.lit(levels[-1])
    points = list(zip(boundaries, levels, strict=True))
    for (a, low), (b, high) in reversed(list(zip(points, points[1:], strict=False))):
        slope = (high - low) / (b - a) if b > a else 0.0
        value = F.when(x < b, F.lit(low) + (x - a) * slope).otherwise(value)
    return F.when(x <= boundaries[0], F.lit(levels[0])).otherwise(value)


def held_out(doc_id: str = "doc_id") -> Column:
    """A fifth of the ids, by CRC-32; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))
