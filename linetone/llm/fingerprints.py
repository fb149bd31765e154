"""Document fingerprints from closed syncmers."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

# A k-mer is an anchor if its smallest inner s-mer stands at one of its ends.
K = 10
S = 4

# Anchors kept: those of smallest hash, which any two texts choose alike.
ANCHORS = 64

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)

# Beyond all code points.
_BEFORE = np.arange(K - 1, dtype=np.uint64) + np.uint64(0x110000)
_AFTER = _BEFORE + np.uint64(K)

# Code points handled at a time; pieces overlap, so the anchors don't depend on it.
PIECE = 1 << 20


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def _mers(points: np.ndarray, length: int, starts: np.ndarray | None = None) -> np.ndarray:
    """Hashes of the ``length`` code points from each start, all starts by default."""
    n = len(points) - length + 1
    h = np.zeros(n if starts is None else len(starts), np.uint64)
    for j in range(length):
        h = h * _BASE + (points[j : j + n] if starts is None else points[starts + j])
    return _mixed(h)


def _anchors(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the closed syncmers."""
    inner = _mers(points, S)
    width = K - S + 1
    low, reach = inner, 1
    while 2 * reach <= width:
        low, reach = np.minimum(low[: len(low) - reach], low[reach:]), 2 * reach
    low = np.minimum(low[: len(low) - (width - reach)], low[width - reach :])
    n = len(low)
    at = np.flatnonzero((inner[:n] == low) | (inner[width - 1 : width - 1 + n] == low))
    return at, _mers(points, K, at)


def fingerprint(text: str) -> str:
    """Hex of the chosen anchors' 32-bit hashes, eight digits each, in the order of the text.

    The first, second … occurrence of an anchor count as different ones, so that a text
    that says little else counts for its length. Marks before and after the text let one
    shorter than a k-mer have some. A text without any is one anchor as a whole; the empty
    text has none.
    """
    if not text:
        return ""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    points = np.concatenate((_BEFORE, points, _AFTER))
    hashes, places = [], []
    for start in range(0, max(1, len(points) - K + 1), PIECE):
        piece = points[start : start + PIECE + K - 1]
        if len(piece) >= K:
            at, h = _anchors(piece)
            hashes.append(h)
            places.append(at + start)
    if not sum(map(len, hashes)):
        whole = _mers(points, len(points))
        return f"{int(whole[0] >> np.uint64(32)):08x}"
    h, at = np.concatenate(hashes), np.concatenate(places)
    order = np.argsort(h, kind="stable")
    new = np.concatenate(([True], h[order][1:] != h[order][:-1]))
    nth = np.empty(len(h), np.uint64)
    nth[order] = np.arange(len(h)) - np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
    h = (_mixed(h + nth * _BASE) >> np.uint64(32)).astype(np.uint32)
    chosen, first = np.unique(h, return_index=True)
    chosen, first = chosen[:ANCHORS], first[:ANCHORS]
    return chosen[np.argsort(at[first], kind="stable")].astype(">u4").tobytes().hex()


def likeness(a: str, b: str) -> float:
    """From 0 to 1, how much of two fingerprints agrees in value and order.

    Both are read as samples of their texts' anchors: only hashes up to the smaller of the
    full samples' limits can be compared. Of those the longest run of common anchors in
    the same order counts, twice, against both sides' number.
    """
    if a == b:
        return 1.0
    x, y = ([s[i : i + 8] for i in range(0, len(s), 8)] for s in (a, b))
    if not x or not y:
        return 0.0
    limit = min(max(s) if len(s) >= ANCHORS else "g" for s in (x, y))
    x, y = ([v for v in s if v <= limit] for s in (x, y))
    place = {v: i for i, v in enumerate(y)}
    tails: list[int] = []
    for i in (place[v] for v in x if v in place):
        at = bisect_left(tails, i)
        tails[at : at + 1] = [i]
    return 2 * len(tails) / (len(x) + len(y)) if x or y else 0.0


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of ``following``."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def _pairs(rows: Iterable[tuple[int, bool, int, str]]) -> Iterator[tuple[int, str, str]]:
    """``doc_id``, ``text``, next text, from rows in order, each bucket closed by the next one's first."""
    held = None
    for bucket, closing, doc_id, text in rows:
        if held is not None and held[0] == bucket:
            yield held[1], held[2], text
        # Of several closing rows, equal ids at the next bucket's start, the first counts.
        held = None if closing else (bucket, doc_id, text)


def _bucket(value: Column, cuts: list[int]) -> Column:
    """How many of the sorted ``cuts`` are below ``value``, by halving."""
    steps = [1 << k for k in reversed(range(len(cuts).bit_length()))]
    bounds = F.lit(np.array(cuts, np.int64))
    return F.aggregate(
        F.lit(np.array(steps, np.int32)),
        F.lit(0),
        lambda found, step: F.when(F.get(bounds, found + step - 1) < value, found + step).otherwise(found),
    )


def fingerprint_documents(documents: DataFrame) -> DataFrame:
    """For every document its fingerprint, that of its edited text, and their likenesses.

    The edited text takes its end from the next document by ``doc_id``, after the last from
    the first; ``near_next`` compares with that document. Ids are cut at quantiles into as
    many buckets as there are shuffle partitions, and each bucket also gets the first
    document of the next: the texts are shuffled once, and no task sees more than a bucket.
    Equal ids are ordered by text. A null id comes first, a null text is empty, a single
    document is its own next. Only ``doc_id`` and ``text`` are used. An empty table gives
    no rows.
    """
    spark = documents.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    null_id = -(1 << 63)
    ids = documents.select(F.coalesce(F.col("doc_id"), F.lit(null_id)).cast("long").alias("id"))
    cuts = ids.agg(F.percentile_approx("id", [i / n for i in range(1, n)] or [0.5], 20 * n)).first()[0]
    bucket = _bucket(F.col("id"), sorted(set(cuts or [])))
    firsts = ids.groupBy(bucket.alias("bucket")).agg(F.min("id").alias("first")).orderBy("bucket")
    firsts = [(r["bucket"], r["first"]) for r in firsts.collect()]  # at most one per bucket
    closes = [(first, before) for (_, first), (before, _) in zip(firsts, firsts[-1:] + firsts, strict=False)]
    closes = F.broadcast(spark.createDataFrame(closes, "first long, closes int"))
    placed = documents.select(
        F.coalesce(F.col("doc_id"), F.lit(null_id)).cast("long").alias("id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    placed = placed.join(closes, F.col("id") == F.col("first"), "left").select(
        "id",
        "text",
        F.explode(
            F.array(
                F.struct(bucket.alias("bucket"), F.lit(False).alias("closing")),
                F.struct(F.col("closes").alias("bucket"), F.lit(True).alias("closing")),
            )
        ).alias("at"),
    )
    placed = placed.where("at.bucket is not null").select("at.bucket", "at.closing", "id", "text")
    placed = placed.repartition(n, "bucket").sortWithinPartitions("bucket", "closing", "id", "text")

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: tuple[str | None, str] = (None, "")

        def of(text: str) -> str:  # a document's own fingerprint serves as the next one's
            nonlocal last
            if last[0] != text:
                last = text, fingerprint(text)
            return last[1]

        # One row for each row read, a batch at a time; pairs may span batches.
        names = [f.split()[0] for f in RESULT.split(", ")]
        rows = (
            row
            for b in batches
            for row in zip(b["bucket"], b["closing"], b["id"], b["text"], strict=True)
        )
        made = []
        for doc_id, text, following in _pairs(rows):
            own, changed = of(text), edited(text, following)
            next_one, other = of(following), fingerprint(changed)
            made.append(
                (
                    None if doc_id == null_id else doc_id,
                    len(text),
                    hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                    own,
                    other,
                    likeness(own, other),
                    likeness(own, next_one),
                )
            )
            if len(made) == 4096:
                yield pd.DataFrame(made, columns=names).astype({"doc_id": "Int64"})
                made = []
        if made:
            yield pd.DataFrame(made, columns=names).astype({"doc_id": "Int64"})

    return placed.mapInPandas(describe, RESULT)
