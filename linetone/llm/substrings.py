"""Removal of repeated byte strings: bucket-pointer refinement at sampled suffixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from linetone.llm.batches import bound_batches
from linetone.llm.bitmaps import bitmap, in_bitmap, passes
from linetone.operators import running_totals
from linetone.session import stage

# Bytes of the strings that may occur once only, and of the grams of the first buckets.
LENGTH = 100
GRAM = 56

# Size of the filter of buckets, as a power of two: 16 MB whatever the input.
ANCHOR_BITS = 27

# Bits of a gram's bucket that the first count tells apart.
COUNTED_BITS = 40

# Bytes handled at a time.
PIECE = 1 << 19

_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_BYTES = np.random.default_rng(20).integers(0, 1 << 64, 256, dtype=np.uint64)


def _powers(base: int) -> np.ndarray:
    powers = np.full(PIECE + 2 * LENGTH, np.uint64(base))
    powers[0] = 1
    return np.multiply.accumulate(powers)


_UP, _DOWN = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def _sums(content: np.ndarray) -> np.ndarray:
    """Running sums from which the identifier of any substring follows."""
    sums = np.zeros(len(content) + 1, np.uint64)
    np.cumsum(_BYTES[content] * _UP[: len(content)], out=sums[1:])
    return sums


def _grams(sums: np.ndarray) -> np.ndarray:
    """Bucket identifier of the gram at each offset."""
    n = len(sums) - GRAM
    return _mixed((sums[GRAM:] - sums[:n]) * _DOWN[:n])


def _refined(grams: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Identifiers of whole strings: the bucket at their start, refined by the one at the later
    offset where a gram ends with the string."""
    return _mixed(grams[starts] * _MIX + grams[starts + (LENGTH - GRAM)])


def _anchors(content: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor bucket, context identifier, first start and number of starts of each anchor.

    A string's anchor is its gram of smallest identifier, the first of equal ones, so equal
    strings have equal anchors in equal places. Strings that share one occurrence of an anchor
    are consecutive; together they cover its context.
    """
    sums = _sums(content)
    grams = _grams(sums)
    low_bits = np.uint64((1 << 20) - 1)
    low = (grams & ~low_bits) | np.arange(len(grams), dtype=np.uint64)
    width, reach = LENGTH - GRAM + 1, 1
    while 2 * reach <= width:
        low, reach = np.minimum(low[: len(low) - reach], low[reach:]), 2 * reach
    low = np.minimum(low[: len(low) - (width - reach)], low[width - reach :])
    anchor = (low & low_bits).astype(np.int64)
    first = np.concatenate(([0], np.flatnonzero(np.diff(anchor)) + 1))
    last = np.concatenate((first[1:], [len(anchor)])) - 1
    at = anchor[first]
    context = (sums[last + LENGTH] - sums[first]) * _DOWN[first]
    shape = ((at - first) << 32) + (last - first)
    context = _mixed(context) ^ _mixed(shape.astype(np.uint64) * _MIX)
    return grams[at], context, first, last - first + 1


def _contents(texts: pa.Array) -> Iterator[np.ndarray]:
    """The UTF-8 bytes of each text, as they lie in the batch. No text is null."""
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, width)[texts.offset : texts.offset + len(texts) + 1]
    content = np.frombuffer(data or b"", np.uint8)
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield content[start:end]


def _pieces(content: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Parts of a text with all strings in one part each."""
    for start in range(0, len(content) - LENGTH + 1, PIECE):
        yield start, content[start : start + PIECE + LENGTH - 1]


def _counted(bucket: np.ndarray) -> np.ndarray:
    return bucket >> np.uint64(64 - COUNTED_BITS)


def _bucket_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [
            _counted(_anchors(piece)[0])
            for content in _contents(batch["text"])
            for _, piece in _pieces(content)
        ]
        if found:
            keys = np.concatenate(found).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys)], ["key"])


def _anchor_rows(repeated: Broadcast):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            docs = batch["doc"].to_numpy(zero_copy_only=False)
            for doc, content in zip(docs, _contents(batch["text"]), strict=True):
                for start, piece in _pieces(content):
                    bucket, context, first, starts = _anchors(piece)
                    kept = passes(repeated.value, _counted(bucket))
                    doc_column = np.full(int(kept.sum()), doc, np.int64)
                    made.append(
                        (bucket[kept], context[kept], doc_column, first[kept] + start, starts[kept])
                    )
            if made:
                columns = [np.concatenate(c) for c in zip(*made, strict=True)]
                columns = [c.view(np.int64) if c.dtype == np.uint64 else c for c in columns]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, columns[:4]), pa.array(columns[4].astype(np.int32))],
                    ["bucket", "context", "doc", "start", "n"],
                )

    return rows


def _contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each document's unresolved anchors, the bytes of their contexts."""
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        rows = []
        for doc, body, anchors in zip(batch["doc"], batch["body"], batch["anchors"], strict=True):
            content = unpack.decompress(body)
            rows += [
                (
                    a["bucket"], doc, a["start"], a["n"], a["rank"],
                    content[a["start"] : a["start"] + a["n"] - 1 + LENGTH],
                )
                for a in anchors
            ]
        yield pd.DataFrame(rows, columns=["bucket", "doc", "start", "n", "rank", "content"])


def _strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each string of unresolved contexts, many contexts hashed at once."""
    for batch in batches:
        sizes = batch["content"].map(len).to_numpy(np.int64)
        groups = np.cumsum(sizes) // PIECE
        for group in np.unique(groups):
            part, lengths = batch[groups == group], sizes[groups == group]
            content = np.frombuffer(b"".join(part["content"]), np.uint8)
            grams = _grams(_sums(content))
            n = part["n"].to_numpy(np.int64)
            offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = np.repeat(np.cumsum(lengths) - lengths, n) + offset
            yield pd.DataFrame(
                {
                    "bucket": np.repeat(part["bucket"].to_numpy(np.int64), n),
                    "context": _refined(grams, at).view(np.int64),
                    "doc": np.repeat(part["doc"].to_numpy(np.int64), n),
                    "start": np.repeat(part["start"].to_numpy(np.int64), n) + offset,
                    "place": np.repeat(part["rank"].to_numpy(np.int64), n) * LENGTH + offset,
                }
            )


PLACE = "doc long, start long"


# Places are compared as one number, which aggregates by hash where a struct would sort. A
# start fits 31 bits, as a string does in memory.
_STARTS = 1 << 31


def _firsts(rows: DataFrame) -> DataFrame:
    """The first place of each bucket and context; partial minima keep frequent ones small."""
    place = F.col("doc").cast("decimal(20,0)") * F.lit(_STARTS) + F.col("start")
    place = F.min(place.cast("decimal(38,0)")).alias("place")
    n = F.min("n").alias("n")  # equal contexts have as many strings
    start = F.pmod("place", F.lit(_STARTS).cast("decimal(38,0)"))
    found = rows.groupBy("bucket", "context").agg(place, n).withColumn("start", start)
    doc = ((F.col("place") - F.col("start")) / F.lit(_STARTS)).cast("long").alias("doc")
    return found.select("bucket", doc, F.col("start").cast("long").alias("start"), "n")


def repeated_spans(texts: DataFrame) -> DataFrame:
    """``doc`` and ``spans``, where its strings stand that also start earlier; ``texts``: ``doc``, ``text``.

    1. Only strings whose anchor's bucket occurs twice can repeat. A first count finds these
       buckets, a filter of fixed size carries them to the texts.
    2. Anchors with their contexts: an equal context at an earlier place makes all its
       strings repeats. Buckets left with one context are done.
    3. For the rest, near copies where they differ, buckets are refined string by string.

    Each round compares identifiers by sums that reduce before they shuffle. Bucket and
    refined identifier make 128 bits. Only round 3 moves texts, packed, and only those with
    such anchors.
    """
    long = texts.where(F.octet_length("text") >= LENGTH)
    keys = long.select("text").mapInArrow(_bucket_keys, "key long")
    keys = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    repeated = bitmap(keys, "key", ANCHOR_BITS)
    rows = long.mapInArrow(_anchor_rows(repeated), f"bucket long, context long, {PLACE}, n int")
    firsts = stage(_firsts(rows), "firsts")
    places = firsts.select("doc", "start")
    whole = rows.select("doc", "start", "n").join(places, ["doc", "start"], "left_anti")
    whole = whole.select("doc", "start", (F.col("start") + F.col("n") - 1 + LENGTH).alias("end"))
    whole = stage(whole, "whole")

    several = firsts.groupBy("bucket").agg(F.count("*").alias("contexts")).where("contexts > 1")
    several = stage(several.select("bucket"), "several")
    open_ = firsts.join(several, "bucket")
    # Numbered in order, a context and an offset in it make one number for a string's place.
    order, one = [F.col("doc"), F.col("start")], F.lit(1).cast("long")
    open_ = stage(running_totals(open_, order, {"rank": one}), "open")
    anchors = F.collect_list(F.struct("bucket", "start", "n", "rank")).alias("anchors")
    anchors = open_.groupBy("doc").agg(anchors).join(_packed(long, in_bitmap(open_, "doc")), "doc")
    columns = f"bucket long, {PLACE}, n int, rank long, content binary"
    contexts = stage(anchors.mapInPandas(_contexts, columns), "contexts")
    strings = contexts.mapInPandas(_strings, f"bucket long, context long, {PLACE}, place long")
    first = strings.groupBy("bucket", "context").agg(F.min("place").alias("place"))
    single = strings.select("doc", "start", "place").join(first.select("place"), "place", "left_anti")
    single = single.select("doc", "start", (F.col("start") + LENGTH).alias("end"))
    spans = whole.unionByName(single).groupBy("doc")
    return spans.agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def _packed(texts: DataFrame, wanted) -> DataFrame:
    """``doc`` and ``body``, the compressed text, of the wanted documents."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            bodies = [packer.compress(content) for content in _contents(batch["text"])]
            yield pa.RecordBatch.from_arrays(
                [batch["doc"], pa.array(bodies, pa.binary())], ["doc", "body"]
            )

    return texts.where(wanted(F.col("doc"))).mapInArrow(pack, "doc long, body binary")


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def merged(spans: np.ndarray) -> np.ndarray:
    """Maximal runs of sorted ``[start, end)`` rows."""
    ends = np.maximum.accumulate(spans[:, 1])
    opens = np.concatenate(([True], spans[1:, 0] > ends[:-1]))
    return np.column_stack((spans[opens, 0], ends[np.append(opens[1:], True)]))


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        rows = []
        for doc, body, spans in zip(batch["doc"], batch["body"], batch["spans"], strict=True):
            content = unpack.decompress(body)
            runs = []
            if spans is not None and len(spans):
                pairs = np.array([(s["start"], s["end"]) for s in spans], np.int64)
                runs = merged(pairs[np.argsort(pairs[:, 0], kind="stable")]).tolist()
            kept, at, removed = hashlib.sha256(), 0, 0
            for start, end in runs:
                kept.update(content[at:start])
                removed, at = removed + end - start, end
            kept.update(content[at:])
            rows.append((doc, len(content), removed, len(runs), kept.hexdigest()))
        yield pd.DataFrame(rows, columns=["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


NULL_ID = -(1 << 63)


def without_repeats(documents: DataFrame) -> DataFrame:
    """For every document: bytes, bytes removed, maximal removed runs, and a digest of the rest.

    Removed is each byte of a string of ``LENGTH`` bytes that also starts earlier, in a document
    of smaller ``doc_id`` or before in the same one. Repeats are judged on the input; strings
    lie within a document. A null text is empty; texts shorter than a string lose nothing. A
    null ``doc_id`` counts as the smallest. Rows with one id are one document: equal rows are
    no repeats of each other, and what one loses all of them lose, as far as they reach. Only
    ``doc_id`` and ``text`` are used. An empty table gives no rows.

    Texts that lose nothing are not shuffled, but for a few that the filter lets pass.
    """
    bound_batches(documents.sparkSession)
    texts = documents.select(
        F.coalesce(F.col("doc_id"), F.lit(NULL_ID)).cast("long").alias("doc"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    spans = stage(repeated_spans(texts), "spans")
    touched = in_bitmap(spans, "doc")
    whole = texts.where(~touched(F.col("doc"))).select(
        "doc",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"),
        F.sha2("text", 256).alias("kept_sha256"),
    )
    cut = _packed(texts, touched).join(spans, "doc", "left")
    cut = cut.mapInPandas(_cut, RESULT.replace("doc_id", "doc"))
    id_: Column = F.when(F.col("doc") != NULL_ID, F.col("doc")).alias("doc_id")
    return whole.unionByName(cut).select(id_, "n_bytes", "n_removed", "n_spans", "kept_sha256")


# The same with every string as a row, on the hexadecimal digits of the texts, for DuckDB.
ORACLE_SQL = f"""
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
strings AS (
  SELECT doc_id, s, md5(substr(h, 2 * s + 1, {2 * LENGTH})) AS k
  FROM (SELECT doc_id, h, unnest(range(greatest(len(h) // 2 - {LENGTH - 1}, 0))) AS s FROM texts)),
later AS (
  SELECT doc_id, s FROM (
    SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS nth FROM strings)
  WHERE nth > 1),
opened AS (
  SELECT doc_id, s, coalesce(s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) > {LENGTH}, true) AS opens
  FROM later),
numbered AS (
  SELECT doc_id, s, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM opened),
runs AS (
  SELECT doc_id, run, min(s) AS a, max(s) + {LENGTH} AS b FROM numbered GROUP BY doc_id, run),
gaps AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS kept_from FROM runs),
cut AS (
  SELECT doc_id, string_agg(substr(h, 2 * kept_from + 1, 2 * (a - kept_from)), '' ORDER BY a)
                   || substr(any_value(h), 2 * max(b) + 1) AS kept,
         sum(b - a) AS n_removed, count(*) AS n_spans
  FROM gaps JOIN texts USING (doc_id) GROUP BY doc_id)
SELECT doc_id, len(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM texts LEFT JOIN cut USING (doc_id)
"""
