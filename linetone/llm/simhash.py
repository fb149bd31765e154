"""SimHash near-duplicates by an inverted index on the bytes of the fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from linetone.llm.bitmaps import in_bitmap
from linetone.llm.components import components
from linetone.llm.names import numbered, restored
from linetone.session import stage

SHINGLE = 4
SEED = 42
BITS = 64
MOST_BITS = 4

# Bytes in a fingerprint, and how many of them two linked ones share at least: each
# differing bit spoils one byte at most.
BYTES = BITS // 8
SHARED = BYTES - MOST_BITS

# Fingerprints in a posting list up to which its pairs are compared one by one.
LIST = 48

# Shingles hashed at a time, which bounds the memory that a very long text takes.
CHUNK = 1 << 18

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit fingerprint; bits in over half of the shingles' hashes are set.

    Words are runs of other than space and U+0009 to U+000D, A-Z lower-cased. Fewer words
    than a shingle make one shingle; no words (or null) give 0.
    """
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, CHUNK):
        end = min(n, at + CHUNK)
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(b" ".join(words[i : i + shingle]), SEED) for i in range(at, end)),
            np.uint64,
            end - at,
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * counts > n, bitorder="little")
    return int(set_bits.view(np.uint64)[0])


def _fingerprints(shingle: int):
    @F.pandas_udf("long")
    def fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            values = np.fromiter((simhash(t, shingle) for t in texts), np.uint64, len(texts))
            yield pd.Series(values.view(np.int64))

    return fingerprint


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def _links(distinct: DataFrame) -> DataFrame:
    """Links (``a``, ``b``) with the same components as all pairs of at most ``MOST_BITS``.

    The inverted index has, for each fingerprint, its choices of ``SHARED`` byte positions
    with the bytes there, so that every pair with the guaranteed number of equal bytes
    meets in a list. Lists of up to ``LIST`` fingerprints give their pairs, whose shared
    bytes are then counted and whose bits are compared.

    A longer list would give pairs by the square of its length. A pair that meets in long
    lists only has both its members among the fingerprints of long lists, and those are
    linked another exact way: a pair differs in at most ``MOST_BITS`` bits if, and only if,
    some value is within half as many bits of both. Every such value a fingerprint reaches
    is a key, and the smallest fingerprint at a key is linked to the others there.

    All three joins are merges: Spark sizes exploded rows as if nothing was exploded, and a
    table by its compressed files, and would send tens of millions of rows by the driver.
    """
    masks = [
        sum(0xFF << (8 * p) for p in positions) for positions in combinations(range(BYTES), SHARED)
    ]
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    keys = F.array(
        *(
            F.struct(F.lit(i).cast("byte").alias("block"), F.col("fp").bitwiseAND(F.lit(m)).alias("bytes"))
            for i, m in enumerate(signed)
        )
    )
    postings = distinct.select("fp", F.explode(keys).alias("key")).select("fp", "key.*")
    lists = postings.groupBy("block", "bytes").agg(F.count("*").alias("n")).where("n > 1")
    shared = stage(postings.join(lists.hint("merge"), ["block", "bytes"]), "lists")
    short = shared.where(F.col("n") <= LIST).select("block", "bytes", "fp")
    a, b = short.withColumnRenamed("fp", "a"), short.withColumnRenamed("fp", "b")
    differing = F.col("a").bitwiseXOR(F.col("b"))
    equal_bytes = sum(
        (differing.bitwiseAND(F.lit(m if m < 1 << (BITS - 1) else m - (1 << BITS))) == 0).cast("int")
        for m in (0xFF << (8 * p) for p in range(BYTES))
    )
    pairs = (
        a.join(b.hint("merge"), ["block", "bytes"])
        .where(F.col("a") < F.col("b"))
        .where(equal_bytes >= SHARED)
        .where(F.bit_count(differing) <= MOST_BITS)
        .select("a", "b")
        .distinct()
    )
    crowded = shared.where(F.col("n") > LIST).select("fp").distinct()
    flips = [0, *(1 << i for i in range(BITS))]
    flips += [(1 << i) | (1 << j) for i, j in combinations(range(BITS), 2)]
    flips = [f - (1 << BITS) if f >> (BITS - 1) else f for f in flips]
    near = F.transform(F.lit(np.array(flips, np.int64)), lambda flip: flip.bitwiseXOR(F.col("fp")))
    reached = crowded.select("fp", F.explode_outer(near).alias("key"))
    meeting = reached.groupBy("key").agg(F.min("fp").alias("a"), F.max("fp").alias("b"))
    meeting = meeting.where(F.col("a") < F.col("b")).select("key", "a")
    through = reached.join(meeting.hint("merge"), "key").where(F.col("a") < F.col("fp"))
    return pairs.unionByName(through.select("a", F.col("fp").alias("b")).distinct())


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``text_key`` (a hash of the text), ``fp``, ``label`` and ``component_id``.

    ``component_id`` is the smallest ``doc_id`` reachable over links, ``label`` the smallest
    fingerprint.

    One row per row of ``documents``; texts go nowhere. Equal fingerprints are one node, so
    copies cost one row each. Texts without words (null, empty) have fingerprint 0 and link
    like any other. A null ``doc_id`` is no candidate for the smallest, unless a component
    has no other. Only ``doc_id`` and ``text`` are used. An empty table gives no rows.
    """
    text_key = F.xxhash64("text").alias("text_key")
    prints = documents.select("doc_id", text_key, _fingerprints(shingle)("text").alias("fp"))
    prints = stage(prints, "fingerprints")
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    return with_components(prints, nodes, stage(_links(nodes.select("fp")), "links"))


def with_components(prints: DataFrame, nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``prints`` with ``label`` and ``component_id`` from the links between ``nodes``' ``fp``."""
    labels = components(links)  # only fingerprints with a link
    grouped = nodes.join(labels, nodes["fp"] == labels["node"], "left").select(
        "fp", "first", F.coalesce("label", "fp").alias("label")
    )
    grouped = stage(grouped, "grouped")
    smallest = grouped.groupBy("label").agg(F.min("first").alias("component_id"))
    by_print = grouped.join(smallest, "label").select("fp", "label", "component_id")
    by_print = stage(by_print, "by_print")
    columns = ["doc_id", "text_key", "fp", "label", "component_id"]
    return prints.join(by_print, "fp").select(*columns)


def without_near_duplicates(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One document of each component, chosen as ``one_of_each`` says."""
    return one_of_each(documents, near_duplicates(documents, shingle))


def one_of_each(documents: DataFrame, found: DataFrame) -> DataFrame:
    """One document of each component in ``found``: the one with the smallest ``doc_id``.

    If that ``doc_id`` occurs in several rows of the component, one of them stays. The rows
    that go, and those that stand for others, are known by id and hash of the text; a filter
    of fixed size tells nearly all other rows from them, so that texts are shuffled for few.
    """
    found = stage(found, "near_duplicates")
    smallest = F.col("doc_id").eqNullSafe(F.col("component_id"))
    chosen = found.where(smallest).groupBy(F.col("doc_id").alias("id"), "label").agg(
        F.min("text_key").alias("chosen"), F.count("*").alias("n")
    )
    chosen = chosen.withColumnRenamed("label", "_label")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("label") == F.col("_label"))
    keep = F.coalesce(smallest & (F.col("text_key") == F.col("chosen")), F.lit(False))
    marked = found.join(chosen, same, "left").select(
        F.col("doc_id").alias("id"), "text_key", keep.alias("keep"), "n"
    )
    marked = stage(marked.where("not keep or n > 1").drop("n").distinct(), "marked")
    rows, names = numbered(documents)
    rows = rows.withColumns({"_id": F.col(names["doc_id"]), "_key": F.xxhash64(names["text"])})
    maybe = in_bitmap(marked, "id", "text_key")(F.col("_id"), F.col("_key"))
    same = F.col("_id").eqNullSafe(F.col("id")) & (F.col("_key") == F.col("text_key"))
    left = rows.where(maybe).join(marked, same, "left").where("keep is null or keep")
    left = stage(left, "left")
    kept = rows.where(~maybe).select(*names.values())
    kept = kept.unionByName(left.where("keep is null").select(*names.values()))
    repeated = left.where("keep").dropDuplicates(["_id", "_key"])
    return kept.unionByName(repeated.select(*names.values())).select(*restored(names))
