"""Filters of a fixed size over keys of any number: they let all of the keys pass, and few others."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

# Size of a filter of documents, as a power of two: 8 MB.
DOCUMENT_BITS = 26

# Bits in a chunk, the unit that tasks fill.
CHUNK = 15


def bitmap(keys: DataFrame, key: str, bits: int) -> Broadcast:
    """A broadcast array of 2 ** ``bits`` bits, set where the lowest ``bits`` of a ``key`` point.

    Its size does not depend on the number of keys. With more keys than bits it lets nearly
    everything pass, so what it saves shrinks but nothing is lost. Tasks fill the chunks.
    """
    place = F.col(key).bitwiseAND((1 << bits) - 1)
    places = keys.select(
        F.shiftright(place, CHUNK).cast("int").alias("chunk"),
        place.bitwiseAND((1 << CHUNK) - 1).cast("int").alias("bit"),
    )

    @F.pandas_udf("binary")
    def packed(sets: pd.Series) -> pd.Series:
        def pack(places: np.ndarray) -> bytes:
            bits = np.zeros(1 << CHUNK, np.uint8)
            bits[places] = 1
            return np.packbits(bits).tobytes()

        return sets.map(pack)

    chunks = places.groupBy("chunk").agg(F.collect_set("bit").alias("bits"))
    filled = np.zeros(1 << (bits - 3), np.uint8)
    size = 1 << (CHUNK - 3)
    for chunk, content in chunks.select("chunk", packed("bits")).collect():
        filled[chunk * size : (chunk + 1) * size] = np.frombuffer(content, np.uint8)
    return keys.sparkSession.sparkContext.broadcast(filled)


def passes(filled: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of ``keys`` (unsigned 64-bit) the bitmap lets through."""
    place = (keys & np.uint64(8 * len(filled) - 1)).astype(np.int64)
    return (filled[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1


def in_bitmap(keys: DataFrame, *columns: str) -> Callable[..., Column]:
    """A condition on as many columns that holds for all of ``keys`` and for few others.

    So the few are joined with the keys, and all other rows stay where they are.
    """
    hashed = keys.select(F.xxhash64(*columns).alias("key")).distinct()
    filled = bitmap(hashed, "key", DOCUMENT_BITS)

    @F.pandas_udf("boolean")
    def maybe(hashes: pd.Series) -> pd.Series:
        return pd.Series(passes(filled.value, hashes.to_numpy(np.int64).view(np.uint64)))

    return lambda *values: maybe(F.xxhash64(*values))
