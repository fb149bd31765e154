"""Blocks of lines between blank lines, from text files of any size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from linetone.functions import scanned_file_key
from linetone.functions.keys import TEXT_SUFFIX

PIECES = "file_key string, offset long, place long, opened boolean, closed boolean, block string"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of splits of files, in order, to what stands between blank lines in each split.

    A split's first piece may go on from the split before (not ``opened``), its last may go on
    in the next (not ``closed``). Lines are joined by Arrow, a batch at a time; only the lines
    after a batch's last blank line are carried over.
    """
    file, start, place, held = None, None, 0, []

    def piece(*rows: tuple) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        types = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
        names = ["file_key", "offset", "place", "opened", "closed", "block"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    def last() -> pa.RecordBatch:
        return piece((file, start, place, place > 0 or start == 0, False, "\n".join(held)))

    for batch in batches:
        files, starts = batch.column("file_key"), batch.column("offset").to_numpy(zero_copy_only=False)
        lines = batch.column("line")
        changes = np.flatnonzero(starts[1:] != starts[:-1]) + 1
        same_file = pc.equal(files.slice(1), files.slice(0, max(0, len(files) - 1)))
        changes = np.union1d(changes, np.flatnonzero(~same_file.to_numpy(zero_copy_only=False)) + 1)
        bounds = [0, *changes.astype(int).tolist(), len(lines)]
        for low, high in zip(bounds, bounds[1:], strict=False):
            if low == high:
                continue
            of = (files[low].as_py(), int(starts[low]))
            if of != (file, start):
                if file is not None:
                    yield last()
                (file, start), place, held = of, 0, []
            part = lines.slice(low, high - low)
            blank = pc.equal(pc.ascii_trim_whitespace(part), "").to_numpy(zero_copy_only=False)
            ends = np.flatnonzero(blank)
            if len(ends):
                first = ends[0]
                held += part.slice(0, first).to_pylist()
                yield piece((file, start, place, place > 0 or start == 0, True, "\n".join(held)))
                place, held = place + 1, []
                if len(ends) > 1:
                    # What lies between two blank lines of the batch, all at once.
                    offsets = np.concatenate([[0], np.diff(ends) - 1]).cumsum()
                    inside = np.ones(len(part), bool)
                    inside[ends] = False
                    inside[: first + 1] = False
                    inside[ends[-1] :] = False
                    said = pa.ListArray.from_arrays(
                        pa.array(offsets, pa.int32()), part.filter(pa.array(inside))
                    )
                    count = len(ends) - 1
                    yes = pa.array(np.ones(count, bool))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([file] * count, pa.string()),
                            pa.array([start] * count, pa.int64()),
                            pa.array(np.arange(place, place + count)),
                            yes,
                            yes,
                            pc.binary_join(said, "\n"),
                        ],
                        ["file_key", "offset", "place", "opened", "closed", "block"],
                    )
                    place += count
                held = part.slice(ends[-1] + 1).to_pylist()
            else:
                held += part.to_pylist()
    if file is not None:
        yield last()


def read_blocks(spark: SparkSession, folder: str, suffix: str = TEXT_SUFFIX) -> DataFrame:
    """``file_key``, ``offset``, ``place`` and ``block``: the lines between blank lines, newline between.

    ``offset`` and ``place`` order the blocks of a file. Lines end in LF or CR LF; a line of white
    space is blank. Spark cuts large files into splits, each of which finds its blocks; the
    pieces at the borders, two a split, are the only ones that move and are put together in
    order. So one file is many tasks, and no cell is larger than a block.
    """
    lines = spark.read.text(folder, pathGlobFilter=f"*{suffix}").select(
        scanned_file_key(F.col("_metadata.file_name")).alias("file_key"),
        F.col("_metadata.file_block_start").alias("offset"),
        F.col("value").alias("line"),
    )
    pieces = lines.mapInArrow(_pieces, PIECES)
    whole = pieces.where("opened and closed")
    borders = pieces.where("not (opened and closed)")
    in_file = Window.partitionBy("file_key").orderBy("offset", "place")
    before = F.coalesce(F.lag("closed").over(in_file), F.lit(True))
    begins = (F.col("opened") | before).cast("int")
    numbered = borders.withColumn("begins", begins).withColumn(
        "number", F.sum("begins").over(in_file.rowsBetween(Window.unboundedPreceding, 0))
    )
    parts = F.array_sort(F.collect_list(F.struct("offset", "place", "block")))
    said = F.filter(F.transform(parts, lambda p: p["block"]), lambda b: b != "")
    joined = numbered.groupBy("file_key", "number").agg(
        F.min(F.struct("offset", "place")).alias("first"), F.array_join(said, "\n").alias("block")
    )
    joined = joined.select("file_key", "first.offset", "first.place", "block")
    blocks = whole.select("file_key", "offset", "place", "block").unionByName(joined)
    return blocks.where("block <> ''")
