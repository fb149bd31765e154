"""Minimax sharding: contiguous shards of ordered atomic groups with the least capacity."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Sequence
from functools import reduce
from operator import or_

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from linetone.llm.names import numbered, restored
from linetone.operators import running_totals
from linetone.session import stage

SHARDS = 16

# Capacities tried at once: each round of the search narrows the range by this factor.
CANDIDATES = 96

# Ends of groups near the cuts up to which the search looks through them on the driver: 0.5 MB.
NEAR = 1 << 16


def text_size() -> Column:
    """UTF-8 bytes of ``text`` (null: none) plus 1."""
    return (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")


def text_group() -> Column:
    """Equal for equal texts only; a null text is a group of its own kind."""
    return F.coalesce(F.unhex(F.sha2("text", 256)), F.lit(b"").cast("binary"))


def minimax_shards(
    df: DataFrame, size: str, group: str, tie: Sequence[str], shards: int = SHARDS
) -> DataFrame:
    """``df`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in each shard).

    Rows with the same ``group`` (never null) stay together, unless they are more than an even
    share of all, in which case each row of the group is one to be cut at. Groups are laid
    out in the order of ``group``, and the sequence is cut into contiguous shards so that the
    largest shard is as small as that order allows. A row above the even share gets a shard to
    itself and the rest is cut anew, so that it leaves the other shards even.

    Rows of a group are ordered by ``tie``; rows equal in ``tie`` take either slot. An
    empty table gives no rows; with fewer groups than shards some shards stay empty.
    Existing columns ``shard`` and ``slot`` are replaced. Pass a narrow ``df``: all its
    columns are shuffled twice.
    """
    rows, names = numbered(df)
    rows = rows.withColumn("_size", F.col(names[size]))
    group, tie = names[group], [names[t] for t in tie]
    sums = stage(rows.groupBy(group).agg(F.sum("_size").alias("_size")), "groups")
    total = sums.agg(F.sum("_size")).first()[0] or 0
    # Fewer than there are shards.
    heavy = [bytes(r[group]) for r in sums.where(F.col("_size") * shards > total).select(group).collect()]
    apart = F.col(group).isin(heavy) if heavy else F.lit(False)
    groups = sums.where(~apart).unionByName(rows.where(apart).select(group, "_size"))
    groups = stage(groups, "atoms")
    # At most one row per shard, whatever the table's size.
    largest = groups.orderBy(F.desc("_size"), group).limit(shards).collect()
    alone = []
    rest = total
    for row in largest:
        if shards - len(alone) > 1 and row["_size"] * (shards - len(alone)) > rest:
            alone.append(row)
            rest -= row["_size"]
        else:
            break
    ahead = F.lit(len(alone))
    for place, row in enumerate(alone):
        ahead = F.when(F.col(group) == F.lit(bytes(row[group])), place).otherwise(ahead)
    order = [F.col("_ahead"), F.col(group), *map(F.col, tie)]
    laid = running_totals(
        rows.withColumn("_ahead", ahead),
        order,
        {"_end": F.col("_size"), "_nth": F.lit(1).cast("long")},
        ties=True,
    )
    laid = stage(laid, "laid")
    ends = laid.where(~apart).groupBy("_ahead", group).agg(
        F.max("_end").alias("_end"), F.max("_nth").alias("_nth"), F.sum("_size").alias("_size")
    )
    ends = ends.select("_end", "_nth", "_size").unionByName(laid.where(apart).select("_end", "_nth", "_size"))
    ends = ends.select((F.col("_end") - F.col("_size")).alias("_start"), "_end", "_nth")
    ends = ends.repartitionByRange("_end").sortWithinPartitions("_end")
    ends = stage(ends, "ends")

    cuts = []
    start = 0
    for row in alone:
        start += row["_size"]
        cuts.append(start)
    bound = largest[len(alone)]["_size"] if len(largest) > len(alone) else 0
    cuts += _least_cuts(ends, start, total, bound, shards - len(alone))
    cuts = cuts[: shards - 1]
    counts = dict(ends.where(F.col("_end").isin(cuts)).groupBy("_end").agg(F.max("_nth")).collect())
    shard, first = F.lit(0), F.lit(0).cast("long")
    for cut in cuts:
        past = F.col("_end") > cut
        shard = shard + past.cast("int")
        first = F.when(past, F.lit(counts.get(cut, 0)).cast("long")).otherwise(first)
    return laid.select(
        *restored(names, ("shard", "slot")),
        shard.alias("shard"),
        (F.col("_nth") - 1 - first).alias("slot"),
    )


def _least_cuts(ends: DataFrame, start: int, total: int, bound: int, shards: int) -> list[int]:
    """Ends of the shards at the smallest capacity for which a greedy fill needs at most ``shards``.

    ``bound`` is the largest group. A capacity of the even share plus ``bound`` always
    suffices, which limits the search. A shard of any capacity in that range ends less than
    ``bound`` under it, so the ends that can matter lie in a span for each shard. As soon as
    these hold no more than ``NEAR`` ends, those are looked through here: a job a shard and
    round leaves its plan, its counts and its broadcast with the driver. Until then fills of
    ``CANDIDATES`` narrow the range; a path of a lesser capacity is nowhere ahead.
    """
    if start >= total:
        return []
    even = -(-(total - start) // shards)
    low = max(bound, even)
    high = max(low, even + bound)
    least = [start + n * (low - bound) for n in range(1, shards)]
    most = [start + n * high for n in range(1, shards)]
    filled = None
    while filled is None or low < high:
        inside = reduce(or_, (F.col("_end").between(*span) for span in zip(least, most)), F.lit(False))
        near = ends.where(inside).select("_end")
        if near.count() <= NEAR:
            known = sorted(r["_end"] for r in near.collect())
            fits = lambda c: _path(known, start, total, shards, c)[-1] == total
            return _path(known, start, total, shards, bisect_left(range(high), True, low, key=fits))
        step = max(1, -(-(high - low) // (CANDIDATES + 1)))
        paths = _fill(ends, start, total, shards, [*range(low, high, step)] or [high])
        failing = [c for c in paths if paths[c][-1] != total]
        fitting = [c for c in paths if paths[c][-1] == total]
        if fitting:
            high, filled = fitting[0], paths[fitting[0]]
            most = [*filled, *[total] * shards][: shards - 1]
        if failing:
            low, least = failing[-1] + 1, paths[failing[-1]][: shards - 1]
    return filled


def _path(ends: list[int], start: int, total: int, shards: int, capacity: int) -> list[int]:
    """Where a greedy fill ends each shard; ``ends`` has at least those that it meets, sorted."""
    path = [start]
    while len(path) <= shards and path[-1] < total:
        point = path[-1] + capacity
        path.append(total if point >= total else ends[bisect_right(ends, point) - 1])
    return path[1:]


def _fill(
    ends: DataFrame, start: int, total: int, shards: int, capacities: list[int]
) -> dict[int, list[int]]:
    """For each capacity, where a greedy fill ends each shard.

    All capacities advance by one shard in one job. Groups follow each other without a gap,
    so a shard that may reach a point ends where the group over that point starts: a filter
    finds it, which gives a row a point at most, and the scan of the sorted table reads no
    rows before the first point or after the last. The points are one value, not an expression
    each, as every expression's code would be compiled and kept by the driver.
    """
    paths: dict[int, list[int]] = {c: [start] for c in capacities}
    for _ in range(shards):
        points = sorted({p[-1] + c for c, p in paths.items() if p[-1] + c < total})
        over = []
        if points:
            inside = F.exists(
                F.lit(np.array(points, np.int64)), lambda x: (F.col("_start") <= x) & (x < F.col("_end"))
            )
            near = ends.where((F.col("_end") > points[0]) & (F.col("_start") <= points[-1]))
            over = sorted(r["_start"] for r in near.where(inside).select("_start").collect())
        for c, path in paths.items():
            if path[-1] < total:
                point = path[-1] + c
                path.append(total if point >= total else over[bisect_right(over, point) - 1])
    return {c: path[1:] for c, path in paths.items()}
