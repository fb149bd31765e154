"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from linetone.session import stage


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node it reaches, for the ends of links (``a``, ``b``).

    Each round gives a node, and the node its label names, the smallest label next to it,
    then follows labels of labels; the number of rounds grows with the logarithm of a
    component's width in all but contrived cases. Every round is written, so a lost
    executor costs no earlier round. Aggregates reduce before they shuffle, so a hub with
    many links is not one task. Repeated and reversed links are fine; no links, no rows.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stage(both.distinct(), "both_ways")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
    labels = stage(labels.select("node", F.least("node", "label").alias("label")), "labels")
    while True:
        seen = labels.select(F.col("node").alias("b"), F.col("label").alias("near"))
        nearest = both.join(seen, "b").groupBy("a").agg(F.min("near").alias("near"))
        lower = labels.join(nearest, labels["node"] == nearest["a"]).where("near < label")
        lower = stage(lower.select("node", "label", "near"), "lower")
        if lower.isEmpty():
            return labels
        moves = lower.select("node", "near").unionByName(
            lower.select(F.col("label").alias("node"), "near")
        )
        moves = moves.groupBy("node").agg(F.min("near").alias("near"))
        moved = labels.join(moves, "node", "left").select(
            "node", F.least("label", "near").alias("label")
        )
        moved = stage(moved, "moved")
        # Each node takes its label's label.
        up = moved.select(F.col("node").alias("label"), F.col("label").alias("up"))
        labels = moved.join(up, "label").select("node", F.col("up").alias("label"))
        labels = stage(labels, "labels")
