"""Mixing sources to target weights by exact cuts in a hash-random order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from linetone.llm.names import numbered, restored
from linetone.operators import running_totals
from linetone.session import stage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
WORD = r"[^\x20\x09-\x0D]+"


def word_count() -> Column:
    """Number of words in ``text``; null: 0."""
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")


def random_key() -> Column:
    """The same for the same row in every run, and unrelated to its content's order."""
    fields = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_id", "text"))
    return F.md5(F.concat_ws(":", *fields))


def source_targets(
    sizes: DataFrame, weights: Sequence[float], share: float, most: float
) -> DataFrame:
    """``source``, ``source_size`` to also ``target`` and ``_base``, what the sources before hold.

    Sources by code point, null last, take the weights in turn. The budget is ``share``
    of all sizes. A source stops at ``most`` times its size and the others share the
    excess by weight: filling them in the order of limit per weight needs one pass.
    One row per source; the window sees only these.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    place = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(place, F.lit(len(weights))) + 1)
    earlier = by_name.rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumns(
        {
            "_weight": weight.cast("double"),
            "_limit": F.col("source_size") * F.lit(float(most)),
            "_base": F.coalesce(F.sum("source_size").over(earlier), F.lit(0)),
        }
    ).withColumn("_full_at", F.col("_limit") / F.col("_weight"))
    filling = Window.orderBy("_full_at", F.asc_nulls_last("source"))
    full = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy().rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    left = F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(
        F.sum("_limit").over(full), F.lit(0.0)
    )
    level = left / F.sum("_weight").over(onward)
    sizes = sizes.withColumn("_level", F.when(level < F.col("_full_at"), level))
    # The first level below its source's limit holds for all sources from there on.
    level = F.max("_level").over(everything)
    first = F.min(F.when(F.col("_level").isNotNull(), F.col("_full_at"))).over(everything)
    target = F.when(F.col("_full_at") >= first, F.col("_weight") * level)
    return sizes.withColumn("target", F.coalesce(target, F.col("_limit"))).select(
        "source", "source_size", "target", "_base"
    )


def mix(
    documents: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """``documents`` with ``size``, ``source_size``, ``target``, ``taken``, ``copies``.

    Each source is sorted by a hash-random key and repeated until its target, in words, is
    met: ``target // source_size`` whole passes and a last one that is cut at the exact
    word. ``taken`` counts a document's words in the mix, repeats included; ``copies`` is
    how often the document is in it, counting the one at the cut if half of it or more is
    taken. Reruns agree.

    Only keys and sizes are sorted. Where a source's last pass ends is one key per source,
    which every document then compares with its own: texts are not shuffled.

    Null texts and texts without words have size 0 and are copied with their place in the
    order; a source without words has target 0 and gives none. Repeated rows share a key;
    those at the cut are filled one after the other. Null sources are one source. Existing columns of these names are
    replaced. An empty table gives no rows.
    """
    rows, names = numbered(documents)
    rows = rows.withColumns(
        {c: F.col(names[c]) for c in ("doc_id", "text", "source")}
    ).select(
        *names.values(), "source", random_key().alias("_key"), word_count().alias("_size")
    )
    thin = stage(rows.select("source", "_key", "_size"), "sizes")
    order = [F.asc_nulls_last("source"), F.col("_key")]
    ranged = running_totals(thin, order, {"_end": F.col("_size")})
    sizes = thin.groupBy("source").agg(F.sum("_size").alias("source_size"))
    plan = source_targets(sizes, weights, share, most)
    plan = plan.withColumn("_budget", F.round("target").cast("long")).withColumns(
        {
            "_passes": F.coalesce(F.expr("_budget div nullif(source_size, 0)"), F.lit(0)),
            "_rest": F.coalesce(F.expr("_budget % nullif(source_size, 0)"), F.lit(0)),
        }
    )
    plan = stage(plan.withColumnRenamed("source", "_source"), "budgets")
    same = F.col("source").eqNullSafe(F.col("_source"))
    end = F.col("_end") - F.col("_base")
    cut = (
        ranged.join(plan.select("_source", "_base", "_rest"), same)
        .where(end > F.col("_rest"))
        .groupBy("_source")
        .agg(F.min("_key").alias("_cut_key"))
    )
    cut = stage(cut.withColumnRenamed("_source", "_cut_source"), "cut")
    key, size = F.col("_key"), F.col("_size")
    earlier = F.coalesce(F.sum(F.when(key < F.col("_cut_key"), size)), F.lit(0))
    cut = (
        thin.join(cut, F.col("source").eqNullSafe(F.col("_cut_source")))
        .where(key <= F.col("_cut_key"))
        .groupBy("_cut_source", "_cut_key")
        .agg(earlier.alias("_earlier"), F.count_if(key == F.col("_cut_key")).alias("_equal"))
    )
    plan = plan.join(cut, F.col("_source").eqNullSafe(F.col("_cut_source")), "left")
    plan = plan.withColumn("_left", F.col("_rest") - F.col("_earlier"))
    plan = stage(plan, "plan")  # read back, its size is known and decides how it is joined
    placed = rows.join(plan, same)
    before = F.col("_cut_key").isNull() | (key < F.col("_cut_key"))
    at_cut = F.coalesce(key == F.col("_cut_key"), F.lit(False))
    started = F.col("_rest") > 0
    if plan.where(started & (F.col("_equal") > 1)).isEmpty():
        placed = placed.withColumn("_first", F.lit(0).cast("long"))
    else:
        repeated = at_cut & started & (F.col("_equal") > 1)
        dealt = _dealt(placed.where(repeated))
        placed = placed.where(~repeated).withColumn("_first", F.lit(0).cast("long"))
        placed = placed.unionByName(dealt)
    part = F.greatest(F.lit(0), F.least(size, F.col("_left") - F.col("_first")))
    part = F.when(before, size).when(at_cut, part).otherwise(F.lit(0))
    part = F.when(started, part).otherwise(F.lit(0))
    half = at_cut & (2 * (F.col("_left") - F.col("_first")) >= size)
    last = started & (before | half)
    return placed.select(
        *restored(names, ("size", "source_size", "target", "taken", "copies")),
        size.alias("size"),
        "source_size",
        "target",
        (F.col("_passes") * size + part).cast("long").alias("taken"),
        (F.col("_passes") + last.cast("long")).cast("long").alias("copies"),
    )


def _dealt(repeated: DataFrame) -> DataFrame:
    """Rows that share their source's cut with ``_first``, the words of those filled before.

    They are numbered as they come, so that any number of them is dealt over all tasks.
    """
    repeated = stage(repeated.withColumn("_id", F.monotonically_increasing_id()), "repeated")
    order = [F.asc_nulls_last("source"), F.col("_id")]
    placed = running_totals(repeated, order, {"_upto": F.col("_size")})
    placed = stage(placed.withColumn("_first", F.col("_upto") - F.col("_size")), "placed")
    starts = placed.groupBy(F.col("source").alias("_start_of")).agg(F.min("_first").alias("_start"))
    placed = placed.join(starts, F.col("source").eqNullSafe(F.col("_start_of")))
    placed = placed.withColumn("_first", F.col("_first") - F.col("_start"))
    return placed.drop("_id", "_upto", "_start_of", "_start")


def mixed(documents: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as ``copies`` says, in the input's columns."""
    rows, names = numbered(documents)
    needed = {names[c]: c for c in ("doc_id", "text", "source")}
    found = mix(rows.withColumns({c: F.col(n) for n, c in needed.items()}), **options)
    times = F.array_repeat(F.lit(0), F.col("copies").cast("int"))
    repeated = found.select(*names.values(), F.explode(times).alias("_"))
    return repeated.select(*restored(names))


# The same from plain windows over whole sources, for DuckDB.
ORACLE_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(text, '{WORD}')) AS n,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS k
  FROM documents),
docs AS (SELECT doc_id, source, CAST(coalesce(n, 0) AS BIGINT) AS size, k FROM sized),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM docs GROUP BY source),
filled AS (
  SELECT *, CAST(2 * source_size AS DOUBLE) AS cap, 2 * source_size / CAST(w AS DOUBLE) AS full_at,
         (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(CAST(2 * source_size AS DOUBLE))
            OVER (ORDER BY 2 * source_size / CAST(w AS DOUBLE), source NULLS LAST
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(CAST(w AS DOUBLE)) OVER (ORDER BY 2 * source_size / CAST(w AS DOUBLE), source NULLS LAST
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl
  FROM sources),
leveled AS (
  SELECT *, max(CASE WHEN lvl < full_at THEN lvl END) OVER () AS top,
         min(CASE WHEN lvl < full_at THEN full_at END) OVER () AS first_open
  FROM filled),
targets AS (
  SELECT source, source_size,
         CASE WHEN full_at >= first_open THEN CAST(w AS DOUBLE) * top ELSE cap END AS target
  FROM leveled),
budgets AS (
  SELECT *, CAST(round(target) AS BIGINT) // nullif(source_size, 0) AS passes,
         CAST(round(target) AS BIGINT) % nullif(source_size, 0) AS rest FROM targets),
placed AS (
  SELECT d.*, b.source_size, b.target, coalesce(b.passes, 0) AS passes, coalesce(b.rest, 0) AS rest,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k) AS BIGINT) AS done
  FROM docs d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       CAST(passes * size + greatest(0, least(size, rest - (done - size))) AS BIGINT) AS taken
FROM placed
"""
