"""Benchmark decontamination by windows of template words, with checked slots.

DataFrame functions only: texts stay in the JVM and are never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from linetone.functions import ENGLISH
from linetone.session import stage

WINDOW = 5
COVERAGE = 0.8

# Items of fewer words than a window are one window. From this many words on they count
# wherever they stand; shorter ones only as a sentence of their own.
LOOSE = 3

# Bytes of window hashes up to which they are sent to every executor.
BROADCAST_BYTES = 64 << 20

# Bits of the sieve that spares most windows of documents their words, and the most hashes it
# is made of. It travels with the plan: 32 kB.
SIEVE_BITS, SIEVE_HASHES = 18, 1 << 17

TOKEN = r"[\p{L}\p{M}]+|\p{N}+(?:[.,:]\p{N}+)*"
MARKS = ".!?:\n"
MARK = r"[.!?:\n]"
NUMBER = r"^\p{N}"
NAME = r"^\p{Lu}[\p{Ll}\p{M}]+$"
NAMED = "<name>"

# A word with what is before it from the first mark on, or what is left of a text after a mark.
# Nothing is gone back over, so that no text takes longer than its length.
MARKED_TOKEN = (
    r"[.!?:\n][^\p{L}\p{M}\p{N}]*+(?:[\p{L}\p{M}]++|\p{N}++(?:[.,:]\p{N}++)*+|\z)"
    r"|[\p{L}\p{M}]++|\p{N}++(?:[.,:]\p{N}++)*+"
)
BEFORE = r"^[^\p{L}\p{M}\p{N}]+"
MARKED_NAME = r"(?<![\p{L}\p{M}\p{N}])\p{Lu}[\p{Ll}\p{M}]+$"

# Names of units, singular and plural.
UNITS = (
    "mm cm m km kg g mg t lb lbs oz l ml dl kmh mph s sec min h hr hrs "
    "millimeter millimeters centimeter centimeters meter meters kilometer kilometers "
    "metre metres kilometre kilometres gram grams kilogram kilograms ton tons tonne tonnes "
    "liter liters litre litres inch inches foot feet yard yards mile miles pound pounds "
    "ounce ounces gallon gallons second seconds minute minutes hour hours day days week weeks "
    "month months year years degree degrees percent dollar dollars cent cents euro euros"
).split()


def plain_windows(texts: DataFrame, key: str) -> DataFrame:
    """``key``, ``pos``, ``hash`` of each window of lower-cased words and numbers."""
    return readings(texts, key).where("words is null").select(key, "pos", "hash")


def _is_mark(token: Column) -> Column:
    return token.isin(*MARKS)


def _marked(token: Column) -> Column:
    """Whether a token of ``MARKED_TOKEN`` begins with a mark: no letter or digit is below these."""
    return (token < "A") & ((token < "0") | (token >= ":"))


def short_items(items: DataFrame) -> DataFrame:
    """``item_id``, ``pos``, ``hash``, ``words`` of items with fewer words than a window."""
    words = items.select(
        "item_id", F.regexp_extract_all(F.lower("text"), F.lit(TOKEN), F.lit(0)).alias("all")
    ).where(F.size("all").between(1, WINDOW - 1))
    hashed = (F.when(F.size("all") == n, _hash("all", F.lit(0), n)) for n in range(1, WINDOW))
    return words.select("item_id", F.lit(0).alias("pos"), F.coalesce(*hashed).alias("hash"), F.size("all").alias("words"))


def _hash(words: str, start: Column, length: int) -> Column:
    return F.xxhash64(*(F.get(words, start + k) for k in range(length)))


def short_windows(texts: DataFrame, key: str, lengths: list[int]) -> DataFrame:
    """``key``, ``pos``, ``hash`` of what may be a short item, for items of ``lengths`` words."""
    tokens = texts.select(
        key, F.regexp_extract_all(F.lower("text"), F.lit(f"{TOKEN}|{MARK}"), F.lit(0)).alias("tokens")
    )
    words = F.transform(
        "tokens",
        lambda t, i: F.struct(t.alias("word"), ((i == 0) | _is_mark(F.get("tokens", i - 1))).alias("opens")),
    )
    words = tokens.select(key, F.filter(words, lambda w: ~_is_mark(w["word"])).alias("all"))
    words = words.select(
        key,
        F.transform("all", lambda w: w["word"]).alias("word"),
        F.transform("all", lambda w: w["opens"]).alias("opens"),
    )

    def windows(length: int) -> Column:
        starts = F.coalesce(
            F.when(F.size("word") >= length, F.sequence(F.lit(0), F.size("word") - length)),
            F.array().cast("array<int>"),
        )
        if length < LOOSE:
            starts = F.filter(
                starts,
                lambda i: F.get("opens", i) & F.coalesce(F.get("opens", i + length), F.lit(True)),
            )
        return F.transform(starts, lambda i: F.struct(i.alias("pos"), _hash("word", i, length).alias("hash")))

    found = words.select(key, F.flatten(F.array(*map(windows, lengths))).alias("windows"))
    return found.select(key, F.explode_outer("windows").alias("w")).select(key, "w.*").where("hash is not null")


def sieved(hashes: DataFrame) -> Callable[[Column], Column] | None:
    """A condition on a hash that holds for all of ``hashes`` and for few others.

    None if there are too many to tell others from them.
    """
    if hashes.count() > SIEVE_HASHES:
        return None
    place = F.col("hash").bitwiseAND((1 << SIEVE_BITS) - 1).cast("int")
    bits = np.zeros(1 << SIEVE_BITS, np.uint8)
    bits[[r[0] for r in hashes.select(place).distinct().collect()]] = 1
    words = F.lit(np.packbits(bits, bitorder="little").view(np.int64))

    def maybe(value: Column) -> Column:
        at = value.bitwiseAND((1 << SIEVE_BITS) - 1).cast("int")
        return F.getbit(F.get(words, F.shiftright(at, 6)), at.bitwiseAND(63)) == 1

    return maybe


def _told_words(texts: DataFrame, key: str) -> DataFrame:
    """``key`` and, place by place, ``token``, ``word`` and ``kind`` of the words of a text.

    ``token`` is the word as it stands, with what is before it if that has a mark, ``word`` in
    lower case, ``kind`` its placeholder or else ``word``. ``opens`` has the windows' places.
    """
    tokens = texts.select(key, F.regexp_extract_all("text", F.lit(MARKED_TOKEN), F.lit(0)).alias("token"))

    def lowered(token: Column) -> Column:
        return F.lower(F.when(_marked(token), F.regexp_replace(token, BEFORE, "")).otherwise(token))

    def typed(token: Column, i: Column) -> Column:
        word, before = F.get("word", i), F.get("word", i - 1)
        unit = word.isin(UNITS) & (i > 0) & ~_marked(token) & before.rlike(NUMBER)
        opens = (i == 0) | _marked(token)
        # Nearly all tokens are told by their first letter, which spares them the patterns.
        return (
            F.when((token >= "a") & (token < "{"), F.when(unit, "<unit>").otherwise(word))
            .when(word.rlike(NUMBER), "<number>")
            .when(unit, "<unit>")
            .when(token.rlike(MARKED_NAME) & ~(word.isin(*ENGLISH) & opens), NAMED)
            .otherwise(word)
        )

    words = tokens.select(key, "token", F.transform("token", lowered).alias("word"))
    words = words.select(key, "token", "word", F.transform("token", typed).alias("kind"))
    # A last mark has no word after it.
    size = F.size("word") - F.when(F.get("word", F.size("word") - 1) == "", 1).otherwise(0)
    return words.withColumn("opens", F.when(size >= WINDOW, F.sequence(F.lit(0), size - WINDOW)))


def readings(
    texts: DataFrame,
    key: str,
    sieve: Callable[[Column], Column] | None = None,
    told: bool = False,
) -> DataFrame:
    """``key``, ``pos``, ``hash``, ``words`` of each reading of a window of five words.

    The plain reading, of lower-cased words and numbers, has null as ``words``. A window with
    a number, a unit after a number, or a capitalised word also has one with placeholders of
    their type. A capital at the start of a sentence may or may not be a name's, and the
    window's own first word may open its sentence in another host. So a window with such a
    word, stop words apart, has two readings with placeholders, one with these as words and
    one with all of them as names; the first may be without any. For both, ``words`` is the
    window without placeholders; ``told`` adds ``said``, the reading itself. Readings whose
    hash does not pass the ``sieve`` are left out before their words are put together.

    Windows are exploded by place, and read from the lists of their text in compiled code;
    lists of windows within the row would be made by interpreted functions.
    """
    places = ["pos", *(f"pos_{k}" for k in range(1, WINDOW))]

    def at(column: str) -> list[Column]:
        return [F.get(column, F.col(place)) for place in places]

    def sure() -> list[Column]:
        opens = [F.lit(True), *(_marked(token) for token in at("token")[1:])]
        return [
            F.when((kind == NAMED) & first, word).otherwise(kind)
            for kind, word, first in zip(at("kind"), at("word"), opens, strict=True)
        ]

    # The outer form: for the plain one Spark adds a filter that repeats the whole computation.
    lists = [key, "token", "word", "kind", *places]
    windows = _told_words(texts, key).withColumn("pos", F.explode_outer("opens")).where("pos is not null")
    # Sums are made once: those of an ANSI session are dearer than what they look up.
    windows = windows.select("*", *((F.col("pos") + k).alias(places[k]) for k in range(1, WINDOW)))
    windows = windows.select(
        *lists, F.xxhash64(*at("word")).alias("plain"), F.xxhash64(*at("kind")).alias("names")
    )
    typed = F.col("names") != F.col("plain")
    windows = windows.withColumn("sure", F.when(typed, F.xxhash64(*sure())))
    hashes = F.array(
        "plain",
        F.when(typed, F.col("names")),
        F.when(F.col("sure") != F.col("names"), F.col("sure")),
    )
    found = windows.select(*lists, F.posexplode_outer(hashes).alias("nth", "hash"))
    found = found.where("hash is not null")
    if sieve:
        found = found.where(sieve(F.col("hash")))
    own = F.when(F.col("nth") > 0, F.array(*at("word"))).alias("words")
    said = F.when(F.col("nth") == 1, F.array(*at("kind"))).when(F.col("nth") == 2, F.array(*sure()))
    return found.select(key, "pos", "hash", own, *([said.alias("said")] if told else []))


def typed_readings(
    texts: DataFrame,
    key: str,
    sieve: Callable[[Column], Column] | None = None,
    told: bool = False,
) -> DataFrame:
    """The :func:`readings` with placeholders."""
    return readings(texts, key, sieve, told).where("words is not null")


def typed_windows(texts: DataFrame, key: str) -> DataFrame:
    """``key``, ``pos``, ``hash``, ``places``, ``slots``, ``dense`` of each window that has a placeholder.

    The windows of :func:`typed_readings`. ``slots`` has what the placeholders stand for,
    ``places`` where in the window they are. A window of placeholders only has ``dense``
    true and null as ``hash``.
    """
    found = typed_readings(texts, key, told=True)
    every = F.array(*map(F.lit, range(WINDOW)))
    places = F.filter(every, lambda k: F.get("said", k) != F.get("words", k))
    found = found.withColumn("places", places).where(F.size("places") > 0)
    dense = F.size("places") == WINDOW
    slots = F.transform("places", lambda k: F.get("words", k))
    return found.select(
        key,
        "pos",
        F.when(~dense, F.col("hash")).alias("hash"),
        "places",
        slots.alias("slots"),
        dense.alias("dense"),
    )


def leaks(documents: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The pairs of ``doc_id`` and ``item_id`` where the document holds the benchmark item.

    ``windows`` is the item's number of five-word windows, ``matched`` how many of them the
    document has, ``coverage`` their share, ``kind`` how: ``verbatim`` if enough windows of
    plain words are shared, wherever they are; ``template`` if enough are shared once
    numbers, units and names are placeholders, and each of the item's values stands for
    one value in the document, either at one offset or over the whole document. A window of
    placeholders only says nothing of its item: ``template`` leaves it out of ``windows``
    and of ``matched``, whatever the number of other windows.

    Windows meet in a join on their hash, the items' side sent to all executors if its
    bytes allow it and shuffled otherwise. Case and punctuation don't count. An item of
    fewer than five words is one window, found verbatim only: with three or four words
    anywhere, with one or two where it is a sentence of its own. Items and documents
    without words, null and empty texts match nothing. Rows without an id are one document,
    or item. Repeated rows are one document. Empty tables give no rows. Only ``doc_id``,
    ``item_id`` and ``text`` are used.
    """
    items, documents = benchmark.select("item_id", "text"), documents.select("doc_id", "text")
    short = stage(short_items(items), "short_items")
    lengths = sorted(r["words"] for r in short.select("words").distinct().collect())  # four at most
    plain = plain_windows(items, "item_id").unionByName(short.drop("words"))
    plain = stage(plain, "item_windows")
    typed = stage(typed_windows(items, "item_id"), "item_templates")
    dense = typed.where("dense").select(F.col("item_id").alias("_item"), F.col("pos").alias("_pos")).distinct()
    columns = ["item_id", F.col("pos").alias("item_pos"), "hash"]
    none = F.lit(None).cast("array<string>")
    nowhere = F.lit(None).cast("array<int>")
    wanted = plain.select(*columns, none.alias("item_slots"), nowhere.alias("places")).unionByName(
        typed.where("hash is not null").select(*columns, F.col("slots").alias("item_slots"), "places")
    )
    same = F.col("item_id").eqNullSafe(F.col("_item")) & (F.col("item_pos") == F.col("_pos"))
    wanted = wanted.join(dense, same, "left").withColumn("counts", F.col("_pos").isNull()).drop("_item", "_pos")
    wanted = stage(wanted, "told_windows")
    total = wanted.groupBy(F.col("item_id").alias("_item")).agg(
        F.countDistinct("item_pos").alias("windows"),
        F.countDistinct(F.when(F.col("counts"), F.col("item_pos"))).alias("templates"),
    )
    wanted = wanted.join(total, F.col("item_id").eqNullSafe(F.col("_item"))).drop("_item")
    wanted = stage(wanted, "wanted")
    hashes = stage(wanted.select("hash").distinct(), "hashes")
    sieve = sieved(hashes)
    if hashes.count() * 8 <= BROADCAST_BYTES:
        hashes = F.broadcast(hashes)
    found = readings(documents, "doc_id", sieve).join(hashes, "hash", "left_semi")
    if lengths:
        whole = short_windows(documents, "doc_id", lengths).join(hashes, "hash", "left_semi")
        found = found.unionByName(whole.withColumn("words", none))
    found = stage(found, "found")
    # Equal readings have their placeholders at the same places. One without any is a plain
    # window's, and one of placeholders only has no hash among the items'.
    met = found.join(wanted, "hash").where(
        F.col("words").isNull() == F.col("item_slots").isNull()
    )
    met = met.withColumn("slots", F.transform("places", lambda k: F.get("words", k)))
    plain_at = F.when(F.col("slots").isNull(), F.col("item_pos"))
    zipped = F.arrays_zip(F.col("item_slots").alias("i"), F.col("slots").alias("d"))
    pair = ["doc_id", "item_id", "windows", "templates"]
    by_shift = met.groupBy(
        *pair, (F.col("pos") - F.col("item_pos")).alias("shift")
    ).agg(
        F.collect_set(plain_at).alias("plain"),
        F.collect_set(F.when(F.col("counts"), F.col("item_pos"))).alias("any"),
        F.array_distinct(F.flatten(F.collect_set(zipped))).alias("values"),
    )
    by_shift = by_shift.withColumn(
        "aligned", F.when(_consistent(F.col("values")), F.size("any")).otherwise(0)
    )
    by_pair = by_shift.groupBy(*pair).agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("plain")))).alias("plain"),
        F.size(F.array_distinct(F.flatten(F.collect_list("any")))).alias("any"),
        F.array_distinct(F.flatten(F.collect_list("values"))).alias("values"),
        F.max("aligned").alias("aligned"),
    )
    template = F.greatest("aligned", F.when(_consistent(F.col("values")), F.col("any")).otherwise(0))
    verbatim = F.col("plain") >= F.col("windows") * F.lit(coverage)
    matched = F.when(verbatim, F.col("plain")).otherwise(template).cast("long")
    windows = F.when(verbatim, F.col("windows")).otherwise(F.col("templates"))
    judged = by_pair.select(
        "doc_id",
        "item_id",
        windows.alias("windows"),
        matched.alias("matched"),
        F.try_divide(matched, windows).alias("coverage"),
        F.when(verbatim, "verbatim").otherwise("template").alias("kind"),
    )
    return judged.where((F.col("matched") > 0) & (F.col("matched") >= F.col("windows") * F.lit(coverage)))


def _consistent(values: Column) -> Column:
    """Whether no value of the item stands for two in the document."""
    return F.size(values) == F.size(F.array_distinct(F.transform(values, lambda v: v["i"])))


def without_leaks(
    documents: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE
) -> DataFrame:
    """The documents that hold no benchmark item, in the input's columns."""
    found = leaks(documents, benchmark, coverage).select(F.col("doc_id").alias("_leak")).distinct()
    found = stage(found, "leaks")
    return documents.join(found, documents["doc_id"].eqNullSafe(found["_leak"]), "left_anti")


# The same with windows compared as lists of words, for DuckDB.
_UNIT_LIST = ", ".join(f"'{u}'" for u in UNITS)
_TYPED = r"regexp_matches({}, '{}')"
_STOP_LIST = ", ".join("'" + word.replace("'", "''") + "'" for word in ENGLISH)
_ONLY_MARK = f"^{MARK}$"
_OPENS = f"(i = 1 OR {_TYPED.format('t[i - 1]', _ONLY_MARK)})"
ORACLE_SQL = rf"""
WITH texts AS (
  SELECT 'document' AS side, doc_id AS id, text FROM documents
  UNION ALL SELECT 'item', item_id, text FROM benchmark),
plain AS (
  SELECT side, id, w, unnest(range(greatest(len(w) - {WINDOW - 1}, 0))) AS pos
  FROM (SELECT side, id, regexp_extract_all(lower(text), '{TOKEN}') AS w FROM texts)),
marked AS (SELECT side, id, regexp_extract_all(text, '{TOKEN}|{MARK}') AS t FROM texts),
kinds AS (
  SELECT side, id, list_filter(list_transform(range(1, len(t) + 1), lambda i: struct_pack(
    word := lower(t[i]),
    opens := {_OPENS},
    kind := CASE WHEN {_TYPED.format('t[i]', NUMBER)} THEN '<number>'
                 WHEN i > 1 AND {_TYPED.format('t[i - 1]', NUMBER)}
                      AND list_contains([{_UNIT_LIST}], lower(t[i])) THEN '<unit>'
                 WHEN {_TYPED.format('t[i]', NAME)}
                      AND NOT ({_OPENS} AND list_contains([{_STOP_LIST}], lower(t[i]))) THEN '<name>'
                 ELSE lower(t[i]) END)),
    lambda s: NOT {_TYPED.format('s.word', _ONLY_MARK)}) AS w
  FROM marked),
typed AS (
  SELECT side, id, w[pos + 1:pos + {WINDOW}] AS w, pos
  FROM (SELECT side, id, w, unnest(range(greatest(len(w) - {WINDOW - 1}, 0))) AS pos FROM kinds)),
readings AS (
  SELECT side, id, pos, w, list_transform(w, lambda s: s.kind) AS win FROM typed
  UNION
  SELECT side, id, pos, w,
         list_transform(w, lambda s, i: CASE WHEN s.kind = '<name>' AND (i = 1 OR s.opens) THEN s.word ELSE s.kind END)
  FROM typed),
slotted AS (
  SELECT side, id, pos, win,
         list_transform(list_filter(w, lambda s, i: s.word <> win[i]), lambda s: s.word) AS slots
  FROM readings),
dense AS (
  SELECT DISTINCT id, pos FROM slotted WHERE side = 'item' AND len(slots) = {WINDOW}),
sentences AS (
  SELECT side, id, list_transform(w, lambda s: s.word) AS w, list_transform(w, lambda s: s.opens) AS o FROM kinds),
short AS (
  SELECT side, id, 0 AS pos, w AS win FROM sentences WHERE side = 'item' AND len(w) BETWEEN 1 AND {WINDOW - 1}),
pieces AS (
  SELECT side, id, w, o, n, unnest(range(greatest(len(w) - n + 1, 0))) AS pos
  FROM sentences, (SELECT DISTINCT len(win) AS n FROM short) WHERE side = 'document'),
windows AS (
  SELECT DISTINCT side, id, pos, w[pos + 1:pos + {WINDOW}] AS win, NULL::VARCHAR[] AS slots FROM plain
  UNION ALL
  SELECT DISTINCT side, id, pos, win, slots FROM slotted WHERE len(slots) BETWEEN 1 AND {WINDOW - 1}
  UNION ALL
  SELECT DISTINCT side, id, pos, win, NULL FROM short
  UNION ALL
  SELECT DISTINCT side, id, pos, w[pos + 1:pos + n], NULL FROM pieces
  WHERE n >= {LOOSE} OR (o[pos + 1] AND coalesce(o[pos + n + 1], true))),
told AS (
  SELECT w.*, NOT EXISTS (
    SELECT 1 FROM dense d WHERE d.id IS NOT DISTINCT FROM w.id AND d.pos = w.pos) AS counts
  FROM windows w WHERE side = 'item'),
totals AS (
  SELECT id, count(DISTINCT pos) AS windows, count(DISTINCT pos) FILTER (WHERE counts) AS templates
  FROM told GROUP BY id),
met AS (
  SELECT d.id AS doc_id, b.id AS item_id, b.pos, b.counts, d.pos - b.pos AS shift, d.slots, b.slots AS item_slots
  FROM windows d JOIN told b ON d.win = b.win AND (d.slots IS NULL) = (b.slots IS NULL)
  WHERE d.side = 'document'),
stands_for AS (
  SELECT DISTINCT doc_id, item_id, shift, unnest(item_slots) AS i, unnest(slots) AS d FROM met
  WHERE slots IS NOT NULL),
torn_shifts AS (
  SELECT doc_id, item_id, shift FROM stands_for
  GROUP BY ALL HAVING count(DISTINCT (i, d)) > count(DISTINCT i)),
torn_pairs AS (
  SELECT doc_id, item_id FROM stands_for
  GROUP BY ALL HAVING count(DISTINCT (i, d)) > count(DISTINCT i)),
shifts AS (
  SELECT doc_id, item_id, shift, count(DISTINCT pos) FILTER (WHERE counts) AS n FROM met GROUP BY ALL),
pairs AS (
  SELECT doc_id, item_id, count(DISTINCT pos) FILTER (WHERE slots IS NULL) AS plain_n,
         count(DISTINCT pos) FILTER (WHERE counts) AS any_n
  FROM met GROUP BY ALL),
best AS (
  SELECT p.doc_id, p.item_id, p.plain_n, t.windows, t.templates,
         greatest(coalesce((SELECT max(n) FROM shifts s ANTI JOIN torn_shifts USING (doc_id, item_id, shift)
                            WHERE s.doc_id = p.doc_id AND s.item_id IS NOT DISTINCT FROM p.item_id), 0),
                  CASE WHEN (p.doc_id, p.item_id) IN (SELECT (doc_id, item_id) FROM torn_pairs)
                       THEN 0 ELSE p.any_n END) AS template_n
  FROM pairs p JOIN totals t ON t.id IS NOT DISTINCT FROM p.item_id),
judged AS (
  SELECT doc_id, item_id, plain_n >= b.windows * {COVERAGE} AS verbatim,
         CASE WHEN verbatim THEN b.windows ELSE templates END AS windows,
         CASE WHEN verbatim THEN plain_n ELSE template_n END AS matched
  FROM best b)
SELECT doc_id, item_id, windows, matched, matched / windows AS coverage,
       CASE WHEN verbatim THEN 'verbatim' ELSE 'template' END AS kind
FROM judged WHERE matched > 0 AND matched >= windows * {COVERAGE}
"""
