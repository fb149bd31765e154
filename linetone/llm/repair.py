"""Repair of conversations: cheapest edits, found once per shared suffix of role and fault signatures."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from linetone.session import stage

# What counts as blank, and the marks that may end a turn.
BLANK = " \t\n\x0b\x0c\r"
ENDS = ".!?"

# A symbol per turn: the fault and the initial of the role, "o" for any other.
FAULTS = ("sound", "truncated", "blank", "duplicate")
INITIALS = "suao"
SYMBOLS = "abcdefghijklmnop"

# Costs of the edits; a truncated row that stays costs TRUNCATED more.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

# What has been put out so far: nothing, a system turn, a user turn, an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {
    START: {"s": SYSTEM, "u": USER},
    SYSTEM: {"u": USER},
    USER: {"a": ASSISTANT},
    ASSISTANT: {"u": USER},
}
ACCEPTING = (START, ASSISTANT)
NEVER = 1 << 30

# Rows that a task puts together before it passes them on.
HELD = 1000

# An edit and the state after it, for each state.
Edits = tuple[tuple[str, int], ...]


def _settled(costs: list[int], edits: list[tuple[str, int]]) -> tuple[int, tuple[int, ...], Edits]:
    """With insertions before what ``costs`` stand for: least cost, costs above it, edits.

    Of equally cheap edits the ASCII-least counts; no two edits of a state have one initial.
    """
    for _ in range(3):  # a chain of insertions visits no state twice
        for state, ways in NEXT.items():
            target = next(t for role, t in ways.items() if role != "s")
            way = (costs[target] + INSERT, ("I", target))
            costs[state], edits[state] = min((costs[state], edits[state]), way)
    least = min(costs)
    return least, tuple(c - least for c in costs), tuple(edits)


class SuffixAutomaton:
    """Cost-to-go of suffixes of signatures, for signatures that come in order of their reversal.

    A node is a suffix; suffixes that two signatures share are next to each other in that order,
    so the nodes of the latest signature are all that is held, and a node is worked out once.
    Nodes whose costs differ by a constant act alike and share one entry of ``_steps``.
    """

    def __init__(self) -> None:
        costs = [0 if s in ACCEPTING else NEVER for s in NEXT]
        least, above, edits = _settled(costs, [("", s) for s in NEXT])
        self._total, self._above, self._edits = [least], [above], [edits]
        self._steps: dict[tuple[tuple[int, ...], str], tuple[int, tuple[int, ...], Edits]] = {}
        self._last = ""

    def _step(self, above: tuple[int, ...], symbol: str) -> tuple[int, tuple[int, ...], Edits]:
        fault, initial = divmod(SYMBOLS.index(symbol), len(INITIALS))
        initial = INITIALS[initial]
        costs, edits = [], []
        for state, ways in NEXT.items():
            found = [(above[state] + DELETE, ("D", state))]
            if FAULTS[fault] in ("sound", "truncated"):
                extra = TRUNCATED if FAULTS[fault] == "truncated" else 0
                for role, target in ways.items():
                    if role == initial:
                        found.append((above[target] + extra, ("K", target)))
                    elif role != "s":
                        found.append((above[target] + extra + REROLE, ("R", target)))
            cost, edit = min(found)
            costs.append(cost)
            edits.append(edit)
        return _settled(costs, edits)

    def audit(self, signature: str) -> tuple[str, int]:
        """The cheapest edits' initials, and their cost."""
        backwards = signature[::-1]
        shared = 0
        for old, new in zip(self._last, backwards):  # noqa: B905
            if old != new:
                break
            shared += 1
        for held in (self._total, self._above, self._edits):
            del held[shared + 1 :]
        for symbol in backwards[shared:]:
            key = (self._above[-1], symbol)
            found = self._steps.get(key)
            if found is None:
                found = self._steps[key] = self._step(*key)
            self._total.append(self._total[-1] + found[0])
            self._above.append(found[1])
            self._edits.append(found[2])
        self._last = backwards
        edits, state, at = [], START, len(signature)
        while True:
            edit, state = self._edits[at][state]
            if not edit:
                return "".join(edits), self._total[-1] + self._above[-1][START]
            edits.append(edit)
            at -= edit != "I"


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` and ``copies`` of damaged rows.

    Nulls become one space. By the CRC-32 of id and turn, of twenty rows one is dropped (no
    copies), one loses its text, one its end marks, one is repeated and one is the user's.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", space("conv_id"), space("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(space("text"), ENDS, "")).otherwise(space("text"))
    return conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(space("role")).alias("role"),
        text.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def _filled(rows: DataFrame) -> DataFrame:
    """Null roles and texts as one space."""
    return rows.withColumns({c: F.coalesce(c, F.lit(" ")) for c in ("role", "text")})


def _symbol(fault: Column, role: Column) -> Column:
    place = F.lit(1)
    for i, name in enumerate(FAULTS):
        place = place + F.when(fault == name, i * len(INITIALS)).otherwise(0)
    initial = F.substring(role, 1, 1)
    rest = len(INITIALS) - 1
    for i, letter in enumerate(INITIALS[:-1]):
        place = place + F.when(initial == letter, i).otherwise(0)
    other = ~initial.isin(list(INITIALS[:-1]))
    return F.substring(F.lit(SYMBOLS), place + F.when(other, rest).otherwise(0), F.lit(1))


def _text_key() -> Column:
    return F.unhex(F.md5(F.encode("text", "UTF-8")))


def signatures(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``signature`` (a symbol per row in order) and ``gaps`` of each conversation.

    ``rows``: ``conv_id``, ``turn``, ``role``, ``text``, ``copies``. Order is by turn, nulls
    first, then role and MD5 of the text. Texts stay where they are, and no task gets more of a
    conversation than a range of the ordered rows: ranges give pieces, a piece per range and
    conversation is put together. Rows equal throughout are counted first.
    """
    rows = _filled(rows)
    there = F.col("copies") > 0
    bare = F.rtrim("text", F.lit(BLANK))
    narrow = rows.select(
        "conv_id",
        F.when(there, F.col("turn")).alias("turn"),
        F.when(there, F.col("role")).alias("role"),
        F.when(there, _text_key()).alias("key"),
        F.when(there, bare == "").alias("blank"),
        F.when(there, ~F.right(bare, F.lit(1)).isin(list(ENDS))).alias("truncated"),
        F.col("copies").cast("long").alias("copies"),
    )
    by = ["conv_id", "turn", "role", "key", "blank", "truncated"]
    counted = stage(narrow.groupBy(*by).agg(F.sum("copies").alias("copies")), "turns")
    place = F.struct(F.col("turn").isNotNull(), "turn")
    firsts = counted.where(there).groupBy("conv_id", "role", "key").agg(F.min(place).alias("first"))
    firsts = firsts.select(
        F.col("conv_id").alias("_c"),
        F.col("role").alias("_r"),
        F.col("key").alias("_k"),
        F.col("first.turn").alias("_first"),
    )
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("key") == F.col("_k"))
    joined = counted.join(firsts, same, "left")
    own = F.when(F.col("blank"), "blank").when(F.col("truncated"), "truncated").otherwise("sound")
    later = F.when(F.col("blank"), "blank").otherwise("duplicate")
    head = F.when(F.col("turn").eqNullSafe(F.col("_first")), own).otherwise(later)
    piece = F.concat(
        _symbol(head, F.col("role")),
        F.repeat(_symbol(later, F.col("role")), (F.col("copies") - 1).cast("int")),
    )
    order = ["conv_id", "turn", "role", "key"]
    ranged = joined.select(*order, F.when(there, piece).otherwise("").alias("piece"))
    ranged = ranged.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    ranged = stage(ranged, "ranged")
    inner = F.array_sort(F.collect_list(F.struct(F.col("turn").isNotNull().alias("known"), "turn", "role", "key", "piece")))
    pieces = ranged.groupBy("conv_id", "part").agg(
        F.array_join(F.transform(inner, lambda r: r["piece"]), "").alias("piece"),
        F.min("turn").alias("low"),
        F.max("turn").alias("high"),
        F.size(F.collect_set("turn")).cast("long").alias("turns"),
    )
    whole = pieces.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("part", "piece", "low", "high", "turns"))).alias("pieces"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.sum("turns").alias("turns"),
    )
    timed = F.filter("pieces", lambda p: p["turns"] > 0)
    whole = whole.withColumn("timed", timed)
    twice = F.filter("timed", lambda p, i: (i > 0) & (p["low"] == F.get("timed", i - 1)["high"]))
    wide = F.col("high").cast("decimal(38,0)") - F.col("low") + 1 - F.col("turns") + F.size(twice)
    gaps = F.when(F.col("low").isNull(), F.lit(0).cast("long")).otherwise(wide.try_cast("long"))
    signature = F.array_join(F.transform("pieces", lambda p: p["piece"]), "")
    return whole.select("conv_id", signature.alias("signature"), gaps.alias("gaps"))


def audits(found: DataFrame) -> DataFrame:
    """``signature``, ``audit`` and ``cost`` of each distinct ``signature``.

    Signatures are laid out by their reversal, so that those with a common suffix meet in a task.
    """

    def worked_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = SuffixAutomaton()
        for batch in batches:
            results = [automaton.audit(s) for s in batch["signature"]]
            audit, cost = zip(*results, strict=True) if results else ((), ())
            yield pd.DataFrame({"signature": batch["signature"], "audit": audit, "cost": cost})

    distinct = found.select("signature").distinct().withColumn("_back", F.reverse("signature"))
    laid = distinct.repartitionByRange("_back").sortWithinPartitions("_back").select("signature")
    return laid.mapInPandas(worked_out, "signature string, audit string, cost long")


def plans(rows: DataFrame) -> DataFrame:
    """One row per conversation: ``gaps``, counts of faults, ``illegal``, ``cost`` and ``audit``."""
    found = stage(signatures(rows), "signatures")
    best = stage(audits(found), "audits").withColumnRenamed("signature", "_signature")
    joined = found.join(best, F.col("signature") == F.col("_signature"))
    of = lambda fault: _class(lambda f, _: f == fault)
    count = lambda pattern: F.regexp_count("signature", F.lit(pattern)).cast("long")
    by_role = [_class(lambda _, r, role=role: r == role) for role in INITIALS[:-1]]
    s, u, a = by_role
    legal = count(f"{s}(?={u})|{u}(?={a})|{a}(?={u})")
    return joined.select(
        "conv_id",
        "gaps",
        *(count(of(fault)).alias(fault) for fault in ("blank", "duplicate", "truncated")),
        (F.greatest(F.length("signature") - 1, F.lit(0)) - legal).cast("long").alias("illegal"),
        "cost",
        "audit",
    )


def _class(test) -> str:
    """The character class of symbols with a fault and role."""
    pairs = ((f, r) for f in FAULTS for r in INITIALS)
    return "[" + "".join(c for c, pair in zip(SYMBOLS, pairs, strict=True) if test(*pair)) + "]"


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, bool, str, bytes, bytes]]:
    """``(conversation, starts, edit, role, text)`` of every row that is put out, in order.

    A conversation's audit comes before its rows. An item without an edit tells that a
    conversation starts. Holds a batch and an audit at a time.
    """
    audit, at, out, odd, conversation = "", 0, 0, 0, None

    def inserts():
        nonlocal at, out
        while at < len(audit) and audit[at] == "I":
            yield conversation, False, "I", b"user" if (out - odd) % 2 == 0 else b"assistant", b""
            at, out = at + 1, out + 1

    for batch in batches:
        ids = batch.column("conv_id").to_pylist()
        kinds = batch.column("kind").to_pylist()
        copies = batch.column("copies").to_pylist()
        roles = batch.column("role").cast(pa.binary())
        texts = batch.column("text").cast(pa.binary())
        for i, kind in enumerate(kinds):
            text = texts[i].as_py()
            if kind == 0:
                audit, at, out, conversation = text.decode(), 0, 0, ids[i]
                odd = (len(audit) - audit.count("D")) % 2
                yield conversation, True, "", b"", b""
                yield from inserts()
                continue
            for _ in range(copies[i]):
                edit = audit[at]
                at += 1
                if edit != "D":
                    role = roles[i].as_py()
                    if edit == "R":
                        role = b"user" if (out - odd) % 2 == 0 else b"assistant"
                    out += 1
                    yield conversation, False, edit, role, text
                yield from inserts()


def _in_order(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's audit, then its rows, in one partition."""
    parts = ["conv_id", "kind", "turn", "role", "key", "copies", "text"]
    said = _filled(rows).where("copies > 0").withColumns({"kind": F.lit(1), "key": _text_key()})
    heads = found.select(
        "conv_id",
        F.lit(0).alias("kind"),
        F.lit(None).cast("long").alias("turn"),
        F.lit("").alias("role"),
        F.lit(b"").alias("key"),
        F.lit(1).alias("copies"),
        F.col("audit").alias("text"),
    )
    together = said.select(*parts).unionByName(heads).repartition("conv_id")
    return together.sortWithinPartitions("conv_id", "kind", F.asc_nulls_first("turn"), "role", "key")


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired rows: ``conv_id``, ``place`` (from 0), ``edit``, ``role``, ``text``."""
    id_type = rows.schema["conv_id"].dataType
    types = [to_arrow_type(id_type), pa.int64(), pa.string(), pa.binary(), pa.binary()]

    def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        held, place = [], 0
        for conversation, starts, edit, role, text in _edited(batches):
            place = 0 if starts else place
            if edit:
                held.append((conversation, place, edit, role, text))
                place += 1
            if len(held) >= HELD:
                yield _records(held, names, types)
                held = []
        yield _records(held, names, types)

    names = ["conv_id", "place", "edit", "role", "text"]
    schema = f"conv_id {id_type.simpleString()}, place long, edit string, role binary, text binary"
    out = _in_order(rows, found).mapInArrow(edited, schema)
    return out.withColumns({c: F.col(c).cast("string") for c in ("role", "text")})


def _records(held: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*held, strict=True) if held else [[]] * len(names)
    arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names)


def repaired_hashes(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``conv_id`` and the SHA-256 of its repaired ``role:text``, joined by newlines.

    A hash needs the whole conversation in order, so its rows go to one task, which streams
    them: it holds a batch of rows and the audit, however long the conversation.
    """
    id_type = rows.schema["conv_id"].dataType
    names, types = ["conv_id", "repaired_sha256"], [to_arrow_type(id_type), pa.string()]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple[object, str]] = []
        current, digest, between = None, None, b""
        for conversation, starts, _, role, text in _edited(batches):
            if starts:
                if digest is not None:
                    done.append((current, digest.hexdigest()))
                if len(done) >= HELD:
                    yield _records(done, names, types)
                    done = []
                current, digest, between = conversation, hashlib.sha256(), b""
            else:
                digest.update(between + role + b":")
                digest.update(text)
                between = b"\n"
        if digest is not None:
            done.append((current, digest.hexdigest()))
        yield _records(done, names, types)

    schema = f"conv_id {id_type.simpleString()}, repaired_sha256 string"
    return _in_order(rows, found).mapInArrow(hashed, schema)


def digest(conversations: DataFrame) -> DataFrame:
    """Damage, faults, cheapest repair and hash of the repaired turns, a row per conversation.

    Null ids are one conversation, null roles and texts one space. Conversations without rows
    after the damage have zeros, no edits and the hash of nothing. Rows equal in turn are
    ordered by role and MD5 of the text; repeated rows are duplicates. Gaps beyond a long are
    null. Other columns are not used. An empty table gives no rows.
    """
    rows = damage(conversations)
    found = stage(plans(rows), "plans")
    hashes = repaired_hashes(rows, found).withColumnRenamed("conv_id", "_id")
    return found.join(hashes, F.col("conv_id").eqNullSafe(F.col("_id"))).drop("_id")


def _grown(state: str, cost: int | str, edit: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': '{edit}' || {state}.a}}"


def _taken(initial: str) -> str:
    """SQL for keeping the row as one with ``initial``, or giving it the role."""
    target = {"s": "system", "u": "user_", "a": "assistant_"}[initial]
    rerole = "" if initial == "s" else f"WHEN stays THEN {_grown(target, f'{REROLE} + extra', 'R')}"
    keep = f"WHEN stays AND initial = '{initial}' THEN {_grown(target, 'extra', 'K')}"
    return f"CASE {keep} {rerole} ELSE {{'c': {NEVER}, 'a': ''}} END"


_RAW = ", ".join(
    f"least({_grown(state, DELETE, 'D')}, {', '.join(map(_taken, initials))}) AS raw_{state}"
    for state, initials in {"nothing": "su", "system": "u", "user_": "a", "assistant_": "u"}.items()
)
_FIRST_USER = f"{_grown('raw_user_', INSERT, 'I')}, {_grown('raw_assistant_', 2 * INSERT, 'II')}"

# Written the plain way: audits as strings, carried back from each conversation's end.
ORACLE_SQL = f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(
      list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':'
                                  || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: ord(x)),
      lambda c, b: list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)),
      4294967295), 4294967295) % 20 AS kind
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM keyed),
placed AS (
  SELECT *, substr(role, 1, 1) AS initial,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i
  FROM damaged),
faulty AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1
                 THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated'
                 ELSE 'sound' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial IN ('su', 'ua', 'au') AS legal
  FROM placed),
counts AS (
  SELECT c.conv_id, count(f.i) AS n,
    CASE WHEN max(turn) IS NULL THEN 0
         ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank,
    count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE i > 1 AND NOT legal) AS illegal
  FROM (SELECT DISTINCT conv_id FROM conversations) c
  LEFT JOIN faulty f ON c.conv_id IS NOT DISTINCT FROM f.conv_id
  GROUP BY c.conv_id),
costs AS (
  SELECT conv_id, n AS left_over, {{'c': 0, 'a': ''}} AS nothing,
    {{'c': {2 * INSERT}, 'a': 'II'}} AS system, {{'c': {INSERT}, 'a': 'I'}} AS user_,
    {{'c': 0, 'a': ''}} AS assistant_
  FROM counts
  UNION ALL
  SELECT conv_id, left_over, least(raw_nothing, {_FIRST_USER}), least(raw_system, {_FIRST_USER}),
    least(raw_user_, {_grown("raw_assistant_", INSERT, "I")}),
    least(raw_assistant_, {_grown("raw_user_", INSERT, "I")})
  FROM (
    SELECT conv_id, left_over - 1 AS left_over, {_RAW}
    FROM (SELECT c.*, initial, fault IN ('sound', 'truncated') AS stays,
            CASE fault WHEN 'truncated' THEN {TRUNCATED} ELSE 0 END AS extra
          FROM costs c JOIN faulty f
            ON c.conv_id IS NOT DISTINCT FROM f.conv_id AND c.left_over = f.i))),
best AS (SELECT conv_id, nothing.a AS audit, nothing.c AS cost FROM costs WHERE left_over = 0),
edits AS (
  SELECT conv_id, nth, edit, out,
    sum(CAST(edit <> 'I' AS INTEGER)) OVER (PARTITION BY conv_id ORDER BY nth) AS i,
    sum(CAST(edit <> 'D' AS INTEGER)) OVER (PARTITION BY conv_id ORDER BY nth) - out % 2 AS place
  FROM (SELECT conv_id, unnest(range(length(audit))) AS nth, unnest(string_split(audit, '')) AS edit,
          length(replace(audit, 'D', '')) AS out
        FROM best WHERE audit <> '')),
repaired AS (
  SELECT e.conv_id, string_agg(
      CASE WHEN edit = 'K' THEN role WHEN place % 2 = 1 THEN 'user' ELSE 'assistant' END
      || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY nth) AS said
  FROM edits e JOIN faulty f ON e.conv_id IS NOT DISTINCT FROM f.conv_id AND greatest(e.i, 1) = f.i
  WHERE edit <> 'D' GROUP BY e.conv_id)
SELECT c.conv_id, CAST(gaps AS BIGINT) AS gaps, blank, duplicate, truncated, illegal,
  CAST(cost AS BIGINT) AS cost, audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM counts c JOIN best b ON c.conv_id IS NOT DISTINCT FROM b.conv_id
LEFT JOIN repaired r ON c.conv_id IS NOT DISTINCT FROM r.conv_id"""
