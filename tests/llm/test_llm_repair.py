from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from linetone.llm import repair as module
from linetone.llm.repair import FAULTS, INITIALS, SYMBOLS, SuffixAutomaton, damage, digest, plans, repaired

SCHEMA = "conv_id long, turn long, role string, text string, copies string, audit int, kind int, key string"


def cheapest(rows: list[tuple[str, str]]) -> tuple[int, str, list]:
    """Of all edits that the grammar allows, by (cost, audit); rows are (initial, fault).

    Insertions in one place beyond three cannot pay, as three reach any state.
    """
    best = {("", 0): (0, "")}  # what has been put out, as the grammar sees it, and insertions here
    shape = re.compile(r"(s?(ua)*u?)?$")

    def put(states, out, inserted, cost, audit):
        out = out.replace("uau", "u")
        if shape.match(out) and states.get((out, inserted), (1 << 30, "")) > (cost, audit):
            states[out, inserted] = (cost, audit)

    def insert(states):
        for inserted in range(3):
            for (out, k), (cost, audit) in list(states.items()):
                if k == inserted:
                    for role in "ua":
                        put(states, out + role, k + 1, cost + 3, audit + "I")
        return states

    for initial, fault in rows:
        after: dict = {}
        for (out, _), (cost, audit) in insert(best).items():
            put(after, out, 0, cost + 4, audit + "D")
            if fault in ("sound", "truncated"):
                cost += 3 * (fault == "truncated")
                put(after, out + initial, 0, cost, audit + "K")
                for role in "ua":
                    put(after, out + role, 0, cost + 3, audit + "R")
        best = after
    ends = [v for (out, _), v in insert(best).items() if re.fullmatch(r"(s?(ua)+)?", out)]
    return min(ends)


@pytest.mark.parametrize("length", [0, 1, 2, 3])
def test_cheapest_edits_of_all_short_signatures(length):
    signatures = sorted(("".join(s) for s in itertools.product(SYMBOLS, repeat=length)), key=lambda s: s[::-1])
    automaton = SuffixAutomaton()
    meaning = dict(zip(SYMBOLS, ((r, f) for f in FAULTS for r in INITIALS), strict=True))
    for signature in signatures if length < 3 else random.Random(1).sample(signatures, 400):
        audit, cost = automaton.audit(signature)
        assert (cost, audit) == cheapest([meaning[c] for c in signature]), signature


def test_long_signatures_in_any_order():
    picks = random.Random(5)
    automaton, meaning = SuffixAutomaton(), dict(zip(SYMBOLS, ((r, f) for f in FAULTS for r in INITIALS), strict=True))
    for _ in range(200):
        signature = "".join(picks.choice(SYMBOLS[:8] + "bbccc") for _ in range(picks.randrange(30)))
        audit, cost = automaton.audit(signature)
        assert (cost, audit) == cheapest([meaning[c] for c in signature])


def test_a_shared_suffix_is_worked_out_once(monkeypatch):
    automaton, steps = SuffixAutomaton(), []
    plain = SuffixAutomaton._step
    monkeypatch.setattr(SuffixAutomaton, "_step", lambda self, *key: steps.append(key) or plain(self, *key))
    for first in "abcd":
        automaton.audit(first + "bcbcbcbc")
    assert len(automaton._edits) == 10 and len(steps) <= 2 + 8 + 4


def plain(rows: list[tuple]) -> dict:
    """Everything for each conversation, in plain Python."""
    space = lambda v: " " if v is None else str(v)
    found: dict = defaultdict(list)
    for conversation, turn, role, text in rows:
        role, text = space(role), space(text)
        kind = zlib.crc32(f"{space(conversation)}:{space(turn)}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        row = (turn is not None, turn or 0, "user" if kind == 4 else role, text, turn)
        found[conversation] += [row] * {0: 0, 3: 2}.get(kind, 1)
    results = {}
    for conversation, turns in found.items():
        turns.sort(key=lambda r: (*r[:3], hashlib.md5(r[3].encode()).digest()))
        seen, faults = set(), []
        for _, _, role, text, _ in turns:
            bare = text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")
            fault = "sound" if bare[-1:] in tuple(".!?") else "truncated"
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else fault)
            seen.add((role, text))
        initials = [r[2][:1] for r in turns]
        cost, audit = cheapest([(i if i in ("s", "u", "a") else "o", f) for i, f in zip(initials, faults, strict=True)])
        known = [r[4] for r in turns if r[4] is not None]
        outs, at, odd = [], 0, len(audit.replace("D", "")) % 2
        for edit in audit:
            role, text = ("user", "assistant")[(len(outs) - odd) % 2], ""
            if edit != "I":
                role, text = turns[at][2] if edit == "K" else role, turns[at][3]
                at += 1
            if edit != "D":
                outs.append((edit, role, text))
        results[conversation] = (
            max(known) - min(known) + 1 - len(set(known)) if known else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),  # noqa: B905
            cost,
            audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in outs).encode()).hexdigest(),
            outs,
        )
    return results


def conversations(seed: int) -> list[tuple]:
    picks = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "Ünknown", "", None]
    texts = ["Yes.", "No!", "Why?", "half a", "", " \n\t", None, "ü.\x0b ", "a" * 4000, "one\ntwo.", ".", "x. y"]
    rows = []
    for conversation in [*range(40), None]:
        for turn in range(picks.randrange(1, 12)):
            at = None if picks.random() < 0.05 else turn + picks.randrange(2)
            rows.append((conversation, at, picks.choice(roles[: picks.choice([4, 9])]), picks.choice(texts)))
    # Repeated rows, a long conversation of a few texts and a conversation whose only row goes.
    rows += [rows[3]] * 50 + [(99, i // 2, ("user", "assistant")[i % 2], f"Turn {i % 700}.") for i in range(1500)]
    gone = next(i for i in range(1000, 2000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    return [*rows, (gone, 0, "user", "Gone.")]


def table(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, 2, "k") for r in rows], SCHEMA).repartition(5)


def test_odd_conversations(spark):
    rows = conversations(2)
    want = plain(rows)
    found = digest(table(spark, rows))
    assert found.columns == [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    ]
    found = found.collect()
    assert len(found) == len(want) == len({r[0] for r in rows})
    for row in found:
        assert tuple(row)[1:] == want[row["conv_id"]][:-1], row["conv_id"]
    gone = [r for r in found if r["audit"] == ""]
    assert gone and all(r["repaired_sha256"] == hashlib.sha256(b"").hexdigest() for r in gone)


def test_repaired_rows(spark, monkeypatch):
    monkeypatch.setattr(module, "HELD", 3)
    rows = conversations(3)
    want = plain(rows)
    damaged = damage(table(spark, rows))
    out: dict = defaultdict(list)
    for row in repaired(damaged, plans(damaged)).collect():
        out[row["conv_id"]].append((row["place"], row["edit"], row["role"], row["text"]))
    for conversation, result in want.items():
        assert sorted(out[conversation]) == [(i, *o) for i, o in enumerate(result[-1])]


def test_ids_of_text_and_turns_far_apart(spark):
    rows = [("a", -(1 << 63), "user", "Hi."), ("a", (1 << 63) - 1, "assistant", "Ho."), ("b", None, "user", "Hi.")]
    found = {r["conv_id"]: r for r in digest(spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")).collect()}
    assert found["a"]["gaps"] is None and found["b"]["gaps"] == 0


def test_empty_table(spark):
    assert digest(table(spark, []).limit(0)).count() == 0
