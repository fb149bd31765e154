from __future__ import annotations

import hashlib
import random

from odd_documents import documents, empty, prose

from linetone.llm import substrings
from linetone.llm.substrings import LENGTH, without_repeats


def brute(rows: list[tuple]) -> dict:
    """One set of all strings seen so far, in the order of places."""
    seen, result = set(), {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        content = (text or "").encode()
        gone = bytearray(len(content))
        for at in range(len(content) - LENGTH + 1):
            string = content[at : at + LENGTH]
            if string in seen:
                gone[at : at + LENGTH] = b"\1" * LENGTH
            seen.add(string)
        kept = bytes(b for b, g in zip(content, gone, strict=True) if not g)
        runs = sum(1 for run in bytes(gone).split(b"\0") if run)
        result[doc] = (len(content), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return result


def found(df) -> dict:
    return {r["doc_id"]: tuple(r)[1:] for r in without_repeats(df).collect()}


def tricky_texts() -> list[str]:
    """Near copies, shared passages at all alignments, periods, and the lengths around a string."""
    picks = random.Random(3)
    base = prose(1, 400)
    texts = [base, base, base[:700] + "X" + base[700:], base[50:], "é" + base[3:900]]
    for i in range(30):
        words = base.split()
        for _ in range(picks.randint(0, 6)):
            words[picks.randrange(len(words))] = str(i)
        start = picks.randrange(200)
        texts.append(prose(100 + i, 10) + " " + " ".join(words[start : start + picks.randint(5, 200)]))
    line = "This very common line stands in every second document and is long enough to repeat as such. " * 2
    texts += [prose(200 + i, 20) + line[: 90 + i] + prose(300 + i, 20) for i in range(25)]
    texts += ["ab" * 300, "abc" * 300, "a" * 99, "a" * 100, "a" * 101, "a" * 350, "", "ß" * 120]
    picks.shuffle(texts)
    return texts


def test_against_brute_force(spark):
    rows = [(i * 7 - 40, t) for i, t in enumerate(tricky_texts())] + [(9999, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(df) == brute(rows)


def test_texts_in_several_pieces(spark, monkeypatch):
    """Anchors may be cut anywhere: the strings are what counts."""
    text = prose(5, 300)
    content = text.encode() + b"--" + text.encode()[300:]
    monkeypatch.setattr(substrings, "PIECE", 64)
    import numpy as np

    whole = np.frombuffer(content, np.uint8)
    starts = [
        (at + f, n) for at, piece in substrings._pieces(whole)
        for f, n in zip(*substrings._anchors(piece)[2:], strict=True)
    ]
    covered = [s for start, n in starts for s in range(start, start + n)]
    assert covered == list(range(len(content) - LENGTH + 1))


def test_long_text_in_pieces(spark):
    rows = [(1, prose(1, 120_000)), (2, prose(2, 50) + prose(1, 120_000)[200_000:600_300])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df) == brute(rows)


def test_odd_documents(spark):
    got = without_repeats(documents(spark)).collect()
    rows = [(r["doc_id"], r["text"]) for r in documents(spark).collect()]
    assert len(got) == len(rows)
    expected = brute(list({(d, t): None for d, t in rows}))
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == expected
    assert without_repeats(empty(spark)).count() == 0
