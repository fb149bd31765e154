from __future__ import annotations

import hashlib

import numpy as np
import pytest
from odd_documents import documents, empty, prose

from linetone.llm import fingerprints
from linetone.llm.fingerprints import K, S, edited, fingerprint, fingerprint_documents, likeness


def test_anchors_are_closed_syncmers():
    text = prose(1, 50)
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    at, _ = fingerprints._anchors(points)
    inner = fingerprints._mers(points, S)
    expected = [
        i for i in range(len(text) - K + 1)
        if inner[i : i + K - S + 1].min() in (inner[i], inner[i + K - S])
    ]
    assert at.tolist() == expected
    assert len(at) > len(text) / (K - S + 1)


def plain_fingerprint(text: str) -> str:
    """With whole numbers and lists, from the definition."""
    cut = (1 << 64) - 1
    base, spread = int(fingerprints._BASE), int(fingerprints._MIX)

    def mixed(h):
        h = (h ^ (h >> 31)) * spread & cut
        return h ^ (h >> 29)

    def mer(points):
        h = 0
        for point in points:
            h = h * base + point & cut
        return mixed(h)

    if not text:
        return ""
    before = [0x110000 + i for i in range(K - 1)]
    points = [*before, *map(ord, text), *(p + K for p in before)]
    seen, first = {}, {}
    for i in range(len(points) - K + 1):
        inner = [mer(points[i + j : i + j + S]) for j in range(K - S + 1)]
        if min(inner) in (inner[0], inner[-1]):
            anchor = mer(points[i : i + K])
            nth = seen[anchor] = seen.get(anchor, -1) + 1
            first.setdefault(mixed(anchor + nth * base & cut) >> 32, i)
    if not first:
        return f"{mer(points) >> 32:08x}"
    chosen = sorted(first)[: fingerprints.ANCHORS]
    return "".join(f"{h:08x}" for h in sorted(chosen, key=first.get))


def plain_likeness(a: str, b: str) -> float:
    if a == b:
        return 1.0
    x, y = ([s[i : i + 8] for i in range(0, len(s), 8)] for s in (a, b))
    if not x or not y:
        return 0.0
    full = [max(s) for s in (x, y) if len(s) == fingerprints.ANCHORS]
    x, y = ([v for v in s if not full or v <= min(full)] for s in (x, y))
    longest = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i, v in enumerate(x):
        for j, w in enumerate(y):
            longest[i + 1][j + 1] = longest[i][j] + 1 if v == w else max(longest[i][j + 1], longest[i + 1][j])
    return 2 * longest[-1][-1] / (len(x) + len(y)) if x or y else 0.0


TEXTS = ["a", "ab", "same same same same same same", "a" * 300, "é\u20ac\U0001f600" * 40, "x y z", *(prose(i, 9 * i) for i in range(1, 25))]


def test_equal_to_plain_python():
    prints = [fingerprint(t) for t in TEXTS]
    assert prints == [plain_fingerprint(t) for t in TEXTS]
    prints += [fingerprint(edited(a, b)) for a, b in zip(TEXTS, TEXTS[1:])] + [""]  # noqa: B905
    for a in prints[::3]:
        for b in prints:
            assert likeness(a, b) == pytest.approx(plain_likeness(a, b))


def test_pieces_do_not_show(monkeypatch):
    text = prose(2, 3000)
    whole = fingerprint(text)
    monkeypatch.setattr(fingerprints, "PIECE", 1000)
    assert fingerprint(text) == whole


def test_likeness():
    a, b = prose(3, 400), prose(4, 400, "de")
    assert likeness(fingerprint(a), fingerprint(a)) == 1
    assert likeness(fingerprint(a), fingerprint(edited(a, b))) > 0.6
    assert likeness(fingerprint(a), fingerprint(b)) < 0.2
    assert likeness("", "") == 1 and likeness("", fingerprint(a)) == 0


@pytest.mark.parametrize("partitions", [1, 4])
def test_documents(spark, partitions):
    df = documents(spark).dropDuplicates(["doc_id"]).repartition(partitions)
    rows = sorted(((r["doc_id"], r["text"] or "") for r in df.collect()), key=lambda r: (r[0] is not None, r[0]))
    found = {r["doc_id"]: r for r in fingerprint_documents(df).collect()}
    assert len(found) == len(rows)
    for i, (doc, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        changed = edited(text, following)
        r = found[doc]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert r["fingerprint"] == fingerprint(text)
        assert r["edited_fingerprint"] == fingerprint(changed)
        assert r["near_next"] == likeness(fingerprint(text), fingerprint(following))
        assert 0 <= r["near_edited"] <= 1


def test_repeats_single_and_empty(spark):
    assert fingerprint_documents(documents(spark)).count() == documents(spark).count()
    assert fingerprint_documents(empty(spark)).count() == 0
    alone = fingerprint_documents(spark.createDataFrame([(5, "just one text")], "doc_id long, text string"))
    assert alone.first()["near_next"] == 1
