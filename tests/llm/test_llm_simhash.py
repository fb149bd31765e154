from __future__ import annotations

import random
import re

import pytest
import xxhash
from conftest import plan_of
from odd_documents import documents, empty
from pyspark.sql import functions as F

from linetone.llm import simhash as module
from linetone.llm.components import components
from linetone.llm.simhash import as_hex, near_duplicates, simhash, without_near_duplicates
from linetone.session import stage


def plain_simhash(text: str) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values: list[int], most: int = 4) -> dict[int, int]:
    """By comparing all pairs; label: index of the first member."""
    label = list(range(len(values)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= most:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return {i: root(i) for i in range(len(values))}


@pytest.mark.parametrize("text", ["", " \n", "One", "a B\tc\x0bd", "ÀÉ x y z Q", "the " * 50, "a b c d e f g"])
def test_fingerprint(text):
    assert simhash(text) == plain_simhash(text)


def test_chunks_do_not_show(monkeypatch):
    text = " ".join(map(str, range(3000)))
    monkeypatch.setattr(module, "CHUNK", 100)
    assert simhash(text) == plain_simhash(text)


@pytest.mark.parametrize("limit", [2, 48])
def test_links_have_the_components_of_all_pairs(spark, monkeypatch, limit):
    """With short lists only, and with nearly all lists too long for pairs."""
    monkeypatch.setattr(module, "LIST", limit)
    picks = random.Random(limit)
    values = []
    for _ in range(6):
        centre = picks.getrandbits(64)
        for _ in range(40):
            value = centre
            for _ in range(picks.randint(0, 7)):
                value ^= 1 << picks.randrange(64)
            values.append(value)
    values += [0, (1 << 64) - 1] + [picks.getrandbits(64) for _ in range(60)]
    values = list(dict.fromkeys(values))
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    links = module._links(spark.createDataFrame(signed, "fp long"))
    label = {r["node"]: r["label"] for r in components(links).collect()}
    expected = classes(values)
    groups: dict = {}
    for i, (v,) in enumerate(signed):
        groups.setdefault(expected[i], set()).add(label.get(v, v))
    assert all(len(g) == 1 for g in groups.values())
    assert len(set().union(*groups.values())) == len(groups)


def test_exploded_rows_are_not_broadcast(spark, monkeypatch):
    """Spark takes them for as small as the table they come from."""
    plans = []

    def staged(df, name):
        plans.append(plan_of(df))
        return stage(df, name)

    values = [(i * 0x9E3779B97F4A7C15 % (1 << 62) ^ bit,) for i in range(20) for bit in (0, 1, 2)]
    distinct = stage(spark.createDataFrame(values, "fp long"), "distinct")
    monkeypatch.setattr(module, "stage", staged)
    links = module._links(distinct)
    plans.append(plan_of(links))
    assert [plan.count("SortMergeJoin") for plan in plans] == [1, 2]
    assert len(links.collect()) >= 40
    assert not any("BroadcastHashJoin" in plan for plan in [*plans, plan_of(links)])


def test_chain_of_components(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 100), (7, 7)]
    found = dict(map(tuple, components(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert found == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}


def test_odd_documents(spark):
    odd = documents(spark)
    found = near_duplicates(odd).withColumn("hex", as_hex(F.col("fp"))).collect()
    rows = odd.collect()
    assert len(found) == len(rows)
    ordered = sorted({(r["doc_id"], r["text"]) for r in rows if r["doc_id"] is not None}, key=lambda r: r[0])
    prints = [plain_simhash(t) for _, t in ordered]
    label = classes(prints)
    expected = {d: (f"{prints[i]:016x}", ordered[label[i]][0]) for i, (d, _) in enumerate(ordered)}
    assert {r["doc_id"]: (r["hex"], r["component_id"]) for r in found if r["doc_id"] is not None} == expected
    kept = without_near_duplicates(odd)
    assert kept.columns == odd.columns
    ids = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert ids == sorted({c for _, c in expected.values()})
    assert near_duplicates(empty(spark)).count() == 0


def test_rows_of_one_id_in_different_groups(spark):
    a, b = "one two three four five six", "seven eight nine ten eleven"
    rows = [(3, b, 1), (5, a, 2), (5, b, 3), (5, a, 4), (7, a, 5), (8, b, 6), (9, "x", 7), (9, None, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row int")
    kept = without_near_duplicates(df).collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in kept) == [(3, b), (5, a), (9, ""), (9, "x")]
