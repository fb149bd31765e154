from __future__ import annotations

import re
from collections import defaultdict

import pytest
from odd_documents import documents, empty

from linetone.llm.mixing import mix, mixed


def targets(sizes: dict, share: float, most: float, weights=(5, 2, 1)) -> dict:
    """Weights dealt by name, excess reshared until no source is above its limit."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, budget = {}, share * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in full]
        left = budget - sum(full.values())
        given = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        above = [s for s in open_ if given[s] >= most * sizes[s]]
        if not above:
            return full | given
        full |= {s: most * sizes[s] for s in above}
        if len(full) == len(names):
            return full


@pytest.mark.parametrize("share", [0.4, 1.5])
def test_targets_and_taken_words(spark, share):
    found = mix(documents(spark), share=share).collect()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in found:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
        assert 0 <= r["taken"] <= 2 * r["size"]
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert target == pytest.approx(targets(sizes, share, 2.0))
    for source, words in taken.items():
        # Repeated rows share a key: at the cut they may all count in part.
        assert words == pytest.approx(target[source], abs=70)


def test_reruns_agree_and_copies_follow(spark):
    keep = lambda df: sorted(map(str, df.select("doc_id", "taken", "copies").collect()))
    first = keep(mix(documents(spark)))
    assert first == keep(mix(documents(spark).repartition(1)))
    rows = mixed(documents(spark))
    assert rows.columns == documents(spark).columns
    copies = sum(r["copies"] for r in mix(documents(spark)).collect())
    assert rows.count() == copies


def test_empty_tables_and_sources(spark):
    assert mix(empty(spark)).count() == 0
    silent = documents(spark).where("text is null")
    assert {r["taken"] for r in mix(silent).collect()} == {0}


@pytest.mark.parametrize("equal", [3, 200])
def test_repeated_rows_at_the_cut_meet_the_target(spark, equal):
    rows = [(1, "w " * 10, s) for s in ("a", None) for _ in range(equal)] + [(2, "x " * 7, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    found = mix(df, weights=(1,), share=0.55).collect()
    assert all(0 <= r["taken"] <= r["size"] for r in found)
    for source in ("a", None):
        rows = [r for r in found if r["source"] == source]
        assert sum(r["taken"] for r in rows) == round(rows[0]["target"])
        assert abs(sum(r["copies"] * r["size"] for r in rows) - rows[0]["target"]) <= 10
