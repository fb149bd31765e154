from __future__ import annotations

import hashlib
import itertools
import random
from collections import defaultdict

import pytest
from odd_documents import documents, empty
from pyspark.sql import functions as F

from linetone.llm.sharding import minimax_shards, text_group, text_size


def least_capacity(sizes: list[int], shards: int) -> int:
    """By dynamic programming over all contiguous cuts."""
    ends = [0, *itertools.accumulate(sizes)]
    best = [0] + [10**18] * len(sizes)
    for _ in range(shards):
        best = [min(max(best[j], ends[i] - ends[j]) for j in range(i + 1)) for i in range(len(ends))]
    return best[-1]


def cut(spark, sizes: list[int], shards: int):
    rows = [(bytes([i // 250, i % 250]), s, i) for i, s in enumerate(sizes)]
    df = spark.createDataFrame(rows, "group binary, size long, doc_id long")
    return sorted(tuple(r) for r in minimax_shards(df, "size", "group", ["doc_id"], shards).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_capacity_is_the_least(spark, seed):
    picks = random.Random(seed)
    sizes = [picks.randint(1, 40) for _ in range(30)]
    found = cut(spark, sizes, 5)
    loads, slots = defaultdict(int), defaultdict(list)
    for _, size, _, shard, slot in found:
        loads[shard] += size
        slots[shard].append(slot)
    assert max(loads.values()) == least_capacity(sizes, 5)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert [r[3] for r in found] == sorted(r[3] for r in found)  # contiguous


def test_a_heavy_group_gets_a_shard_and_the_rest_stays_even(spark):
    found = cut(spark, [5] * 20 + [400] + [5] * 20, 5)
    loads = defaultdict(int)
    for _, size, _, shard, _ in found:
        loads[shard] += size
    assert sorted(loads.values()) == [50, 50, 50, 50, 400]


def laid_out(rows):
    """Shards as lists of atoms: whole groups, or rows of a group above the even share."""
    even = sum(s for _, s, *_ in rows) / 16
    sums = defaultdict(int)
    for text, size in rows:
        sums[text] += size
    order = sorted(sums, key=lambda t: hashlib.sha256(t.encode()).digest())
    sizes = {t: next(s for u, s in rows if u == t) for t in order}
    return [a for t in order for a in ([sums[t]] if sums[t] <= even else [sizes[t]] * (sums[t] // sizes[t]))], even


@pytest.mark.parametrize("hot", [0, 300])
def test_registered_query_has_the_least_capacity_over_atomic_groups(spark, tmp_path, hot):
    from linetone.llm.queries import op1_sharding

    picks = random.Random(hot)
    texts = [f"text {k} " * picks.randrange(1, 9) for k in range(120) for _ in range(picks.choice([1, 1, 1, 4]))]
    texts += ["copies of this"] * hot
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    found = op1_sharding(spark, str(tmp_path)).collect()
    atoms, even = laid_out([(t, len(t) + 1) for t in texts])
    loads, places = defaultdict(int), defaultdict(set)
    for r in found:
        loads[r["shard"]] += r["size"]
        places[texts[r["doc_id"]]].add(r["shard"])
    assert max(loads.values()) == least_capacity(atoms, 16)
    split = [t for t, shards in places.items() if len(shards) > 1]
    assert split == (["copies of this"] if hot else [])


def test_odd_documents(spark):
    df = documents(spark).select(
        "doc_id", text_size().alias("size"), text_group().alias("group"), "text", "_part", "_size", "shard"
    )
    found = minimax_shards(df, "size", "group", ["doc_id"], 4).collect()
    assert len(found) == df.count()
    places = defaultdict(set)
    for r in found:
        places[r["text"]].add(r["shard"])
        assert r["size"] == len((r["text"] or "").encode()) + 1
    even = sum(r["size"] for r in found) / 4
    for text, shards in places.items():
        assert len(shards) == 1 or sum(r["size"] for r in found if r["text"] == text) > even
    for shard in {r["shard"] for r in found}:
        slots = sorted(r["slot"] for r in found if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_empty(spark):
    df = empty(spark).select(F.lit(1).cast("long").alias("size"), text_group().alias("group"), "doc_id")
    assert minimax_shards(df, "size", "group", ["doc_id"]).count() == 0


def test_shards_of_a_table_with_a_third_of_copies_are_even(spark, tmp_path):
    from linetone.llm.queries import op1_sharding

    rows = [(i, "copy " * 10 if i % 3 == 0 else f"text {i} " * 5) for i in range(1200)]
    rows += [(7, "same row " * 5)] * 400 + [(9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    found = op1_sharding(spark, str(tmp_path)).collect()
    loads, slots = defaultdict(int), defaultdict(list)
    for r in found:
        loads[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert len(found) == len(rows) and len(loads) == 16
    assert max(loads.values()) - sum(loads.values()) / 16 <= max(r["size"] for r in found)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_a_fill_compiles_no_code_for_each_candidate(spark):
    """The driver compiles and keeps a job's code, so a job must not have an expression a candidate."""
    from linetone.llm import sharding

    ends = [3, 5, 6, 10, 11, 17, 20]
    rows = list(zip([0, *ends], ends))
    df = spark.createDataFrame(rows, "_start long, _end long").repartition(3)
    sizes = []

    class Seen:
        def __init__(self, df):
            self.df = df

        def __getattr__(self, name):
            found = getattr(self.df, name)
            if name == "collect":
                sizes.append(len(self.df._jdf.queryExecution().analyzed().toString()))
            return lambda *a: Seen(out) if hasattr(out := found(*a), "_jdf") else out

    few = sharding._fill(Seen(df), 0, 20, 4, [6])
    short, sizes[:] = max(sizes), []
    many = sharding._fill(Seen(df), 0, 20, 4, list(range(6, 20)))
    assert few == {6: [6, 11, 17, 20]} and many[6] == few[6]
    assert many[9] == [6, 11, 20] and many[10] == [10, 20] and many[19] == [17, 20]
    assert max(sizes) < short + 200


def jobs_of(spark, work):
    tracker, group = spark.sparkContext.statusTracker(), f"sharding-{random.random()}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        return work(), len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_a_search_takes_few_jobs_however_many_shards(spark):
    """Each job leaves its plan and its counts with the driver."""
    from linetone.llm import sharding

    picks = random.Random(5)
    sizes = [picks.randint(1, 900) for _ in range(400)]
    ends = list(itertools.accumulate(sizes))
    rows = list(zip([0, *ends], ends, strict=False))
    df = spark.createDataFrame(rows, "_start long, _end long").repartition(3)
    found, jobs = jobs_of(spark, lambda: sharding._least_cuts(df, 0, ends[-1], max(sizes), 16))
    assert max(b - a for a, b in itertools.pairwise([0, *found])) == least_capacity(sizes, 16)
    assert found[-1] == ends[-1] and len(found) <= 16
    assert jobs < 16


@pytest.mark.parametrize("near", [0, 4, 40])
def test_a_search_is_exact_however_few_ends_the_driver_looks_through(spark, monkeypatch, near):
    from linetone.llm import sharding

    picks = random.Random(near)
    sizes = [picks.choice([1, 2, 3, 250]) for _ in range(90)]
    ends = list(itertools.accumulate(sizes))
    df = spark.createDataFrame(list(zip([0, *ends], ends, strict=False)), "_start long, _end long").repartition(3)
    monkeypatch.setattr(sharding, "NEAR", near)
    monkeypatch.setattr(sharding, "CANDIDATES", 5)
    found = sharding._least_cuts(df, 0, ends[-1], max(sizes), 5)
    assert max(b - a for a, b in itertools.pairwise([0, *found])) == least_capacity(sizes, 5)
    assert found[-1] == ends[-1] and len(found) <= 5
