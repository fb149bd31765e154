from __future__ import annotations

import re

import pytest
from conftest import plan_of
from odd_documents import documents, empty

import corpus_pipeline
from linetone.llm import components, decontamination, simhash
from linetone.llm.queries import ORACLE, QUERIES
from linetone.session import stage

FOLDER = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    numbers = sorted(int(k[2:].split("_")[0]) for k in QUERIES if k != "pipeline")
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_equal_to_sql(spark, key):
    import check

    connection = check.oracle_connection(FOLDER)
    assert check.compare(QUERIES[key](spark, FOLDER), connection, ORACLE[key]) is None


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, FOLDER)
        if name != "sharding":
            assert docs.columns == columns
        sizes.append(docs.count())
    kept = sizes[0] - sizes[1]
    assert kept < 0.05 * sizes[0]  # clean documents stay
    assert sizes[3] < sizes[2] < sizes[1]  # copies and leaks go
    assert sizes[5] == sizes[4] > sizes[3]  # sources are repeated, no row is lost
    assert docs.columns == ["doc_id", "size", "shard", "slot"]


@pytest.mark.parametrize("build", [documents, empty])
def test_odd_tables(spark, build):
    docs = build(spark)
    columns = docs.columns
    for name, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, FOLDER)
        if name != "sharding":
            assert docs.columns == columns
    assert (docs.count() > 0) == (build is documents)


def broadcast_exploded(plan: str) -> bool:
    """Whether a broadcast sends rows that an explode made."""
    top = None
    for line in plan.splitlines():
        depth = re.match("[ :+-]*", line).end()
        if top is not None and depth <= top:
            top = None
        if top is None and "BroadcastExchange" in line[depth:]:
            top = depth
        elif top is not None and line[depth:].startswith("Generate"):
            return True
    return False


def test_no_broadcast_of_exploded_rows(spark, monkeypatch):
    """Spark takes them for as small as the table they come from, and the driver would hold them."""
    plans = []

    def staged(df, name):
        plans.append((name, plan_of(df)))
        return stage(df, name)

    for module in (components, decontamination, simhash):
        monkeypatch.setattr(module, "stage", staged)
    docs = stage(documents(spark), "documents")
    for name, step in corpus_pipeline.STAGES[1:3]:
        docs = stage(step(spark, docs, FOLDER), "step")
    assert {"lists", "links", "marked", "found", "leaks"} <= {name for name, _ in plans}
    assert sum("Generate" in plan for _, plan in plans) >= 4
    assert [name for name, plan in plans if broadcast_exploded(plan)] == []
