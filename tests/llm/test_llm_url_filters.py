from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from check import compare
from linetone.llm.url_filters import DAMPING, ORACLE_SQL, RULES, host, host_links, judge, path, propagate

URLS = {
    "https://WWW.Example.com/en/x?q=/fr/": ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
    "http://m.example.com/en/1#top": ("m.example.com", "/en/1", "example.com/en/", "block"),
    "http://notexample.com/en/1": ("notexample.com", "/en/1", "com/", "allow"),
    "http://a.net/es/": ("a.net", "/es/", "net/es/", "block"),
    "http://a.net/ES/": ("a.net", "/ES/", None, "block"),
    "http://b.com": ("b.com", "", None, "allow"),
    "x://y://z/p": ("y:", "//z/p", None, "allow"),
    "http://É.org\n/p": ("É.org\n", "/p", None, "allow"),
    "://": ("", "", None, "allow"),
    "no address": ("", "", None, "allow"),
    "": ("", "", None, "allow"),
    None: ("", "", None, "allow"),
}


def test_rules(spark):
    rows = [(i, url, None) for i, url in enumerate(URLS)] + [(0, next(iter(URLS)), "<a href=")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: tuple(r)[1:5] for r in judge(pages.withColumn("rule", F.lit(1))).collect()}
    assert found == dict(enumerate(URLS.values()))
    assert judge(pages).count() == len(rows)
    assert judge(pages.limit(0)).count() == 0


def power_iteration(shares: dict, seeds: dict, rounds: int = 300) -> dict:
    rank = {h: (1 - DAMPING) * s for h, s in seeds.items()}
    for _ in range(rounds):
        then = {h: (1 - DAMPING) * s for h, s in seeds.items()}
        for (src, dst), share in shares.items():
            then[dst] = then.get(dst, 0) + DAMPING * share * rank.get(src, 0)
        rank = then
    return rank


def test_propagation(spark):
    shares = {("a", "b"): 2 / 3, ("a", "c"): 1 / 3, ("b", "c"): 1.0, ("c", "a"): 1.0, ("d", "c"): 1.0}
    seeds = {"a": 1.0, "d": 0.25}
    found = propagate(
        spark.createDataFrame([(*k, w) for k, w in shares.items()], "src string, dst string, share double"),
        spark.createDataFrame(list(seeds.items()), "host string, seed double"), DAMPING,
    )
    expected = {h: r for h, r in power_iteration(shares, seeds).items() if r}
    assert {r["host"]: r["rank"] for r in found.collect() if r["rank"]} == pytest.approx(expected, abs=1e-3)


def farm_pages(linkers):
    """Hosts that link to a blocked host only, and a popular one with a bad link among many."""
    rows = [("http://bad.net/es/1", "")]
    rows += [(f"http://farm{i}.org/", '<a href="http://bad.net/x">') for i in range(linkers)]
    rows += [("http://news.org/", '<a href="http://bad.net/">' + '<a href="http://ok.com/">' * 9)]
    rows += [(f"http://reader{i}.com/a", '<a href="http://news.org/1">') for i in range(5)]
    rows += [("http://FARM0.org/2", None), ("http://second.org/", '<a href="//farm0.org/"><a href="//Farm0.ORG">')]
    return [(i, *r) for i, r in enumerate(rows)]


@pytest.mark.parametrize("linkers", [1, 2, 5, 100])
def test_equal_linkers_are_blocked_however_many(spark, tmp_path, linkers):
    rows = farm_pages(linkers)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = judge(pages)
    verdicts = {r["host"]: r["verdict"] for r in found.collect()}
    assert {verdicts[f"farm{i}.org"] for i in range(linkers)} == {"block"}
    assert verdicts["news.org"] == verdicts["reader0.com"] == "allow"
    pages.write.parquet(f"{tmp_path}/pages")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages/*.parquet')")
    assert compare(found.drop("trust", "distrust"), connection, ORACLE_SQL) is None


def test_distrust_runs_against_links(spark):
    spam = '<a HREF = "http://bad.net/es/1">x</a><img src=//Bad.net/fr/2><a href="/local">y</a>'
    rows = [
        (1, "http://bad.net/es/1", ""), (2, "http://farm.org/1", spam), (3, "http://farm.org/2", spam),
        (4, "http://good.com/1", '<a href="https://friend.org/">'), (5, "http://friend.org/", spam),
        (6, "http://lone.org/", ""),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted(map(tuple, host_links(pages).collect())) == [
        ("farm.org", "bad.net", 4.0), ("friend.org", "bad.net", 2.0), ("good.com", "friend.org", 1.0),
    ]
    found = {r["page_id"]: r for r in judge(pages).collect()}
    assert [found[i]["verdict"] for i in range(1, 7)] == ["block", "block", "block", "allow", "allow", "allow"]
    assert found[5]["trust"] == pytest.approx(found[5]["distrust"]) and found[5]["trust"] > 0
    assert found[6]["distrust"] == 0


def test_columns_are_native(spark):
    assert len(RULES) == 5
    df = spark.createDataFrame([("http://A.b/c?d",)], "url string")
    assert tuple(df.select(host(F.col("url")), path(F.col("url"))).first()) == ("a.b", "/c")
