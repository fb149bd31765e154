"""URL filters: rules on host and path, and for the rest trust and distrust along links.

DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from linetone.session import stage

# Verdict, host and path of a rule.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

DAMPING = 0.85

# Ranks are settled when no host's moves by more than this in a round. A round leaves DAMPING of
# what is still to move, so that many rounds do at most.
SETTLED = 1e-6

# A host is blocked if it has more distrust than trust, and this share at least of what a host
# has that links to blocked hosts only.
LEAST_DISTRUST = 0.5

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ADDRESS = r"(?s)://([^/?#]*)([^?#]*)"
LINK = r"""(?i)\b(?:href|src)\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""


def host(url: Column) -> Column:
    found = F.coalesce(F.regexp_extract(url, ADDRESS, 1), F.lit(""))
    return F.translate(found, UPPER, UPPER.lower())


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, ADDRESS, 2), F.lit(""))


def ruling(rules: Sequence[tuple[str, str, str]], name: Column, below: Column) -> Column:
    """The longest rule that fits, as a struct of ``rule`` and ``verdict``; null if none fits.

    A rule fits its host and all subdomains, if the path starts with the rule's. Of rules
    of equal length the one with the longer host wins. Rules are few: one branch each.
    """
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, at, under in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r)):
        fits = ((name == at) | name.endswith(f".{at}")) & below.startswith(under)
        value = F.struct(F.lit(at + under).alias("rule"), F.lit(verdict).alias("verdict"))
        chosen = F.when(fits, value).otherwise(chosen)
    return chosen


def host_links(pages: DataFrame) -> DataFrame:
    """``src``, ``dst``, ``weight``: how many links pages of one host have to another."""
    target = F.explode_outer(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)))
    links = pages.select(host(F.col("url")).alias("src"), target.alias("dst"))
    links = links.withColumn("dst", F.translate("dst", UPPER, UPPER.lower()))
    return (
        links.where((F.col("src") != F.col("dst")) & (F.col("src") != "") & F.col("dst").isNotNull())
        .groupBy("src", "dst")
        .agg(F.count("*").cast("double").alias("weight"))
    )


def propagate(shares: DataFrame, seeds: DataFrame, damping: float) -> DataFrame:
    """``host``, ``rank`` from ``seeds`` (``host``, ``seed``): each round a host passes the part
    ``share`` of its rank from ``src`` to ``dst``, damped, until no rank moves by ``SETTLED``.

    Each round is one join and one sum by host, written out with the rank before it. Sums are
    rounded, so that their order doesn't show.
    """
    own = seeds.select("host", (F.col("seed") * (1 - damping)).alias("rank"))
    if shares.isEmpty():
        return own
    ranks = stage(own, "ranks")
    while True:
        passed = shares.join(ranks, shares["src"] == ranks["host"]).select(
            F.col("dst").alias("host"), (F.col("share") * F.col("rank") * damping).alias("rank")
        )
        now = own.unionByName(passed).withColumn("before", F.lit(0.0))
        then = ranks.select("host", F.lit(0.0).alias("rank"), F.col("rank").alias("before"))
        sums = now.unionByName(then).groupBy("host").agg(
            F.round(F.sum("rank"), 12).alias("rank"), F.sum("before").alias("before")
        )
        sums = stage(sums, "ranks")
        moved = sums.agg(F.max(F.abs(F.col("rank") - F.col("before")))).first()[0]
        ranks = sums.select("host", "rank")
        if moved is None or moved < SETTLED:
            return ranks


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    damping: float = DAMPING,
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``trust``, ``distrust``.

    A page that a rule fits takes its verdict. The others take their host's: ruled pages
    are seeds, a host's seed being the share of its pages that are allowed or blocked.
    Trust follows the links from allowed seeds, split over a host's links. Distrust goes against
    them, from blocked seeds to the hosts that link there, by the share of the linking host's
    own links: a host whose links mostly lead to blocked hosts is blocked, however many others
    link there, and one bad link among many does little. A host with more distrust than trust,
    and no little of it, is blocked, any other allowed.

    A null address, or one without ``://``, has host and path empty, and no links or seeds
    count for it: it is allowed. Null pages have no links. Repeated rows are judged alike.
    An empty table gives no rows. Only ``page_id``, ``url`` and ``html`` are used.
    """
    url = F.col("url")
    named = pages.select("page_id", host(url).alias("host"), path(url).alias("path"))
    judged = named.withColumn("ruling", ruling(rules, F.col("host"), F.col("path"))).select(
        "page_id", "host", "path", "ruling.*"
    )
    judged = stage(judged, "judged")
    share = lambda verdict: F.avg((F.coalesce("verdict", F.lit("")) == verdict).cast("double"))
    hosts = judged.where("host <> ''").groupBy("host").agg(
        share("allow").alias("allowed"), share("block").alias("blocked")
    )
    hosts = stage(hosts, "hosts")
    links = stage(host_links(pages), "links")
    out = links.groupBy("src").agg(F.sum("weight").alias("out"))
    shares = links.join(out, "src").select("src", "dst", (F.col("weight") / F.col("out")).alias("share"))
    shares = stage(shares, "shares")
    back = shares.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "share")
    seeds = lambda name: hosts.where(F.col(name) > 0).select("host", F.col(name).alias("seed"))
    trust = propagate(shares, seeds("allowed"), damping).withColumnRenamed("rank", "trust")
    distrust = propagate(back, seeds("blocked"), damping).withColumnRenamed("rank", "distrust")
    scored = hosts.select("host").join(trust, "host", "left").join(distrust, "host", "left")
    scored = scored.fillna(0.0, ["trust", "distrust"])
    least = LEAST_DISTRUST * damping * (1 - damping)
    # To five places, which the rounds settle.
    more, enough = F.round(F.col("distrust") - F.col("trust"), 5), F.round(F.col("distrust") - least, 5)
    blocked = (more > 0) & (enough >= 0)
    scored = stage(scored.withColumn("spread", F.when(blocked, "block").otherwise("allow")), "scored")
    return judged.join(scored, "host", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("verdict", "spread", F.lit("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )


_RULE_ROWS = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)


def _ranks(name: str, seed: str, src: str, dst: str) -> str:
    """SQL for a power iteration of more rounds than are needed."""
    return f"""
{name}(k, host, rank) AS (
  SELECT 0, host, {seed} * {1 - DAMPING} FROM hosts
  UNION ALL
  SELECT any_value(n.k) + 1, h.host,
         any_value(h.{seed}) * {1 - DAMPING} + coalesce(sum(s.share * t.rank * {DAMPING}), 0)
  FROM hosts h CROSS JOIN (SELECT DISTINCT k FROM {name}) n
  LEFT JOIN shares s ON s.{dst} = h.host
  LEFT JOIN {name} t ON t.host = s.{src}
  WHERE n.k < 80 GROUP BY h.host)"""


ORACLE_SQL = f"""
WITH RECURSIVE split AS (
  SELECT page_id, html,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1, 's'), ''),
                   '{UPPER}', '{UPPER.lower()}') AS host,
         coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
  FROM pages),
rules(verdict, site, start) AS (VALUES {_RULE_ROWS}),
fitting AS (
  SELECT s.*, r.verdict, r.site || r.start AS rule,
         row_number() OVER (PARTITION BY s.page_id
                            ORDER BY length(r.site || r.start) DESC, length(r.site) DESC) AS nth
  FROM split s LEFT JOIN rules r
    ON (s.host = r.site OR ends_with(s.host, '.' || r.site)) AND starts_with(s.path, r.start)),
ruled AS (SELECT page_id, host, path, rule, verdict FROM fitting WHERE nth = 1),
links AS (
  SELECT host AS src, dst, count(*) AS weight
  FROM (SELECT host, translate(unnest(regexp_extract_all(html, '{LINK.replace("'", "''")}', 1)),
                               '{UPPER}', '{UPPER.lower()}') AS dst FROM split)
  WHERE host <> dst AND host <> '' GROUP BY ALL),
shares AS (SELECT src, dst, weight / sum(weight) OVER (PARTITION BY src) AS share FROM links),
hosts AS (
  SELECT host, avg((coalesce(verdict, '') = 'allow')::INT) AS allowed,
         avg((coalesce(verdict, '') = 'block')::INT) AS blocked
  FROM (SELECT host, verdict FROM ruled WHERE host <> ''
        UNION ALL
        (SELECT DISTINCT dst, NULL FROM links WHERE dst NOT IN (SELECT host FROM ruled)))
  GROUP BY host),
{_ranks("trust", "allowed", "src", "dst")},
{_ranks("distrust", "blocked", "dst", "src")}
SELECT r.page_id, r.host, r.path, r.rule,
       coalesce(r.verdict, CASE WHEN round(d.rank - t.rank, 5) > 0
                                 AND round(d.rank - {LEAST_DISTRUST * DAMPING * (1 - DAMPING)}, 5) >= 0
                                THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled r
LEFT JOIN (SELECT host, rank FROM trust WHERE k = 80) t ON r.host = t.host
LEFT JOIN (SELECT host, rank FROM distrust WHERE k = 80) d ON r.host = d.host
"""
