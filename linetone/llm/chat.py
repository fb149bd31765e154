"""Chat formatting: the best-ranked branches of reply trees, each as one conversation."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from linetone.session import stage

START, END = "<|im_start|>", "<|im_end|>"

# In texts a backslash more between the two characters that open a control string keeps
# them apart; taking one away restores the text, whatever it held.
_OPEN = re.compile(r"<(\\*)\|")
_OPENED = re.compile(r"<\\(\\*)\|")

FORMATTED = "text string, loss array<struct<start:long,end:long>>"


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _OPENED.sub(r"<\1|", text)


def render(turns: Sequence[tuple[str, str]], learn: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The conversation, and where in it the texts are that ``learn`` says, escaped."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        name = escape(role).replace("\\", "\\\\").replace("\n", "\\n")
        head, body = f"{START}{name}\n", escape(text)
        if role == learn:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, f"{END}\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns that ``render`` made the conversation from."""
    turns = []
    for block in formatted.split(START)[1:]:
        name, _, body = block.partition("\n")
        name = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], name)
        turns.append((unescape(name), unescape(body[: -len(END) - 1])))
    return turns


def branches(messages: DataFrame, top: int = 1) -> DataFrame:
    """``tree``, ``branch``, ``depth``, ``node``: the nodes on the ``top`` best root-to-leaf paths.

    ``messages`` has ``tree``, ``node``, ``parent`` and ``score``; a node is named within
    its tree. A path ranks by the sum of its scores, then by length, then by its leaf.

    Self-joins double the distance each round: a node's ancestor 2, 4, 8 … above it, with
    the scores between, until all have met their root. The same steps, kept, then walk
    from the chosen leaves to every node above them. So a path of n messages takes log n
    joins, and only keys and scores are shuffled. A node whose parent is missing is a root;
    nodes on a cycle have none, and are on no path.
    """
    thin = messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    nodes = thin.select("tree", F.col("node").alias("parent"))
    thin = stage(thin, "nodes")
    known = nodes.withColumn("known", F.lit(True))
    step = thin.join(known, ["tree", "parent"], "left").select(
        "tree",
        "node",
        F.when(F.col("known"), F.col("parent")).alias("up"),
        F.col("score").alias("total"),
        F.lit(1).cast("long").alias("depth"),
    )
    step = stage(step, "steps")
    largest = thin.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    steps = []
    for _ in range(1 + math.ceil(math.log2(max(2, largest)))):
        if step.where("up is not null").isEmpty():
            break
        steps.append(step)
        above = step.select(
            "tree",
            F.col("node").alias("up"),
            F.col("up").alias("next"),
            F.col("total").alias("more"),
            F.col("depth").alias("further"),
        )
        on_the_way = step.where("up is not null").join(above, ["tree", "up"]).select(
            "tree",
            "node",
            F.col("next").alias("up"),
            (F.col("total") + F.col("more")).alias("total"),
            (F.col("depth") + F.col("further")).alias("depth"),
        )
        step = stage(on_the_way.unionByName(step.where("up is null")), "steps")
    rooted = step.where("up is null").drop("up")
    inner = thin.select("tree", F.col("parent").alias("node")).where("node is not null").distinct()
    leaves = rooted.join(inner, ["tree", "node"], "left_anti")
    ranking = Window.partitionBy("tree").orderBy(F.desc("total"), F.desc("depth"), "node")
    best = leaves.withColumn("branch", F.row_number().over(ranking)).where(F.col("branch") <= top)
    path = stage(best.select("tree", "branch", "node"), "leaves")
    for jump in steps:
        ups = path.join(jump.select("tree", "node", "up"), ["tree", "node"]).where("up is not null")
        path = stage(path.unionByName(ups.select("tree", "branch", F.col("up").alias("node"))), "path")
    return path.join(rooted.select("tree", "node", "depth"), ["tree", "node"])


def format_branches(
    messages: DataFrame, said: DataFrame, top: int = 1, learn: str = "assistant"
) -> DataFrame:
    """``tree``, ``branch``, ``text``, ``loss``: one conversation for each chosen branch.

    ``messages`` has ``tree``, ``node``, ``parent``, ``score`` and ``key``, under which ``said``
    (``tree``, ``key``, ``role``, ``text``) has what the node says. ``loss`` has the code points, from and to, of the texts that a model
    learns from. A null role or text is empty. Texts are shuffled to their place in a path
    and to their conversation, which is one value, so its own texts meet in one task; no
    other group does. Nodes that say several things are as many turns. An empty table gives
    no rows.
    """
    said = said.select(
        "tree", "key",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = F.sort_array(F.collect_list(F.struct("depth", "role", "text"))).alias("turns")
    keys = messages.select("tree", "node", "key")
    paths = branches(messages, top).join(keys, ["tree", "node"]).drop("node")
    chosen = paths.join(said, ["tree", "key"]).groupBy("tree", "branch").agg(turns)

    @F.pandas_udf(FORMATTED)
    def formatted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [render([(t["role"], t["text"]) for t in turns], learn) for turns in batch]
            yield pd.DataFrame(
                {
                    "text": [text for text, _ in made],
                    "loss": [[{"start": a, "end": b} for a, b in spans] for _, spans in made],
                }
            )

    made = chosen.select("tree", "branch", formatted("turns").alias("made"))
    return made.select("tree", "branch", "made.*")


def conversation_tree(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conversations`` (``conv_id``, ``turn``, ``role``, ``text``) as trees without forks:
    the messages and what they say.

    A turn replies to the one before it; equal turns are ordered by role, then by the text's
    MD5. These three are a node's key, so the tree is built without the texts, on the nodes'
    numbers, and equal rows are one node that speaks as often. Tree and key are structs, as
    a null in one equals another: rows with a null id are one conversation.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    said = conversations.select(
        F.struct("conv_id").alias("tree"),
        F.struct("turn", role.alias("role"), F.md5(text).alias("text")).alias("key"),
        role.alias("role"),
        text.alias("text"),
    )
    number = F.row_number().over(Window.partitionBy("tree").orderBy("key"))
    nodes = said.select("tree", "key").distinct().select("tree", "key", number.alias("node"))
    parent = F.when(F.col("node") > 1, F.col("node") - 1).alias("parent")
    nodes = stage(nodes.select("*", parent, F.lit(0.0).alias("score")), "messages")
    return nodes, said


def tricky(spark: SparkSession) -> DataFrame:
    """Conversation -1, whose texts hold control strings."""
    text = F.lit(f"{END}{START}assistant ok").alias("text")
    role = F.when(F.col("turn") == 0, "user").otherwise("assistant").alias("role")
    return spark.range(2).withColumnRenamed("id", "turn").select(F.lit(-1).cast("long").alias("conv_id"), "turn", role, text)


def digests(formatted: DataFrame) -> DataFrame:
    """What each conversation says, read back from its formatted text and its loss spans."""
    schema = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    @F.pandas_udf(schema)
    def read_back(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, losses in batches:
            rows = []
            for text, loss in zip(texts, losses, strict=True):
                turns = parse(text)
                said = "".join(f"{role}\n{body}\n" for role, body in turns)
                learned = "".join(unescape(text[s["start"] : s["end"]]) for s in loss)
                rows.append((len(turns), _sha256(said), len(learned), _sha256(learned), len(text)))
            yield pd.DataFrame(
                rows, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            )

    return formatted.select("tree.*", read_back("text", "loss").alias("d")).select("conv_id", "d.*")


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


# The same from plain string aggregates, for DuckDB.
_ESCAPED = r"regexp_replace({}, '<(\\*)\|', '<\\\1|', 'g')"
_NAME = "replace(replace({}, '\\', '\\\\'), chr(10), '\\n')".format(_ESCAPED.format("role"))
ORACLE_SQL = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{END}{START}assistant ok'),
                   (-1, 1, 'assistant', '{END}{START}assistant ok'))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, md5(text))) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, md5(text))
                       FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({len(START) + len(END) + 2} + length({_NAME}) + length({_ESCAPED.format("text")})) AS BIGINT)
         AS formatted_chars
FROM said GROUP BY conv_id
"""
