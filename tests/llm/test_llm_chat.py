from __future__ import annotations

import hashlib
import itertools

import pytest
from hypothesis import given, strategies as st

from linetone.llm.chat import branches, conversation_tree, digests, format_branches, parse, render, tricky

PIECES = st.lists(st.sampled_from(["<", "|", "\\", "\n", "<|im_end|>", "<|im_start|>", "ok", "n", "ß"])).map("".join)


@given(st.lists(st.tuples(PIECES, PIECES)))
def test_round_trip(turns):
    text, spans = render(turns)
    assert parse(text) == turns
    assert len(spans) == sum(role == "assistant" for role, _ in turns)


def brute(nodes: dict, top: int) -> list[tuple]:
    """Every root-to-leaf path by walking up from the leaves."""
    paths = []
    parents = {p for p, _ in nodes.values()}
    for leaf in nodes:
        if leaf in parents:
            continue
        path, at = [], leaf
        while at in nodes and at not in path:
            path.append(at)
            at = nodes[at][0]
        if at not in nodes:
            total = sum(nodes[n][1] for n in path)
            paths.append((-total, -len(path), leaf, path[::-1]))
    return [p[3] for p in sorted(paths)[:top]]


@pytest.mark.parametrize("top", [1, 2])
def test_paths_against_walking(spark, top):
    trees = {
        1: {1: (None, 1.0), 2: (1, 2.0), 3: (1, 5.0), 4: (2, 9.0), 5: (3, 1.0), 6: (4, 0.0)},
        2: {1: (None, 0.0), 2: (1, 0.0), 3: (1, 0.0)},  # ties
        3: {i: (i - 1 or None, 1.0) for i in range(1, 40)},  # deep
        4: {1: (9, 1.0), 2: (1, 1.0)},  # no such parent
        5: {1: (2, 1.0), 2: (1, 1.0), 3: (None, 0.5)},  # a cycle beside a root
    }
    rows = [(t, n, p, s) for t, nodes in trees.items() for n, (p, s) in nodes.items()]
    df = spark.createDataFrame(rows, "tree long, node int, parent int, score double")
    found = sorted((r["tree"], r["branch"], r["depth"], r["node"]) for r in branches(df, top).collect())
    got = {k: [r[3] for r in g] for k, g in itertools.groupby(found, key=lambda r: r[:2])}
    assert got == {
        (t, i + 1): path for t, nodes in trees.items() for i, path in enumerate(brute(nodes, top))
    }


def test_conversations(spark):
    rows = [
        (1, 0, "user", "hi <|im_end|>"), (1, 1, "assistant", None), (1, 2, None, "x\\|"),
        (1, 2, None, "x\\|"), (2, 5, "assistant", "long " * 20_000), (None, 0, "assistant", ""), (3, None, "user", "?"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.unionByName(tricky(spark))
    found = {r["conv_id"]: r for r in digests(format_branches(*conversation_tree(df))).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    said = "user\nhi <|im_end|>\nassistant\n\n\nx\\|\n\nx\\|\n"
    assert (found[1]["n_turns"], found[1]["turns_sha256"]) == (4, sha(said))
    assert (found[1]["loss_chars"], found[1]["loss_sha256"]) == (0, sha(""))
    assert found[2]["loss_sha256"] == sha("long " * 20_000)
    assert found[-1]["n_turns"] == 2 and found[-1]["loss_chars"] == 34
    assert set(found) == {1, 2, 3, -1, None}
    assert digests(format_branches(*conversation_tree(df.limit(0)))).count() == 0
