"""Documents with everything that goes wrong: nulls, empty and very long texts, ties, repeats."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, size string, _part int, "
    "_key int, _size int, _guess string, _kept long, _leak long, score string, shard string, copies int"
)

WORDS = {
    "en": "the of and to in that was with for this from they would there their what about which".split(),
    "de": "der die das und nicht mit eine auch werden haben einer durch über zwischen müssen".split(),
}


CLASHING = ("clash", 7, 7, 7, "clash", 7, 7, "clash", "clash", 7)


def prose(seed: int, words: int, lang: str = "en") -> str:
    picks = random.Random(seed)
    said = [picks.choice(WORDS[lang]) + picks.choice(["", "al", "en", "is"]) for _ in range(words)]
    return " ".join(said)


def rows() -> list[tuple]:
    base = [prose(i, 60 + i, "de" if i % 3 == 0 else "en") for i in range(24)]
    texts: list[tuple] = [(t, "de" if i % 3 == 0 else "en", f"s{i % 4}") for i, t in enumerate(base)]
    texts += [(base[0], "de", "s0")] * 6  # copies
    texts += [(base[1] + " end", "en", "s1"), ("start " + base[1], None, None)]
    texts += [(None, "en", "s2"), (None, None, None), ("", "en", "s2"), (" \n\t", None, "s3"), ("123 !?", "en", "s1"), ("½ ² 3_4", "en", "s1")]
    texts += [("x", "en", "s1"), (prose(99, 9000), "en", "s0"), ("a" * 5000, "en", "s3"), ("the " * 400, "en", "s3")]
    found = [(i, t, lang, source, 1, *CLASHING) for i, (t, lang, source) in enumerate(texts)]
    return [*found, found[3], found[3], (None, "no id here", "en", "s1", None, *[None] * len(CLASHING))]


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
