from __future__ import annotations

import hashlib
import math
import re

import pytest
import zstandard
from odd_documents import documents, empty, prose
from pyspark.sql import functions as F

from linetone.llm import language as module
from linetone.llm.language import Classifier, held_out, identify, letters


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [
        (i, prose(i, 8 + 3 * i, lang), lang)
        for i in range(120)
        for lang in [("en", "de")[i % 2]]
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_accuracy(corpus):
    found = identify(corpus, corpus.where(~held_out())).where(held_out())
    wrong = found.where("lang <> lang_pred").count()
    assert found.count() > 15 and wrong == 0
    assert found.where("score < 0 or score > 1").count() == 0


def test_training_columns_are_not_read_in_prediction(corpus):
    hidden = corpus.withColumns({"lang": F.lit("de"), "doc_id": F.col("doc_id") + 1000})
    seen = identify(corpus, corpus).select("text", "lang_pred", "score")
    assert identify(hidden, corpus).select("text", "lang_pred", "score").exceptAll(seen).count() == 0


def test_pieces_cover_whole_texts():
    model = Classifier({"a": letters(prose(1, 900)), "b": letters(prose(2, 900, "de"))})
    long_text = prose(3, 3000) + " " + prose(4, 9000, "de")
    assert model.predict(long_text)[0] == "b"
    assert model.predict(prose(3, 3000))[0] == "a"


def test_odd_documents(spark, corpus):
    found = identify(documents(spark), corpus)
    assert found.count() == documents(spark).count()
    for r in found.collect():
        silent = not any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == silent
        assert not silent or (r["score"] == 0 and r["rejected"])
    assert identify(empty(spark), corpus).count() == 0
    unlearned = identify(documents(spark), empty(spark))
    assert {r["lang_pred"] for r in unlearned.collect()} == {"und"}


FINNISH = "ja on ei se että oli mutta kun niin hän olla tämä kuin myös sitten vain nyt jos mikä talo".split()


def test_languages_of_short_or_long_texts_only_are_learned(spark):
    rows = [(i, prose(i, 80), "en") for i in range(50)]
    finnish = [" ".join(FINNISH[(i * k + k) % len(FINNISH)] for k in range(1, 13)) for i in range(200)]
    assert max(len(t.encode()) for t in finnish) < module.SHORTEST
    rows += [(1000 + i, t, "fi") for i, t in enumerate(finnish)]
    rows += [(2000 + i, prose(i, 3000, "de"), "de") for i in range(5)]
    corpus = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = identify(corpus, corpus).collect()
    assert {(r["lang"], r["lang_pred"]) for r in found} == {("en", "en"), ("fi", "fi"), ("de", "de")}


def test_a_language_of_a_few_letters(spark):
    corpus = spark.createDataFrame(
        [(1, "ab", "xx"), (2, "12 3", "yy"), (3, "", "zz"), (None, prose(1, 70), "en")],
        "doc_id long, text string, lang string",
    )
    assert set(module.learn(corpus)) == {"xx", "en"}
    assert [r["lang_pred"] for r in identify(corpus, corpus).orderBy("doc_id").collect()][0] == "en"


def plain_predictions(rows, labelled):
    """The same sample rule and compression in plain Python."""
    clean = lambda t: re.sub(r"[\W\d_]+", " ", t.lower()).strip().encode()
    kinds: dict = {}
    for text, lang in labelled:
        if text is not None and lang is not None:
            size = len(text.encode())
            kind = 1 if size > module.LONGEST else 2 if size < module.SHORTEST else 0
            kinds.setdefault(lang, ({}, {}, {}))[kind][hashlib.md5(text.encode()).hexdigest()] = text
    learned = {}
    for lang, (suitable, long, short) in kinds.items():
        picked = [t for _, t in sorted(suitable.items())][: module.SAMPLE]
        if len(suitable) < module.SAMPLE:
            for key, text in sorted(long.items())[: module.SAMPLE]:
                at = int(key[8:16], 16) % (max(0, len(text) - module.LONGEST) + 1)
                picked.append(text[at : at + module.LONGEST])
            picked += [t for _, t in sorted(short.items())][: module.SHORT_SAMPLE]
        content = b" ".join(c for c in map(clean, picked) if c)[: module.DICTIONARY]
        if content:
            cut = len(content) - min(module.LEAD, len(content) // 4)
            learned[lang] = content[:cut], content[cut:] + b" "
    options = zstandard.ZstdCompressionParameters.from_level(module.LEVEL, write_checksum=0, write_content_size=0)
    results = []
    for text in rows:
        if not any(c.isalpha() for c in text or ""):
            results.append(("und", 0.0))
            continue
        sizes = {}
        for lang, (content, lead) in learned.items():
            raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            pack = zstandard.ZstdCompressor(dict_data=raw, compression_params=options).compress
            said = clean(text)
            pieces = [said[i : i + module.PIECE] for i in range(0, len(said), module.PIECE)]
            sizes[lang] = sum(len(pack(lead + p)) - len(pack(lead)) for p in pieces)
        (best, lang), (second, _) = sorted((s, lang) for lang, s in sizes.items())[:2]
        results.append((lang, 1 - math.exp(-(second - best) / max(1, second) / module.SCALE)))
    return results


def test_equal_to_plain_python(spark):
    odd = documents(spark)
    found = sorted(((r["text"], r["lang_pred"], r["score"]) for r in identify(odd, odd).collect()), key=repr)
    rows = [(r["text"], r["lang"]) for r in odd.collect()]
    want = plain_predictions([t for t, _ in rows], rows)
    want = sorted(((t, *w) for (t, _), w in zip(rows, want, strict=True)), key=repr)
    assert [f[:2] for f in found] == [w[:2] for w in want]
    assert [f[2] for f in found] == pytest.approx([w[2] for w in want])
