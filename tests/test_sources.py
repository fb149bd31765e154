from __future__ import annotations

import random

import pytest
from conftest import plan_of, rows

from linetone.operators import bag_of_words, coverage_counts, titles_with_text, titles_without_text
from linetone import session
from linetone.functions import title_file_key, title_text_path
from linetone.session import stage, workspace
from linetone.sources import (
    list_text_files,
    model_path,
    read_catalogue,
    read_labelled_phrases,
    read_line_files,
    read_subtitles,
    split_cues,
    split_lines,
    title_names,
)

ODD_TITLES = [
    "Plain (1995)",
    "A, The (1995)",
    "[x] Brackets {y}",
    "100% Pure",
    "What?",
    "C++ a+b",
    "Face/Off",
    "Amélie #1 & co",
    "Stars * and 'quotes'",
]


@pytest.fixture
def texts(tmp_path):
    for title in ODD_TITLES:
        path = tmp_path / f"{title.replace('/', '')}.en.srt"
        path.write_text(f"line of {title}\n\nlast line", encoding="utf-8")
    (tmp_path / "notes.txt").write_text("not a subtitle")
    return str(tmp_path)


@pytest.fixture
def titles(spark):
    named = list(enumerate([*ODD_TITLES, "No text", None, "Plain (1995)"], start=1))
    return spark.createDataFrame(named, "movieId long, title string")


def test_file_names_of_odd_titles(spark, texts, titles):
    found = read_subtitles(spark, texts, titles)
    expected = [(i, f"line of {t}") for i, t in enumerate(ODD_TITLES, 1)]
    expected.append((len(ODD_TITLES) + 3, "line of Plain (1995)"))
    assert rows(found.where("Phrase LIKE 'line of%'")) == sorted(expected, key=repr)
    assert found.count() == 3 * len(expected)


def test_hot_file_is_split_when_titles_are_not_broadcast(spark, tmp_path):
    rng = random.Random(3)
    for i in range(20):
        lines = [f"{rng.getrandbits(200):x}" for _ in range(40_000 if i == 7 else 1_000)]
        (tmp_path / f"t{i}.en.srt").write_text("\n".join(lines))
    titles = spark.createDataFrame([(i, f"t{i}") for i in range(20)], "movieId long, title string")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k",
        "spark.sql.files.maxPartitionBytes": "512k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        unique = bag_of_words(read_subtitles(spark, str(tmp_path), titles), ["movieId"])
        per_title = unique.groupBy("movieId").count()
        assert per_title.agg({"count": "sum"}).first()[0] == 59_000
        per_title.collect()
        assert "SortMergeJoin(skew=true)" in plan_of(per_title)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_coverage(spark, texts, titles):
    keyed = titles.withColumn("file_key", title_file_key(titles["title"]))
    files = list_text_files(spark, texts)
    assert files.count() == len(ODD_TITLES)
    missing = titles_without_text(keyed, files, "file_key")
    assert rows(missing, "movieId") == [(10,), (11,)]
    assert titles_with_text(keyed, files, "file_key").count() == len(ODD_TITLES) + 1
    assert coverage_counts(keyed, files, "file_key").first().asDict() == {
        "found": len(ODD_TITLES) + 1,
        "missing": 2,
    }


def test_repeated_keys_do_not_multiply_titles(spark, titles):
    hot = spark.createDataFrame([(1,)] * 500 + [(2,), (None,)], "movieId long")
    assert titles_with_text(titles, hot, "movieId").count() == 2
    assert tuple(coverage_counts(titles, hot, "movieId").first()) == (2, 10)


def test_listing_reads_no_content(spark, texts):
    assert "ReadSchema: struct<path:string>" in plan_of(list_text_files(spark, texts))


def test_text_path(spark, titles):
    found = titles.select(title_text_path("subs/", titles["title"]).alias("p"))
    paths = [r["p"] for r in found.collect()]
    assert paths[0] == "subs/Plain (1995).en.srt"
    assert paths[6] == "subs/FaceOff.en.srt"
    assert paths[10] is None


def test_line_endings_and_empty_file(spark, tmp_path):
    (tmp_path / "a.en.srt").write_bytes(b"one\r\ntwo\r\n\r\nthree")
    (tmp_path / "b.en.srt").write_bytes(b"")
    lines = read_line_files(spark, str(tmp_path))
    assert rows(lines) == [("a.en.srt", t) for t in ("", "one", "three", "two")]
    whole = read_line_files(spark, str(tmp_path), whole=True)
    assert ("a.en.srt", "one\r\ntwo\r\n\r\nthree") in rows(whole)


def test_no_files_at_all(spark, tmp_path, titles):
    assert list_text_files(spark, str(tmp_path)).count() == 0
    assert read_subtitles(spark, str(tmp_path), titles).count() == 0
    assert read_subtitles(spark, str(tmp_path), titles, whole=True).count() == 0


def test_cues(spark):
    text = (
        "1\r\n00:00:14,482 --> 00:00:19,696\r\nOne line\r\nand another\r\n\r\n"
        "2\r\n00:00:20,000 --> 00:00:21,000 X1:5\r\n \r\n\r\n"
        "no cue\n\n12\n1:02:03.4 --> 1:02:05.6\nlast\n"
    )
    df = spark.createDataFrame([(1, text), (2, ""), (3, None)], "movieId long, Phrase string")
    assert rows(split_cues(df)) == [
        (1, 1, "00:00:14,482", "00:00:19,696", "One line\r\nand another"),
        (1, 12, "1:02:03.4", "1:02:05.6", "last"),
        (1, 2, "00:00:20,000", "00:00:21,000", ""),
    ]


def test_split_lines(spark):
    df = spark.createDataFrame([(1, "a\n\nb"), (2, ""), (3, None)], "movieId long, text string")
    assert rows(split_lines(df)) == [(1, 0, "a"), (1, 1, ""), (1, 2, "b"), (2, 0, "")]


def test_catalogue(spark, tmp_path):
    path = tmp_path / "movies.csv"
    path.write_text(
        "movieId,title,genres\n"
        '3,"A, The (1995)",Drama|War\n'
        '2,"""Quoted"" One (1998)",Comedy\n'
        "9999999999,Long id,Drama\n"
        "x,Bad id,Drama\n"
        "1,,Drama\n"
    )
    titles, rejects = read_catalogue(spark, str(path))
    assert rows(titles, "movieId", "title") == [
        (1, None),
        (2, '"Quoted" One (1998)'),
        (3, "A, The (1995)"),
        (9999999999, "Long id"),
    ]
    assert rows(rejects, "movieId", "rejected_record") == [(None, "x,Bad id,Drama")]
    assert titles.count() == 4 and rejects.count() == 1
    first, _ = read_catalogue(spark, str(path), limit=2)
    assert rows(first, "movieId") == [(1,), (2,)]
    assert title_names(titles, 2).columns == ["title"]
    assert rows(title_names(titles, 3)) == [('"Quoted" One (1998)',), ("A, The (1995)",), (None,)]


def test_damaged_catalogue_records(spark, tmp_path):
    """A cell too many or too few, an open quote: rejects, whatever columns are asked for."""
    path = tmp_path / "movies.csv"
    bad = ["1,A, B (1990),Drama", '3,"Unclosed, Foo', "4,Short", '8,"Unclosed, Foo,Z', "x5,id,Y"]
    good = ["2,fine,X", '6,"a, b",Z', '7,"say ""hi""",Z', '9,in"ner,Z']
    path.write_text("\n".join(["movieId,title,genres", *bad, *good]))
    titles, rejects = read_catalogue(spark, str(path))
    names = [("a, b",), ("fine",), ('in"ner',), ('say "hi"',)]
    assert rows(titles.select("title")) == rows(titles.select("genres", "title"), "title") == names
    assert titles.count() == len(good) == len(titles.collect())
    assert rows(rejects.select("rejected_record")) == sorted(((b,) for b in bad), key=repr)
    assert rejects.count() == rejects.select("title").count() == len(bad)


def test_damaged_phrase_records(spark, tmp_path):
    path = tmp_path / "train.tsv"
    bad = ["3\t1\textra\t3\tmore", "4\tabc\tsentence id\t2", "5\t1\tno label", "6\t1\thalf\t1.5"]
    path.write_text("\n".join(["PhraseId\tSentenceId\tPhrase\tSentiment", "1\t1\tfine\t3", *bad]))
    phrases, rejects = read_labelled_phrases(spark, str(path))
    assert rows(phrases.select("Phrase")) == [("fine",)] and phrases.count() == 1
    assert rows(rejects.select("rejected_record")) == sorted(((b,) for b in bad), key=repr)


def test_labelled_phrases(spark, tmp_path):
    path = tmp_path / "train.tsv"
    path.write_text(
        "PhraseId\tSentenceId\tPhrase\tSentiment\n"
        '2\t1\t"unclosed quote\t3\n'
        '1\t1\tinner "quote" here\t1\n'
        "3\t1\t  padded  \t2\n"
        "4\t2\t\t2\n"
        "5\t2\tnull\t2\n"
        "6\t2\tno label\t\n"
        "7\t2\tfractional\t1.5\n"
        "8\t2\ttoo short\n"
    )
    phrases, rejects = read_labelled_phrases(spark, str(path))
    assert rows(phrases, "PhraseId", "Phrase", "Sentiment") == [
        (1, 'inner "quote" here', 1),
        (2, '"unclosed quote', 3),
        (3, "  padded  ", 2),
        (5, "null", 2),
    ]
    assert rows(rejects, "PhraseId") == [(4,), (6,), (7,), (8,)]
    assert phrases.count() == 4 and rejects.count() == 4
    first, _ = read_labelled_phrases(spark, str(path), limit=2)
    assert rows(first, "PhraseId") == [(1,), (2,)]


def test_stage_keeps_rows_and_prunes_columns(spark, titles):
    staged = stage(titles, "titles")
    assert rows(staged) == rows(titles)
    assert "ReadSchema: struct<movieId:bigint>" in plan_of(staged.select("movieId"))
    assert workspace(spark) == workspace(spark)


def test_discard_run_removes_only_its_own_folder(spark, titles, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "workspace", lambda spark: str(tmp_path))
    other = tmp_path / "linetone" / "other-application"
    other.mkdir(parents=True)
    assert stage(titles, "titles").count() == titles.count()
    assert len(list((tmp_path / "linetone").iterdir())) == 2
    session.discard_run(spark)
    assert list((tmp_path / "linetone").iterdir()) == [other]


def test_names_limit_the_files_that_are_read(spark, texts, titles):
    names = ["Plain (1995).en.srt", "[x] Brackets {y}.en.srt", "C++ a+b.en.srt", "100% Pure.en.srt"]
    limited = read_subtitles(spark, texts, titles, names=names)
    assert limited.count() == 3 * (len(names) + 1)  # two titles share a file
    lines = read_line_files(spark, texts, names=names)
    lines.collect()
    scan = next(p for p in _nodes(lines._jdf.queryExecution().executedPlan()) if "Scan text" in p.nodeName())
    assert scan.metrics().apply("numFiles").value() == len(names)
    assert read_line_files(spark, texts, names=[]).count() == 0


def _nodes(plan):
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))


def test_model_path():
    assert model_path("/out/", 10, 42) == "/out/phrase_classifier-10-titles-42-phrases"
    assert model_path("/out", None, 42) == "/out/phrase_classifier-all-titles-42-phrases"
