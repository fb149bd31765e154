from __future__ import annotations

import random
import re

import pytest
from conftest import rows

from linetone.sources import read_blocks, read_cues, split_cues

BLANK = re.compile(r"[ \t]*")


@pytest.fixture
def split_size(spark):
    """Sets the largest split of a file in bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def cut(size):
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], 0)

    yield cut
    for name, value in before.items():
        spark.conf.set(name, value)


def plain_blocks(text):
    blocks, held = [], []
    for line in [*re.split("\r\n|\n", text), ""]:
        if not BLANK.fullmatch(line):
            held.append(line)
        elif held:
            blocks.append("\n".join(held))
            held = []
    return blocks


def found_blocks(spark, folder):
    found = read_blocks(spark, str(folder)).orderBy("file_key", "offset", "place").collect()
    by_file: dict = {}
    for row in found:
        by_file.setdefault(row["file_key"], []).append(row["block"])
    return by_file


CUES = "".join(
    f"{i}\n00:00:0{i % 10},000 --> 00:00:0{i % 10},900\n{'line ' * (i % 4)}é\nsecond\n\n" for i in range(1, 4)
)
TEXTS = {
    "plain": CUES,
    "cr_lf": CUES.replace("\n", "\r\n"),
    "white_lines": CUES.replace("\n\n", "\n \t\n\n\n"),
    "starts_blank": "\n\n  \n" + CUES.rstrip("\n"),
    "no_blank": "one\ntwo\nthree, which is longer than a split",
    "only_blank": "\n \n\t\n",
    "empty": "",
}


@pytest.mark.parametrize("size", [3, 7, 16, 61, 1 << 20])
def test_borders_of_splits(spark, tmp_path, split_size, size):
    for name, text in TEXTS.items():
        (tmp_path / f"{name}.en.srt").write_bytes(text.encode())
    split_size(size)
    found = found_blocks(spark, tmp_path)
    want = {f"{n}.en.srt": plain_blocks(t) for n, t in TEXTS.items()}
    assert found == {n: b for n, b in want.items() if b}


@pytest.mark.parametrize("text", ["a\nb\n\nc\n", "a\r\n\r\nb\r\n", "\n\na\n \nb"])
def test_a_border_at_any_byte(spark, tmp_path, split_size, text):
    (tmp_path / "t.en.srt").write_bytes(text.encode())
    for size in range(1, len(text)):
        split_size(size)
        assert found_blocks(spark, tmp_path) == {"t.en.srt": plain_blocks(text)}, size


@pytest.mark.parametrize("batch", [1, 2, 5])
def test_borders_of_batches(spark, tmp_path, batch):
    picks = random.Random(batch)
    texts = {f"t{i}.en.srt": "".join(picks.choice(["a\n", "bb\n", "\n", " \n"]) for _ in range(60)) for i in range(5)}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, batch)
    try:
        assert found_blocks(spark, tmp_path) == {n: plain_blocks(t) for n, t in texts.items()}
    finally:
        spark.conf.set(setting, before)


def test_a_file_is_many_tasks_and_no_cell_is_larger_than_a_block(spark, tmp_path, split_size):
    cue = "{}\n00:00:01,000 --> 00:00:02,000\n" + "word " * 20 + "\n\n"
    (tmp_path / "long.en.srt").write_text("".join(cue.format(i) for i in range(3000)))
    split_size(20_000)
    blocks = read_blocks(spark, str(tmp_path))
    assert blocks.rdd.getNumPartitions() > 15
    assert blocks.count() == 3000 and max(len(r["block"]) for r in blocks.collect()) < 150


def test_cues_are_those_of_whole_texts(spark, tmp_path, split_size):
    for name, text in TEXTS.items():
        (tmp_path / f"{name}.en.srt").write_bytes(text.encode())
    titles = spark.createDataFrame(
        [(i, n) for i, n in enumerate([*TEXTS, "plain", "missing"])], "movieId long, title string"
    )
    split_size(40)
    found = rows(read_cues(spark, str(tmp_path), titles))
    whole = [(i, TEXTS[n].replace("\r\n", "\n")) for i, n in enumerate([*TEXTS, "plain"])]
    whole = spark.createDataFrame(whole, "movieId long, Phrase string")
    want = rows(split_cues(whole))
    assert found == want and len(want) == 5 * 3
