"""Text lines of titles, from one scan over a folder of text files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from linetone.functions import path_file_key, scanned_file_key, title_file_key
from linetone.functions.keys import TEXT_SUFFIX
from linetone.sources.blocks import read_blocks


def list_text_files(spark: SparkSession, folder: str, suffix: str = TEXT_SUFFIX) -> DataFrame:
    """``file_key`` of every text file in ``folder``. No content is read."""
    files = spark.read.load(folder, format="binaryFile", pathGlobFilter=f"*{suffix}")
    return files.select(path_file_key(F.col("path")).alias("file_key"))


def read_line_files(
    spark: SparkSession,
    folder: str,
    suffix: str = TEXT_SUFFIX,
    whole: bool = False,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """``file_key`` and ``Phrase``: every physical line of every file, or with
    ``whole`` every file as one row.

    ``names``, a short list of file names, limits the scan to these files: Spark tests
    the names when it lists the folder and opens no other.

    Spark packs small files into splits and cuts large ones, so neither many short
    texts nor one huge text decides the number of tasks.
    """
    texts = spark.read.text(folder, wholetext=whole, pathGlobFilter=f"*{suffix}")
    name = scanned_file_key(F.col("_metadata.file_name"))
    if names is not None:
        texts = texts.where(name.isin(list(names)))
    return texts.select(name.alias("file_key"), F.col("value").alias("Phrase"))


def read_subtitles(
    spark: SparkSession,
    folder: str,
    titles: DataFrame,
    suffix: str = TEXT_SUFFIX,
    whole: bool = False,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """``movieId`` and ``Phrase`` for the texts of ``titles``, whose files are in ``folder``.

    ``names`` limits the files that are read (see :func:`read_line_files`).

    A file that two titles share counts for both. The titles are broadcast when they
    are below Spark's threshold. Above it the join shuffles, and the adaptive
    skew join splits a file that holds an outsized part of the lines.
    """
    keys = titles.select("movieId", title_file_key(F.col("title"), suffix).alias("file_key"))
    lines = read_line_files(spark, folder, suffix, whole, names)
    return lines.join(keys, "file_key").select("movieId", "Phrase")


# A number, a line with two times, and the lines of text.
CUE = (
    r"(?s)^\s*(\d+)[ \t]*\r?\n[ \t]*(\d+:\d\d:\d\d[,.]\d{1,3})[ \t]*-->"
    r"[ \t]*(\d+:\d\d:\d\d[,.]\d{1,3})[^\n]*(?:\n(.*))?$"
)
BLANK_LINES = r"\r?\n(?:[ \t]*\r?\n)+"


def split_cues(texts: DataFrame, text: str = "Phrase") -> DataFrame:
    """One row per cue of whole texts: ``cue``, ``start``, ``end`` and its lines as ``text``.

    Cues stand between blank lines. What has no number and times in front is left out.
    """
    others = [c for c in texts.columns if c != text]
    blocks = texts.where(F.col(text).isNotNull()).select(
        *others, F.explode_outer(F.split(text, BLANK_LINES)).alias("block")
    )
    return cues_of_blocks(blocks)


def cues_of_blocks(blocks: DataFrame, block: str = "block") -> DataFrame:
    """The blocks that are cues, taken apart as in :func:`split_cues`."""
    part = lambda i: F.regexp_extract(block, CUE, i)
    return blocks.where(F.col(block).rlike(CUE)).select(
        *(c for c in blocks.columns if c != block),
        part(1).cast("long").alias("cue"),
        part(2).alias("start"),
        part(3).alias("end"),
        F.regexp_replace(part(4), r"\s+$", "").alias("text"),
    )


def read_cues(
    spark: SparkSession, folder: str, titles: DataFrame, suffix: str = TEXT_SUFFIX
) -> DataFrame:
    """``movieId`` and the cues of the texts of ``titles``, from files of any size.

    Files are read as blocks between blank lines (see :func:`read_blocks`), never whole.
    """
    keys = titles.select("movieId", title_file_key(F.col("title"), suffix).alias("file_key"))
    blocks = read_blocks(spark, folder, suffix).join(keys, "file_key")
    return cues_of_blocks(blocks.select("movieId", "block"))


def split_lines(texts: DataFrame, text: str = "text", number: str = "line_no") -> DataFrame:
    """One numbered row per line of a text column, as ``Phrase``, beside the other columns."""
    others = [c for c in texts.columns if c != text]
    # Split never gives an empty list, so the outer form adds no row; the inner one
    # would split every text twice (see vocabulary.explode_terms).
    return (
        texts.where(F.col(text).isNotNull())
        .select(*others, F.posexplode_outer(F.split(text, "\n")).alias(number, "Phrase"))
        .withColumn(number, F.col(number).cast("long"))
    )

