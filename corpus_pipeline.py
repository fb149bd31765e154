"""The corpus pipeline: five stages, each a function from documents to documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from linetone.llm import decontamination, language, mixing, sharding, simhash
from linetone.plans.tables import table
from linetone.session import stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear from their letters. What is learned from is the
    part of the corpus that op6 learns from, too."""
    labelled = docs.where(~language.held_out()).select("doc_id", "text", "lang")
    return language.clear(docs, labelled)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints; shingles and distance are ``op10``'s."""
    return simhash.without_near_duplicates(docs)


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return mixing.mixed(docs)


def cut_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``size``, ``shard`` and ``slot`` of every row; equal texts share a shard."""
    sized = docs.select(
        "doc_id", sharding.text_size().alias("size"), sharding.text_group().alias("group")
    )
    return sharding.minimax_shards(sized, "size", "group", ["doc_id"]).drop("group")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", identify_language),
    ("SimHash near-dedup", remove_near_duplicates),
    ("benchmark decontamination", remove_leaks),
    ("mixing sources to target weights", mix_sources),
    ("sharding", cut_shards),
]

# Compression and XXH64 have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each one's rows written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
