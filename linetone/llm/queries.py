"""The registered queries of the operators in this package, and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from linetone.llm import (
    chat,
    decontamination,
    fingerprints,
    language,
    mixing,
    quality,
    repair,
    sharding,
    simhash,
    substrings,
    toxicity,
    url_filters,
    whitening,
)
from linetone.plans.tables import table
from linetone.session import stage


def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select(
        "doc_id",
        sharding.text_size().alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        sharding.text_group().alias("group"),
    )
    cut = sharding.minimax_shards(documents, "size", "group", ["doc_id"])
    return cut.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mix = mixing.mix(table(spark, folder, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    documents, benchmark = (table(spark, folder, t) for t in ("documents", "benchmark"))
    return decontamination.leaks(documents, benchmark)


def op4_chat(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["conv_id", "turn", "role", "text"]
    conversations = table(spark, folder, "conversations").select(*columns)
    messages, said = chat.conversation_tree(conversations.unionByName(chat.tricky(spark)))
    return chat.digests(chat.format_branches(messages, said))


def op5_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.without_repeats(table(spark, folder, "documents"))


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    found = language.identify(documents, documents.where(~language.held_out()))
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op7_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return url_filters.judge(table(spark, folder, "pages")).drop("trust", "distrust")


def op8_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, folder, "documents"))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.fit(documents, labels.where(~toxicity.held_out()))
    scored = toxicity.score(documents, model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.digest(table(spark, folder, "embeddings"))


def op12_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.digest(table(spark, folder, "conversations"))


def op13_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    rows = stage(quality.described(documents), "described")
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    model = quality.fit(rows.where(~quality.held_out()), labels.where(~quality.held_out()))
    scored = quality.score(rows, model)
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_mixing": op2_mixing,
    "op3_decontamination": op3_decontamination,
    "op4_chat": op4_chat,
    "op5_substrings": op5_substrings,
    "op6_language": op6_language,
    "op7_url_filters": op7_url_filters,
    "op8_fingerprints": op8_fingerprints,
    "op9_toxicity": op9_toxicity,
    "op10_simhash": op10_simhash,
    "op11_whitening": op11_whitening,
    "op12_repair": op12_repair,
    "op13_quality": op13_quality,
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = {
    **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}),
    "op2_mixing": mixing.ORACLE_SQL,
    "op3_decontamination": decontamination.ORACLE_SQL,
    "op4_chat": chat.ORACLE_SQL,
    "op5_substrings": substrings.ORACLE_SQL,
    "op7_url_filters": url_filters.ORACLE_SQL,
    "op12_repair": repair.ORACLE_SQL,
}
