"""Every registered query against DuckDB, and the plans of the large ones."""

from __future__ import annotations

import pytest
from conftest import plan_of

import __spark_entry__ as contract
from check import compare, oracle_connection
from linetone.plans.oracle import ORACLE
from linetone.plans.registry import QUERIES, TIMED

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(FOLDER)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_equal_to_sql(spark, connection, key):
    assert compare(QUERIES[key](spark, FOLDER), connection, ORACLE[key]) is None


def test_entry(spark):
    assert contract.entry(spark).columns == ["movieId", "title", "score", "score_without_neutral"]


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


def test_fitted_report(spark):
    report = TIMED["lr_title_results"](spark, FOLDER)
    assert 0 < report.count() == report.where("score BETWEEN 0 AND 3").count()


FILE_QUERIES = {
    "catalogue_inferred",
    "catalogue_scan",
    "catalogue_rejects",
    "phrase_rejects",
    "labelled_phrase_scan",
    "subtitle_scan",
    "subtitle_whole",
    "subtitle_cues",
    "coverage_of_files",
    "coverage_counts_of_files",
    "study_counts",
    "study_training_predictions",
}
FITTED = {"lr_training_predictions", "lr_class_counts", "lr_weight_scores", "model_round_trip"}


@pytest.mark.parametrize("key", sorted(set(QUERIES) - FILE_QUERIES - FITTED))
def test_plans_stay_on_the_jvm_without_cross_joins(spark, key):
    plan = plan_of(QUERIES[key](spark, FOLDER))
    for operator in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoop"):
        assert operator not in plan


@pytest.mark.parametrize(
    "key, shuffles",
    [
        ("tokens_filtered", 0),
        ("unique_phrases", 1),
        ("fixed_weight_scores", 2),
        ("mean_score", 3),
        ("title_results", 3),
        ("word_stream_counts", 1),
    ],
)
def test_hash_shuffles(spark, key, shuffles):
    plan = plan_of(QUERIES[key](spark, FOLDER))
    assert plan.count("Exchange hashpartitioning") == shuffles


def test_scans_read_only_what_is_used(spark):
    plan = plan_of(QUERIES["word_stream_counts"](spark, FOLDER))
    assert "ReadSchema: struct<conv_id:bigint,text:string>" in plan
    assert "PushedFilters: [IsNotNull(text)]" in plan
    assert "EqualTo(turn,0)" in plan_of(QUERIES["title_results"](spark, FOLDER))


@pytest.mark.parametrize("key", ["tokens_filtered", "unique_phrases", "title_results"])
def test_tokeniser_runs_once(spark, key):
    assert plan_of(QUERIES[key](spark, FOLDER)).count("regexp_extract_all") == 1


def test_no_text_goes_with_the_words_of_a_phrase(spark):
    """Beyond the de-duplication neither a row per word nor a sum carries the phrase."""
    for key in ("fixed_weight_scores", "title_results_documents", "term_counts"):
        for line in plan_of(QUERIES[key](spark, FOLDER)).splitlines():
            if "Generate explode" in line:
                assert "phrase_key" not in line
            if "Aggregate(" in line and "margin" in line:
                assert "phrase_key" not in line
