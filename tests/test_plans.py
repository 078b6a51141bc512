"""Shapes of physical plans that the results depend on at scale."""

import contextlib
import io

import pytest

import __spark_entry__ as contract

TABLES = "/root/testdata/sf0.001"
QUERIES = {n: q for n, q in contract.queries().items() if n in contract.PLAIN}


def plan(df, run=False):
    if run:
        df.collect()
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_rows_and_no_cross_joins(spark, name):
    shown = plan(QUERIES[name](spark, TABLES))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups"):
        assert node not in shown
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in shown


@pytest.mark.parametrize(
    "name", ["rate_by_age", "rate_by_bp", "rate_by_score", "rate_by_year", "rate_age_by_score"]
)
def test_rates_combine_before_the_shuffle(spark, name):
    shown = plan(QUERIES[name](spark, TABLES))
    assert shown.count("FileScan") == 1
    assert shown.count("Exchange hashpartitioning") == 1
    below = shown.split("Exchange hashpartitioning")[1]
    assert "partial_count(1), partial_avg(Has_Disease" in below


def test_only_needed_columns_are_read(spark):
    shown = plan(QUERIES["year_counts"](spark, TABLES))
    for column in ("l_tax", "l_extendedprice", "l_quantity", "l_partkey"):
        assert column not in shown


def test_projections_have_no_shuffle(spark):
    for name in ("survey_clean", "model_frame", "lenient_cast", "align_union"):
        assert "Exchange" not in plan(QUERIES[name](spark, TABLES))


def test_box_statistics_scan_once(spark):
    shown = plan(QUERIES["bmi_box_stats"](spark, TABLES), run=True).split("Initial Plan")[0]
    assert shown.count("FileScan") == 1
    assert "ReusedExchange" in shown


def test_limited_sample_and_safe_forms_have_no_task_for_all(spark):
    """No single partition but over slices: one row each."""
    for name in ("hash_sample", "bmi_box_stats_ranked", "auc_by_score_ranked"):
        shown = plan(QUERIES[name](spark, TABLES))
        assert "TakeOrdered" not in shown and "CollectLimit" not in shown
        assert "percentile" not in shown


def test_combinations_are_counted_before_the_shuffle(spark):
    shown = plan(QUERIES["combination_counts"](spark, TABLES))
    assert shown.count("Exchange") == 1
    assert "partial_count(1)" in shown.split("Exchange")[1]
