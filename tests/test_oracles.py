"""Every registered query that SQL can answer, against DuckDB on the same files."""

import pytest

import __spark_entry__ as entry
from compare import check

ORACLES = entry.oracle_sql()


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_sql(spark, small, name):
    assert check(spark, small, entry.queries()[name], ORACLES[name]) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_entry_runs(spark):
    result = entry.entry(spark)
    assert result.columns == ["hour", "n", "quality", "t_data_3_1"]
    assert result.agg({"n": "sum"}).first()[0] == 197


@pytest.mark.parametrize(
    "name, rows",
    [
        ("forest_predictions", 40),
        ("boost_predictions", 40),
        ("reg_boost_predictions", 40),
        ("feature_importance", 16),
        ("cumulative_selection", 16),
        ("boost_importance", 12),
        ("boost_importance_cut", 1),
        ("forest_minimal", 40),
        ("alignment_comparison", 2),
        ("selection_cut", 1),
        ("cv_selection_linear", 16),
        ("pdp_boost_rows", 562),
    ],
)
def test_model_queries_run(spark, small, name, rows):
    assert len(entry.queries()[name](spark, small).collect()) == rows


@pytest.mark.parametrize("name, rows", [("random_search_forest", 2), ("random_search_boost", 2), ("tuning_comparison", 3), ("boost_tuning_comparison", 3)])
def test_searches_run_with_fewer_draws(spark, small, name, rows):
    assert len(entry.queries()[name](spark, small, draws=2).collect()) == rows
