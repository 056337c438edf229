"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from arrears.plans.catalog import catalog
from oracles.sql import statements
from tools.check_oracle import compare, spark_rows, sql_rows

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    assert compare(spark_rows(QUERIES[name](spark, FOLDER)), sql_rows(FOLDER, SQL[name])) is None


def test_only_fitted_models_lack_sql():
    assert set(catalog()) - set(statements()) == {
        "ablation_table", "calibration_skill", "evaluate_model", "train_and_score", "training",
        "tree_reasons"}
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert {row.split for row in entry.entry(spark).collect()} == {"valid", "test"}
