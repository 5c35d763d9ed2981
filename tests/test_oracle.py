"""Every registered query against its SQL on whole tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import connect, rows_of_duckdb, rows_of_spark
from headway.suite import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# learned results have no SQL; they are checked in test_model.py
LEARNED = {
    "train_weighted", "score_batch", "importance_rank", "hindcast_model", "grid_forecast_model",
    "trip_forecast_model", "ordinal_model", "random_search", "permutation_importance_model",
}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, duck, name):
    columns, rows = rows_of_spark(QUERIES[name](spark, SF_DIR))
    wanted_columns, wanted = rows_of_duckdb(duck, ORACLES[name])
    assert columns == wanted_columns
    assert len(rows) == len(wanted)
    assert rows == wanted


def test_only_learned_queries_lack_sql():
    assert set(QUERIES) - set(ORACLES) == LEARNED


def test_entry_returns_rows(spark):
    assert not entry.entry(spark).isEmpty()
