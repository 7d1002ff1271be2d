"""Every query against its SQL; queries without SQL must at least run and keep a schema."""

import pytest

import __spark_entry__ as contract
from compare import connect, difference
from feedloom.catalog import oracles
from feedloom.catalog import queries as catalogue

QUERIES = catalogue.QUERIES
ORACLES = oracles.ORACLES
SLOW = {"weight_grid_report", "cv_scores", "runs_reeval", "lr_fit"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_sql_exists_for_all_but_the_learned_ones():
    assert set(QUERIES) - set(ORACLES) == SLOW
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, spark, con, sf_dir):
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLES[name]) == ""


def test_entry_runs(spark):
    assert contract.entry(spark).columns == ["id", "user", "preds", "position"]
