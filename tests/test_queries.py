"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as contract
from tests import oracle_check
from tests.conftest import SF_DIR
from tickloom.plans.catalog import QUERIES
from tickloom.plans.oracles import ORACLES


@pytest.fixture(scope="module")
def db():
    return oracle_check.connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, db, name):
    assert oracle_check.differences(spark, db, name, SF_DIR) is None


def test_flagship_runs(spark):
    assert contract.entry(spark).count() > 0
