"""Every registered query of the subpackage that has SQL against it."""

import pytest

from tests import oracle_check
from tests.conftest import SF_DIR
from tickloom.llm.catalog import ORACLES


@pytest.fixture(scope="module")
def db():
    return oracle_check.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, db, name):
    assert oracle_check.differences(spark, db, name, SF_DIR) is None
