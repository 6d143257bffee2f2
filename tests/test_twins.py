"""Every query against its SQL twin."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from pricetide.plans.catalog import QUERIES
from pricetide.plans.twins import TWINS
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_twin(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, TWINS[name]) is None


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(TWINS)
    assert set(QUERIES) <= set(queries()) and set(TWINS) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() == 15
