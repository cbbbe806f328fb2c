import os

import pytest

import __spark_entry__ as registry
from tools.compare import compare, connect

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ALL, SQL = registry.queries(), registry.oracle_sql()
PLANS = {name: ALL[name] for name in registry.PLANS}


@pytest.fixture(scope="module")
def oracle():
    return connect(SF)


def test_every_query_has_sql():
    assert set(PLANS) <= set(SQL) <= set(ALL)


@pytest.mark.parametrize("name", PLANS)
def test_query_equals_sql(spark, oracle, name):
    ok, note = compare(spark, oracle, SF, name, PLANS[name], SQL[name])
    assert ok, note


def test_entry(spark):
    assert registry.entry(spark).count() > 0
