import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import compare  # noqa: E402
from __spark_entry__ import entry  # noqa: E402
from tillwatch.catalog import ORACLE, QUERIES  # noqa: E402


def queries():
    return QUERIES


def oracle_sql():
    return ORACLE


@pytest.fixture(scope="module")
def con(folder):
    return compare.connect(folder)


def test_every_twin_has_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_its_sql(spark, con, folder, name):
    line, good = compare.compare(spark, con, folder, name, queries()[name], oracle_sql().get(name))
    assert good, line


def test_entry(spark, folder):
    out = entry(spark)
    assert out.columns == ["coffee_name", "money_sum", "money_mean", "money_count"]
    assert out.count() == 5
