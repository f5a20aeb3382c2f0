"""Every registered query against its SQL at sf0.01."""

import pytest
from conftest import SF

import __spark_entry__ as contract
from tools.check import difference, oracle_frame

SQL = contract.oracle_sql()


@pytest.mark.parametrize("name", list(contract.queries()))
def test_matches_sql(spark, name):
    actual = contract.queries()[name](spark, SF).toPandas()
    assert len(actual) > 0
    if name in SQL:
        assert difference(actual, oracle_frame(SF, SQL[name])) == ""


def test_entry(spark):
    assert contract.entry(spark).count() == 211


def test_every_sql_has_a_query():
    assert set(SQL) <= set(contract.queries())
