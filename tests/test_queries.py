"""Every registered query equals its SQL."""

import pytest

import __spark_entry__ as contract
import check
from conftest import SF


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    frame = contract.entry(spark)
    assert frame.columns[-1] == "QueryAt" and frame.count() > 0


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query(spark, name):
    assert check.compare(spark, SF, name) is None
