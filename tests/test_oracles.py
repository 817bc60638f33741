"""Every registered query against its oracle."""

import pytest

import __spark_entry__ as contract
import compare
from oracle import duckdb_sql
from shiftlens import workload

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def oracle():
    return compare.connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(workload.registered()) == set(duckdb_sql.statements())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(workload.registered()))
def test_query_equals_oracle(spark, oracle, name):
    rows = oracle.execute(contract.oracle_sql()[name]).fetchdf()
    assert len(rows) > 0
    assert compare.difference(contract.queries()[name](spark, SF_DIR), rows) == ""
