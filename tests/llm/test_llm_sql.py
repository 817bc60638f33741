"""The queries of this subpackage that SQL can express, against it."""

import pytest

import __spark_entry__ as contract
import compare
from shiftlens.llm import oracle

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.statements()))
def test_query_equals_sql(spark, name):
    rows = compare.connect(SF_DIR).execute(contract.oracle_sql()[name]).fetchdf()
    assert len(rows) > 0
    assert compare.difference(contract.queries()[name](spark, SF_DIR), rows) == ""


def test_all_fourteen_are_registered():
    names = contract.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
