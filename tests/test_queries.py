"""Every registered query against its SQL counterpart, over the smallest data set."""

from pathlib import Path

import compare
import pytest

import __spark_entry__ as contract
from areaweave.plans import entries
from oracle import statements

OWN = sorted(entries.queries())
FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    con = compare.duck(FOLDER)
    yield con
    con.close()


def test_all_queries_have_a_counterpart():
    assert set(OWN) <= set(contract.queries())
    assert set(OWN) == set(statements.all_statements())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", OWN)
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, FOLDER)
    assert compare.differences(df, duck, contract.oracle_sql()[name]) == []


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == [
        "ZIPCODE", "average_income", "num_of_public_resources", "num_of_resources_found",
    ]
    assert df.count() > 0
