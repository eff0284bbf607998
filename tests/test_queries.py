"""Every registered query against its SQL."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from compare import connect, spark_rows, sql_rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def sql():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(contract.QUERIES) == set(contract.ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, sql, name):
    got = spark_rows(contract.queries()[name](spark, SF_DIR))
    want = sql_rows(sql, contract.oracle_sql()[name])
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1]) > 0
    assert got[1] == want[1]


def test_entry_lists_ten_pages(spark):
    top = contract.entry(spark)
    assert top.columns == ["title", "log_rank"]
    assert top.count() == 10
