"""Every SQL-expressible query against its DuckDB twin on the smoke data.

Set LENDLAKE_TWIN_SF=/root/testdata/sf0.01 to run the gate's scale.
"""

import os

import pytest

import __spark_entry__ as entry
from tests.twin import compare, duck

SF = os.environ.get("LENDLAKE_TWIN_SF", "/root/testdata/sf0.001")
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_twin(spark, con, name):
    problems, _ = compare(spark, con, name, entry.queries()[name], SQL[name], SF)
    assert not problems, problems


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(SQL)))
def test_query_without_twin_runs(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_every_query_has_doc_and_entry(spark):
    qs = entry.queries()
    assert set(SQL) <= set(qs)
    df = entry.entry(spark)
    assert df.count() > 0
