"""Every registered query against its DuckDB oracle (the correctness gate)."""

import pytest

import __spark_entry__ as entry
from conftest import SF_ORACLE
from oracle_compare import compare, duck

from martlens.plans import ORACLE_SQL as ORACLE
from martlens.plans import QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    problems, n = compare(QUERIES[name](spark, SF_ORACLE), con, ORACLE[name])
    assert not problems, problems


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["logDate", "logHour", "dau"]
    assert df.count() > 0
