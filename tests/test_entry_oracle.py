"""Driver contract and the Spark-vs-DuckDB check for every key that has SQL."""

import pytest

import __spark_entry__ as E
from conftest import SF_CHECK
from oracle_harness import compare, duck_connect

ORACLE_KEYS = sorted(E.oracle_sql())


def test_contract_shapes(spark):
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 44
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SF_CHECK)


@pytest.mark.parametrize("key", ORACLE_KEYS)
def test_oracle(spark, duck, key):
    r = compare(spark, duck, key, E.queries()[key], E.oracle_sql()[key], SF_CHECK)
    assert r["spark_rows"] > 0, r
    assert r["ok"], r
