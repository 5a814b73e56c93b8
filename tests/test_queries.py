"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from fixtures import registered
from tests.conftest import SF_DIR
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(registered.QUERIES))
def test_query(spark, con, name):
    fn, sql = registered.QUERIES[name], registered.ORACLE.get(name)
    if sql is None:
        assert fn(spark, SF_DIR).count() >= 0
    else:
        assert compare(spark, con, SF_DIR, fn, sql) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["natureza_juridica", "empresas", "capital_total"] and df.count() == 10


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
