"""Every registered query against its SQL in DuckDB; those without SQL must return rows."""

import pytest

import oracle
from voltaria import queries

SF = "/root/testdata/sf0.001"
queries.load_all()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, con, name):
    df = queries.QUERIES[name](spark, SF)
    sql = queries.ORACLES.get(name)
    if sql is None:
        assert df.count() > 0
        return
    assert oracle.compare(df, con, sql) == []


def test_every_sql_has_a_query():
    assert set(queries.ORACLES) <= set(queries.QUERIES)
