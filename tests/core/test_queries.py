"""Every registered query of the map engine against its SQL, on the smallest tables."""

import pytest

from quadra import registry
from tests.core.oracle import connect, rows

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    got = [tuple(r) for r in df.collect()]
    assert name in SQL
    cur = con.execute(SQL[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, got) == rows(columns, cur.fetchall())


def test_sql_has_no_query_of_its_own():
    assert not SQL.keys() - QUERIES.keys()
