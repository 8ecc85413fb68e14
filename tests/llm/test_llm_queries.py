"""Registered queries of the subpackage give the rows of their SQL, and all of them run on the smallest tables."""

import os

import pytest

from cairn.llm import queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the tables are not here")


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, name):
    duckdb = pytest.importorskip("duckdb")
    rows = queries.queries()[name](spark, DATA).collect()
    assert rows
    if name in queries.oracle_sql():
        c = duckdb.connect()
        for t in ("documents", "pages", "benchmark", "conversations"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
        result = c.execute(queries.oracle_sql()[name])
        names = [d[0] for d in result.description]
        assert sorted(names) == sorted(rows[0].asDict())
        columns = sorted(names)
        want = sorted(tuple(str(dict(zip(names, r))[k]) for k in columns) for r in result.fetchall())
        assert sorted(tuple(str(r[k]) for k in columns) for r in rows) == want
