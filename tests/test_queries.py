"""Every registered query with SQL gives the rows that DuckDB gives, on the smallest tables."""

import os

import pytest

from cairn.plans import catalogue

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the tables are not here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def shown(value):
    return f"{value:.8g}" if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(catalogue.runs()))
def test_query(spark, duck, name):
    df = catalogue.runs()[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(tuple(shown(r[c]) for c in columns) for r in df.collect())
    if name not in catalogue.sql():
        assert got
        return
    result = duck.execute(catalogue.sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted(tuple(shown(dict(zip(names, r))[c]) for c in columns) for r in result.fetchall())
    assert got == want


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
