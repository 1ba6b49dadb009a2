"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import duckdb
import pytest

from contrail.plans.adapters import BASE_TABLES
from contrail.plans.catalog import QUERIES


@pytest.fixture(scope="module")
def con(folder):
    c = duckdb.connect()
    for t in BASE_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return c


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql is not None])
def test_same_as_sql(spark, folder, con, name):
    q = QUERIES[name]
    df = q.run(spark, folder)
    cur = con.execute(q.oracle())
    assert df.columns == [d[0] for d in cur.description]
    assert ordered(df.collect()) == ordered(cur.fetchall())


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql is None])
def test_gives_rows(spark, folder, name):
    assert QUERIES[name].run(spark, folder).count() > 0


def test_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
