"""Every query with an SQL statement equals DuckDB on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracles import KINDS, TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = queries()[name](spark, FOLDER)
    result = duck.sql(oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, result.fetchall())
    kinds = dict(df.dtypes)
    types = {d[0]: str(d[1]) for d in result.description}
    assert {c for c in kinds if KINDS.get(kinds[c], "TIMESTAMP") != types[c]} == set()


def test_oracles_belong_to_queries():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["BOROUGH", "PRICE_ZONE", "n", "pct"] and df.count() > 10
