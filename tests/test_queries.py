"""Every registered query against its SQL in DuckDB on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from lakemart.parity import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(v)
    return v if v is None or isinstance(v, (bool, int)) else str(v)


def table(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted((tuple(plain(r[i]) for i in order) for r in data), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = table(df.columns, df.collect())
    result = duck.execute(SQL[name])
    assert got == table([d[0] for d in result.description], result.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
