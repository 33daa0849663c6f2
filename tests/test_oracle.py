"""Every registered query against its SQL in DuckDB, over the whole tables."""

import datetime
import decimal

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, (decimal.Decimal, datetime.date)):
        return str(value)
    return repr(value)


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    found = duck.execute(SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    ours = sorted(tuple(map(plain, r)) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    assert ours == sorted(tuple(map(plain, r)) for r in found.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["customer_segment", "ship_mode", "order_cnt"]
    assert df.count() == 25
