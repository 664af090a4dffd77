"""Every query of the table engine against the same question in SQL."""

import math
import os
from decimal import Decimal

import pytest

import __spark_entry__
from cellspark import catalogue

duckdb = pytest.importorskip("duckdb")


def rows(df):
    clean = lambda x: None if x is None or (isinstance(x, float) and math.isnan(x)) else round(float(x), 6) + 0.0 if isinstance(x, (int, float, Decimal)) and not isinstance(x, bool) else str(x)
    return sorted((tuple(clean(x) for x in r) for r in df), key=repr)


@pytest.fixture(scope="module")
def sql(small):
    con = duckdb.connect()
    for name in os.listdir(small):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{small}/{name}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_equals_sql(spark, small, sql, name):
    got = catalogue.QUERIES[name](spark, small)
    want = sql.sql(catalogue.ORACLE_SQL[name])
    order = sorted(got.columns)
    assert order == sorted(want.columns)
    assert rows(got.select(*order).collect()) == rows(want.select(*(f'"{c}"' for c in order)).fetchall())


def test_entry_and_names(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(catalogue.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
