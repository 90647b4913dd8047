"""Every registered daily query against its SQL in DuckDB, on the smallest tables."""

import decimal
import os

import duckdb
import pytest
from conftest import SMALL

from dayfacts.plans.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SMALL):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SMALL}/{f}'")
    return con


def plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        return round(float(value), 6)
    return value.isoformat() if hasattr(value, "isoformat") else value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    found = duck.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(found.columns)
    assert rows(df.columns, df.collect()) == rows(found.columns, found.fetchall())
