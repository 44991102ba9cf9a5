"""Every registered query against its SQL counterpart on the smallest tables."""

import datetime
import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return repr(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = queries()[name](spark, SF_DIR)
    found = table(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(oracle_sql()[name])
    wanted = table([c[0] for c in result.description], result.fetchall())
    assert found[0] == wanted[0]
    assert len(found[1]) == len(wanted[1])
    assert found[1] == wanted[1]


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_without_sql_has_rows(spark, name):
    assert not queries()[name](spark, SF_DIR).isEmpty()


def test_entry(spark):
    assert entry(spark).columns == ["endpoint", "n"]
    assert entry(spark).count() == 10
