"""Every registered query against its SQL in DuckDB, at the smallest scale."""

import datetime
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime) and value.tzinfo:
        return value.replace(tzinfo=None)
    return value


def ordered(rows):
    return sorted(repr(tuple(plain(v) for v in r)) for r in rows)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    relation = duck.sql(entry.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(relation.columns)
    types = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    got = ordered(df.select(*[f"`{c}`" for c in columns]).collect())
    wanted = duck.sql(f"select {', '.join(chr(34) + c + chr(34) for c in columns)} from ({entry.oracle_sql()[name]})").fetchall()
    assert got == ordered(wanted)
    assert got, "a query without rows proves nothing"


def test_only_the_optional_queries_lack_sql():
    from hemline.catalog import ORACLES, QUERIES

    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
