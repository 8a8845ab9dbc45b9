"""Contracts: casts, limits in bytes, reports, and the good/rejected split."""

import datetime as dt

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from hemline.contracts import CONTRACTS, Field, TableContract

TABLE = TableContract("t", (
    Field("id", "int", True), Field("name", "string", True, 6), Field("rate", "double"), Field("day", "date"),
), key=("id",))
TEXTS = "id string, name string, rate string, day string"


def test_conform_casts_orders_and_renames(spark):
    df = spark.createDataFrame([("2025-01-02", "12.7", "x", "0.5"), ("bad", "bad", None, "bad")], "d string, id string, name string, rate string")
    got = TABLE.conform(df, {"day": "d"})
    assert got.dtypes == [("id", "int"), ("name", "string"), ("rate", "double"), ("day", "date")]
    assert rows(got) == sorted([(12, "x", 0.5, dt.date(2025, 1, 2)), (None, None, None, None)], key=repr)


def test_conform_casts_numbers_directly(spark):
    df = spark.createDataFrame([(12.9, 5, 7, None), (3e12, 5, 7, None)], "id double, name int, rate int, day string")
    assert rows(TABLE.conform(df)) == sorted([(12, "5", 7.0, None), (None, "5", 7.0, None)], key=repr)


def test_conform_refuses_an_unknown_column(spark):
    with pytest.raises(ValueError, match="no column"):
        TABLE.conform(spark.createDataFrame([("1", "a", "1", "x")], TEXTS), {"nmae": "name"})


def test_limits_count_bytes(spark):
    df = TABLE.conform(spark.createDataFrame([("1", "여성", None, None), ("2", "여성1", None, None), ("3", "1234567", None, None)], TEXTS))
    good, rejected = TABLE.split(df)
    assert [r.id for r in good.collect()] == [1]
    assert rows(rejected.select("id", "reject_reasons")) == [(2, ["name:too_long"]), (3, ["name:too_long"])]


def test_report_counts_nulls_lengths_and_surplus_keys(spark):
    df = TABLE.conform(spark.createDataFrame([("1", "a", "", ""), ("1", None, "", ""), ("1", "1234567", "", ""), ("x", "b", "", "")], TEXTS))
    assert rows(TABLE.report(df)) == sorted([
        ("id", "null", 1), ("name", "null", 1), ("name", "too_long", 1), ("id", "duplicate_key", 2)], key=repr)


def test_by_position_ignores_names_but_not_width(spark):
    df = spark.createDataFrame([("1", "a", "2", "2025-01-02")], "w string, x string, y string, z string")
    assert rows(TABLE.by_position(df)) == [(1, "a", 2.0, dt.date(2025, 1, 2))]
    with pytest.raises(ValueError, match="takes 4 columns"):
        TABLE.by_position(df.drop("z"))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.none() | st.integers(0, 9).map(str), st.none() | st.text("a여", max_size=8)), min_size=1, max_size=20))
def test_good_and_rejected_make_up_the_input(spark, data):
    df = TABLE.conform(spark.createDataFrame([(i, n, None, None) for i, n in data], TEXTS))
    good, rejected = TABLE.split(df)
    assert rows(good.union(rejected.drop("reject_reasons"))) == rows(df)
    bad = [i is None or n is None or len(n.encode()) > 6 for i, n in data]
    assert rejected.count() == sum(bad)


def test_every_contract_has_a_create_statement(spark):
    for name, contract in CONTRACTS.items():
        ddl = contract.create_sql(name)
        assert all(f"`{c}`" in ddl for c in contract.columns)
        assert set(contract.key) <= set(contract.columns)


def test_column_names_follow_the_marts(spark):
    assert CONTRACTS["product_detail_tb"].columns[12] == "review_avg_rating"
