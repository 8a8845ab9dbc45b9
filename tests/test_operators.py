"""Operators on literal rows."""

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hemline.operators import grouping, lookup, nested, project, quality, ranking


def test_tag_adds_typed_constants(spark):
    df = project.tag(spark.range(1), a="x", b=(None, "string"), c=("2025-01-02", "date"))
    assert [t for _, t in df.dtypes] == ["bigint", "string", "string", "date"]


def test_union_matches_names_and_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([("y", 2, 0.5)], "a string, k int, extra double")
    assert rows(project.union_all([a, b])) == [(1, "x", None), (2, "y", 0.5)]


def test_text_records_survive_comments_and_short_lines(spark):
    lines = ["#START7777", "  # note, x", "", "   ", "1,2", " 3,4,5 ", "junk 7777END here", "x"]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    assert rows(quality.text_records(df, ",")) == sorted([(["1", "2"],), (["3", "4", "5"],), (["x"],)], key=repr)


def test_defaults_and_missing(spark):
    df = spark.createDataFrame([(1, None), (None, 2.0), (3, 4.0)], "a int, b double")
    assert rows(quality.drop_null_rows(df)) == [(3, 4.0)]
    assert (1, 0.0) in rows(quality.fill_defaults(df, {"b": 0.0}))
    nested_df = df.select(F.when(F.col("a") > 1, F.struct("b")).alias("s"))
    assert quality.keep_present(nested_df, "s.b").count() == 1


def test_skip_empty(spark):
    df = spark.createDataFrame([(0, ["x"]), (2, []), (1, ["y"]), (None, None)], "total int, items array<string>")
    assert rows(quality.skip_empty(df, "total", "items")) == [(1, ["y"])]


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame([("a", "A", None), ("b", "B", "BB")], "code string, name string, more string")


def test_lookup_default_and_null(spark, dim):
    df = spark.createDataFrame([("a",), ("z",), (None,), ("a",)], "k string")
    assert rows(lookup.map_lookup(df, "k", dim, "code", ["name", "more"], "Unknown")) == sorted(
        [("a", "A", None), ("a", "A", None), ("z", "Unknown", "Unknown"), (None, "Unknown", "Unknown")], key=repr)
    assert rows(lookup.map_lookup(df, "k", dim, "code", ["name"])) == sorted(
        [("a", "A"), ("a", "A"), ("z", None), (None, None)], key=repr)


def test_lookup_beyond_the_broadcast_bound_gives_the_same(spark, dim):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    small = lookup.map_lookup(df, "k", dim, "code", ["name"], "Unknown")
    large = lookup.map_lookup(df, "k", dim, "code", ["name"], "Unknown", max_broadcast_rows=1)
    assert rows(small) == rows(large)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().toString()


def test_lookup_refuses_a_dimension_with_two_rows_per_key(spark, dim):
    df = spark.createDataFrame([("a",)], "k string")
    with pytest.raises(ValueError, match="not unique"):
        lookup.map_lookup(df, "k", dim.union(dim), "code", ["name"])


def test_is_small_checks_rows_and_bytes(spark):
    df = spark.range(100)
    assert lookup.is_small(df)
    assert not lookup.is_small(df, max_rows=99)
    assert not lookup.is_small(df.select(F.repeat(F.lit("x"), 1000).alias("v")), max_bytes=50_000)


def test_top_items_breaks_ties_by_name_and_ignores_null(spark):
    df = spark.createDataFrame([("a", x) for x in "zzyyx"] + [("b", "q"), ("b", None), ("c", None)], "g string, i string")
    assert rows(ranking.top_items(df, "g", "i", 2, ["l1", "l2"])) == [("a", "y", "z"), ("b", "q", None)]


def test_stable_ids_are_dense_and_the_same_for_any_layout(spark):
    df = spark.range(500).select((F.col("id") % 37).alias("k"), F.when(F.col("id") % 3 > 0, "x").alias("t"))
    first = rows(ranking.stable_ids(df, ["k", "t"]))
    again = rows(ranking.stable_ids(df.repartition(7), ["k", "t"]))
    assert first == again
    assert sorted(r[2] for r in first) == list(range(1, len(first) + 1))
    joined = ranking.with_stable_id(df, ["k", "t"])
    assert joined.count() == 500 and joined.where("id is null").count() == 0


def test_latest_value_and_last_wins(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (1, 2, None), (2, 1, 7.0)], "k int, t int, v double")
    assert rows(ranking.latest_value(df, ["k"], "v", ["t"], 0.0)) == [(1, 0.0), (2, 7.0)]
    assert rows(ranking.last_wins(df, ["k"], ["t"])) == [(1, 2, None), (2, 1, 7.0)]


group_rows = st.lists(st.tuples(st.integers(0, 3), st.integers(-50, 50)), min_size=1, max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=group_rows, n=st.sampled_from([1, 3, 20000]), pieces=st.sampled_from([None, 3]))
def test_top_n_equals_brute_force(spark, data, n, pieces):
    data = [(i, k, v) for i, (k, v) in enumerate(data)]
    df = spark.createDataFrame(data, "i int, k int, v int")
    got = rows(ranking.top_n(df, ["k"], [F.desc("v"), F.asc("i")], n, "rank", pieces))
    wanted = []
    for key in {k for _, k, _ in data}:
        best = sorted((r for r in data if r[1] == key), key=lambda r: (-r[2], r[0]))[:n]
        wanted += [(*r, pos) for pos, r in enumerate(best, start=1)]
    assert got == sorted(wanted, key=repr)


def test_full_rank_of_a_hot_group_is_dealt_over_tasks(spark):
    rows_in = [("hot", i % 50, i) for i in range(2_000)] + [(None, 1, 1), (None, 2, 2), ("b", 5, 9)]
    df = spark.createDataFrame(rows_in, "k string, v int, i int").repartition(3)
    ranked = ranking.full_rank(df, ["k"], [F.desc("v"), F.asc("i")], "rank")
    wanted = []
    for key in ("hot", None, "b"):
        group = sorted((r for r in rows_in if r[0] == key), key=lambda r: (-r[1], r[2]))
        wanted += [(*r, at) for at, r in enumerate(group, start=1)]
    assert rows(ranked) == sorted(wanted, key=repr)


def test_item_batches_keep_every_distinct_item_and_cut_a_hot_group(spark):
    hot = [("hot", i) for i in range(1000)] * 2
    df = spark.createDataFrame(hot + [("small", 1), ("small", None), (None, 5)], "g string, i int")
    got = ranking.item_batches(df, ["g"], "i", 40).collect()
    items = [x for r in got if r.g == "hot" for x in r["items"]]
    assert sorted(items) == list(range(1000))
    lists = [r["items"] for r in sorted((r for r in got if r.g == "hot"), key=lambda r: r.batch)]
    assert [x for part in lists for x in part] == list(range(1000)) and [len(part) for part in lists] == [40] * 25
    assert [(r.batch, r["items"]) for r in got if r.g == "small"] == [(0, [1])]
    assert [(r.batch, r["items"]) for r in got if r.g is None] == [(0, [5])]


def test_module_items_skip_modules_without_items(spark):
    schema = "data struct<modules: array<struct<items: array<int>>>>"
    docs = spark.createDataFrame([(([([0],), ([1, 2],), (None,), ([],), ([3, None],), ([9],)],),), ((None,),), (None,)], schema)
    assert rows(nested.module_items(docs, "data.modules", "items", first=1, last=4)) == sorted([(1,), (2,), (3,), (None,)], key=repr)


def test_components_of_kind(spark):
    schema = "components array<struct<component_id: int, entity: struct<item_list: array<string>>>>"
    docs = spark.createDataFrame([([(9, (["a", "b"],)), (7, (["x"],)), (9, (None,)), (9, (["c"],))],), (None,)], schema)
    assert rows(nested.components_of_kind(docs, "components", 9)) == [(0, 0, "a"), (0, 1, "b"), (3, 0, "c")]


def test_tree_leaves(spark):
    df = spark.createDataFrame([({"a": {"b": ["c", "d"], "e": []}, "f": None},)], "tree map<string, map<string, array<string>>>")
    assert rows(nested.tree_leaves(df, "tree", ["d1", "d2", "d3"])) == [("a", "b", "c"), ("a", "b", "d")]


def test_explode_gives_no_row_for_null_and_empty(spark):
    df = spark.createDataFrame([(1, ["a"]), (2, []), (3, None)], "k int, items array<string>")
    assert rows(nested.explode_items(df, "items", "x", ["k"])) == [(1, "a")]
    assert rows(nested.enumerate_items(df, "items", ["k"], "x")) == [(1, "a", 1)]


def test_size_check_moves_no_rows(spark):
    dim = spark.range(1_000).selectExpr("cast(id as string) as k", "id as v")
    assert lookup.is_small(dim) and not lookup.is_small(dim, max_rows=999) and not lookup.is_small(dim, max_bytes=1_000)
    facts = spark.range(50).selectExpr("cast(id as string) as code")
    beyond = lookup.map_lookup(facts, "code", dim, "k", ["v"], max_broadcast_rows=10)
    plan = beyond._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert beyond.where("v is not null").count() == 50
