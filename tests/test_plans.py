"""Shape of the physical plans that matter at scale."""

import pytest

from hemline.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


WRITES = {
    "scan_json_lines", "scan_json_multiline", "scan_json_schema", "scan_text_lines", "scan_csv", "scan_glob",
    "path_partitions", "sink_parquet", "sink_json_replace", "load_positional", "full_refresh", "multi_source_load", "mart_ctas",
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(spark, name)
    for operator in ("Python", "ExistingRDD", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas", "CollectLimit"):
        assert operator not in text


@pytest.mark.parametrize("name", [
    "top_n_per_group", "reviews_newest_n", "top2_labels", "top5_keywords", "top_n_brands", "snap_brand_ranking", "listing_items",
])
def test_top_n_is_pruned_before_the_shuffle(spark, name):
    assert plan(spark, name).count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("name", ["explode_list", "explode_nested", "indexed_modules", "posexplode_rank", "flatten_tree", "video_select", "musinsa_ranking"])
def test_nested_documents_need_no_hash_shuffle(spark, name):
    assert "hashpartitioning" not in plan(spark, name)
    assert plan(spark, name).count("FileScan") == 1


def test_lookup_is_broadcast_only_below_the_bound(spark):
    assert "BroadcastHashJoin" in plan(spark, "category_lookup_default")
    text = QUERIES["category_lookup_large"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in text


def test_scan_reads_only_the_needed_column(spark):
    assert "ReadSchema: struct<l_partkey:bigint>" in plan(spark, "scan_parquet_pruned")


def test_aggregates_are_combined_before_the_shuffle(spark):
    for name in ("label_counts", "distinct_rows", "latest_value", "merge_last_wins", "contract_report"):
        text = plan(spark, name)
        assert "partial_" in text or text.count("HashAggregate") >= 2, name


def test_the_category_join_of_the_product_mart_is_dropped(spark):
    text = plan(spark, "mart_product_left")
    assert text.count("LeftOuter") == 2  # the offsets of the ranks and the details


def test_page_fields_resolve_references_once_and_skip_comments(spark):
    from hemline.plans import collect

    html = (
        '<title>A &amp; B</title><!-- <meta property="og:image" content="no"> <title>x</title> --><script>"<a href=/brand/no>"</script>'
        "<style><meta property='og:image' content=no></style><meta content='a&quot;b' property='og:image'><!-- <a href='/brand/hidden'> "
        f'--><a href="/brand/seen&amp;1">s</a><!--<script id="__NEXT_DATA__">{{"no": 1}}</script>--><script id="__NEXT_DATA__">'
        '{"props": {"pageProps": {"meta": {"data": {"goodsReview": {"totalCount": 7, "note": "<!-- kept"}}}}}}</script><!-- unclosed <title>y</title>')
    pages = spark.createDataFrame([(1, html), (2, None), (3, ""), (4, "<!--<title>z</title>")], "k int, html string")
    products = collect.page_products(pages, keep=["k"])
    got = {r["k"]: r for r in products.collect()}
    assert (got[1]["product_name"], got[1]["image_src"], got[1]["review_count"]) == ("A & B", 'a"b', "7")
    assert got[2]["product_name"] is got[3]["product_name"] is got[4]["product_name"] is None
    plan = products._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("CounterClockwiseContourIntegral") == 1
