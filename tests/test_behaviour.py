"""Decisions about doubtful input, and properties of whole jobs."""

import datetime as dt

from bronze_day import musinsa_review, pretty, weather_line
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hemline.operators import lookup
from hemline.plans import collect, marts, product, review, schemas, snap, trend, video, weather
from hemline.sources import readers

RUN = "2025-01-02"
quick = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def brands(spark, *labels):
    """One brand per list of snaps, each a list of labels."""
    data = [(([(str(i), "n", "u", (i, None), 0, [([(n,) for n in snap],) for snap in snaps])],),) for i, snaps in enumerate(labels)]
    return snap.brand_ranking(spark.createDataFrame(data, schemas.SNAP_BRAND), RUN)


def test_second_label_differs_from_the_first(spark):
    got = brands(spark, [["a", "b"], ["b"]], [["a"], ["a"]], [], [[]])
    assert rows(got.select("brand_id", "labels_name_1", "labels_name_2")) == [
        ("0", "b", "a"), ("1", "a", None), ("2", None, None), ("3", None, None)]


def test_newcomer_moves_by_its_own_rank(spark):
    got = marts.snap_brand_ranking(brands(spark, [], [["x"]]))
    assert rows(got.select("curr_rank", "prev_diff_rank", "labels")) == [(0, 0, None), (1, 1, "x")]


def test_keyword_is_the_first_of_its_list(spark):
    doc = ((dt.date(2025, 1, 1), dt.date(2025, 1, 2), "date", [("t", ["k1", "k2"], [(dt.date(2025, 1, 1), 1.5)]), ("u", [], [(None, 2.5)])]),)
    df = spark.createDataFrame(doc, schemas.KEYWORD_TREND)
    got = trend.keyword_trend(df, "female", RUN)
    assert rows(got.select("keyword_name", "ratio", "gender", "category_name")) == sorted(
        [("k1", 1.5, "여성", "패션의류"), (None, 2.5, "여성", "패션의류")], key=repr)
    assert got.where("trend_id is null").count() == 0


def test_pretty_reviews_need_the_multiline_reader(spark, tmp_path):
    (tmp_path / "reviews_1.json").write_text(pretty([{"goods_sno": 1, "eval": 4}, {"goods_sno": 2}]))
    assert rows(review.ably_reviews(review.read_ably_reviews(spark, str(tmp_path)), RUN).select("product_id", "review_rating")) == [(1, 4), (2, None)]
    with_lines = readers.read_json(spark, str(tmp_path), "goods_sno string")
    assert with_lines.where("goods_sno = '1'").count() == 0


def test_one_bad_weather_line_is_not_fatal(spark):
    lines = spark.createDataFrame([(v,) for v in (weather_line("20250101", 1, f2="-9.0"), "broken", ",,,", weather_line("2025010a", 2))], "value string")
    got = rows(weather.weather_daily(lines).select("TM", "STN", "WS_AVG"))
    assert (dt.date(2025, 1, 1), 1, -9.0) in got and len(got) == 4
    assert got.count((None, None, 0.0)) == 2


def test_video_bounds_are_parameters(spark):
    def searches(*durations):
        items = [(str(i), (None, None, None, None, ((None,),), None, None), (d, None, None), None) for i, d in enumerate(durations)]
        return spark.createDataFrame([("c", items), ("none", None)], f"category_name string, {schemas.VIDEO_SEARCH}")

    df = searches("PT1M59S", "PT2M", "PT30M", "PT30M1S", "PT5M", "P1D", "PT6M")
    assert rows(video.select_videos(df).select("videoId", "duration", "viewCount")) == [("1", 120, "0"), ("2", 1800, "0"), ("4", 300, "0")]
    assert rows(video.select_videos(df, low=180, high=1200, per_category=1).select("videoId")) == [("4",)]


def test_gender_words_agree(spark):
    df = spark.createDataFrame([(w,) for w in ("female", "WOMEN", "여성", "male", "MEN", "kids", None)], "w string")
    assert [r[0] for r in df.select(snap.gender_word("w")).collect()] == ["여성"] * 3 + ["남성"] * 2 + ["kids", None]


def test_the_detail_mart_fans_out_and_the_product_mart_does_not(spark):
    ranking = spark.createDataFrame([("p", c, 1, i, None) for i, c in enumerate("abc")], "platform string, master_category_name string, product_id int, ranking int, created_at date")
    detail = ranking.select("platform", "master_category_name", "product_id", *[F.lit(None).cast("string").alias(c) for c in (
        "small_category_name", "product_name", "img_url", "brand_name_kr", "original_price", "final_price", "discount_ratio",
        "review_counting", "review_avg_rating", "like_counting")])
    category = spark.createDataFrame([("a",), ("a",), ("b",)], "master_category_name string")
    assert marts.product_ranking_detail(ranking, detail).count() == 9
    assert marts.total_product(ranking, category, detail).count() == 3


def test_same_review_in_two_documents_is_kept_once(spark):
    one = musinsa_review(1, "x", "2025-01-02T00:30:00.000+09:00", 170)
    df = spark.createDataFrame([([one, one], 2), ([one], 1), (None, 0)], schemas.MUSINSA_REVIEW)
    assert rows(review.musinsa_reviews(df, RUN).select("product_id", "review_date")) == [(1, dt.date(2025, 1, 2))]


def test_item_without_number_is_skipped_in_work_lists(spark):
    items = spark.createDataFrame([("c", ((n,),)) for n in (3, None, 0, 3, 5)] + [("c", (None,)), ("c", None)],
                                  "category string, item struct<like: struct<goods_sno: bigint>>")
    got = collect.product_work_list(items, "category", "item.like.goods_sno")
    assert rows(got.select("category", "product_ids")) == [("c", [3, 5])]


def test_a_later_category_tree_replaces_whole_branches(spark):
    trees = [
        (1, {"여성": {"상의": {"니트": ["a", "b"]}, "하의": {"팬츠": ["c"]}}}),
        (2, {"여성": {"상의": {"셔츠": ["d"]}}, "남성": {"상의": {"니트": ["a"]}}}),
        (3, None),
    ]
    df = spark.createDataFrame(trees, "position int, tree map<string, map<string, map<string, array<string>>>>")
    tuples = collect.category_tuples(df, "tree", "position")
    assert rows(tuples) == sorted([("여성", "상의", "셔츠", "d"), ("여성", "하의", "팬츠", "c"), ("남성", "상의", "니트", "a")])
    assert ("여성", "하의", "팬츠", 0, ["c"]) in rows(collect.category_groups(tuples))


def test_listing_stops_at_its_size_over_all_pages(spark):
    item = ((1,), "img", 1, (1,))
    components = [(9, ([(item, None)] * 3,)), (7, ([(item, None)],)), (9, None)]
    pages = spark.createDataFrame(
        [("c", p, components, None) for p in range(4)], f"category string, page int, {schemas.ABLY_COMPONENTS}"
    )
    got = collect.listing_items(pages, "category", "page", size=7)
    assert rows(got.select("category", "ranking")) == [("c", i) for i in range(1, 8)]


def test_page_without_product_tags_gives_nulls(spark):
    got = collect.page_products(spark.createDataFrame([("<html><title>x</title></html>",), (None,)], "html string")).collect()
    assert got[0]["product_name"] == "x"
    assert all(v is None for k, v in got[0].asDict().items() if k != "product_name")
    assert all(v is None for v in got[1])


@quick
@given(st.lists(st.sampled_from(["a", "b", "z", None]), min_size=1, max_size=30))
def test_a_lookup_never_changes_the_row_count(spark, keys):
    dim = spark.createDataFrame([("a", "A"), ("b", None), (None, "N")], "code string, name string")
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = lookup.map_lookup(df, "k", dim, "code", ["name"], "Unknown")
    known = {"a": "A", "b": None}
    assert rows(got) == sorted([(k, known[k] if k in known else "Unknown") for k in keys], key=repr)


@quick
@given(st.lists(st.tuples(st.integers(1, 28), st.integers(1, 5), st.sampled_from(["1.5", "", "x"])), min_size=2, max_size=12))
def test_two_days_together_equal_two_runs(spark, observed):
    lines = [weather_line(f"202501{d:02d}", s, f2=v) for d, s, v in observed]
    frames = [spark.createDataFrame([(v,) for v in part], "value string") for part in (lines, lines[:1], lines[1:])]
    both, first, second = [weather.weather_daily(f) for f in frames]
    assert rows(both) == rows(first.union(second))


@quick
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 3), st.integers(0, 9)), min_size=1, max_size=40))
def test_top_keywords_equal_brute_force(spark, points):
    data = [("여성", f"k{k}", dt.date(2025, 1, 1) - dt.timedelta(days=d * 4), float(v)) for k, d, v in points]
    df = spark.createDataFrame(data, "gender string, keyword_name string, period date, ratio double")
    last = {}
    for _, k, day, ratio in data:
        inside = dt.date(2024, 12, 26) <= day <= dt.date(2025, 1, 2)
        last[k] = max(last.get(k, (dt.date.min, 0.0)), (day, ratio) if inside else (dt.date.min, 0.0))
    wanted = sorted(((-r, k) for k, (_, r) in last.items()))[:2]
    got = trend.top_keywords(df, RUN, n=2).orderBy("position").collect()
    assert [(r.keyword_name, r.last_ratio) for r in got] == [(k, -r) for r, k in wanted]


def test_listing_of_one_platform(spark):
    raw = spark.createDataFrame([(None, None, "x/8_18.json")], f"{schemas.ABLY_ITEM}, source_path string")
    dim = spark.createDataFrame([("8_18", "m", "s")], "code string, master_category_name string, small_category_name string")
    row = product.ably_product_detail(product.ably_listing(raw, dim), RUN).first()
    assert (row.platform, row.product_id, row.master_category_name, row.brand_name_en) == ("ably", None, "m", "")
