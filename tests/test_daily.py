"""A whole invented day: bronze files -> silver -> tables -> marts, against hand-written rows."""

import datetime as dt
import json

import pytest
from bronze_day import ABLY_CATEGORIES, CM29_CATEGORIES, RUN_DATE, write_day
from conftest import rows

from hemline.contracts import CONTRACTS
from hemline.plans import daily

DAY = dt.date(2025, 1, 2)


@pytest.fixture(scope="module")
def day(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("day"))
    write_day(base)
    ably = spark.createDataFrame(ABLY_CATEGORIES, "code string, master_category_name string, small_category_name string")
    cm29 = spark.createDataFrame(CM29_CATEGORIES, "file_key string, depth2 string, depth3 string, depth4 string")

    def run():
        daily.bronze_to_silver(spark, base, RUN_DATE, ably, cm29)
        daily.load_silver(spark, base, RUN_DATE, "silver_test")
        daily.build_gold(spark, base, "silver_test", "gold_test")

    run()
    return base, run


def table(spark, name, *columns):
    df = spark.table(name)
    return rows(df.select(*columns) if columns else df)


def rejects(spark, base, name):
    return rows(spark.read.parquet(f"{base}/rejected/{RUN_DATE}/{name}").select("reject_reasons"))


def test_tables_have_the_contract_columns(spark, day):
    for name, contract in CONTRACTS.items():
        if name != "product_review_detail_tb":
            df = spark.table(f"silver_test.{name}")
            assert df.dtypes == [(f.name, f.type) for f in contract.fields], name


def test_product_detail(spark, day):
    base, _ = day
    got = table(spark, "silver_test.product_detail_tb", "platform", "master_category_name", "small_category_name",
                "product_id", "original_price", "discount_ratio", "review_avg_rating", "created_at")
    assert got == sorted([
        ("ably", "여성-상의-티셔츠", "반소매", 1, 15000, 10, 4.5, DAY),
        ("ably", "여성-상의-티셔츠", "반소매", 2, 17000, 10, 4.5, DAY),
        ("ably", "Unknown", "Unknown", 1, 15000, 10, 4.5, DAY),
        ("29CM", "남성-아우터-자켓", "블레이저", 10, 20000, 25, 4.25, DAY),
        ("29CM", "여성-아우터-자켓", "블레이저", 10, 20000, 25, 4.25, DAY),
        ("29CM", "여성", None, 12, 20000, 25, 4.25, DAY),
        ("musinsa", "여성-상의-셔츠", "셔츠&블라우스", 101, 30000, 20, 4.8, DAY),
    ], key=repr)
    assert rejects(spark, base, "product_detail_tb") == sorted([
        (["product_id:null"],),
        (["product_name:null"],),
        (["product_name:too_long"],),
        (["platform:null", "product_id:null", "product_name:null", "created_at:null"],),
    ], key=repr)


def test_reports_count_broken_rules(spark, day):
    base, _ = day
    report = spark.read.parquet(f"{base}/reports/{RUN_DATE}/product_detail_tb")
    assert [tuple(r) for r in report.where("bad_rows > 0").orderBy("column_name", "rule").collect()] == [
        ("created_at", "null", 1), ("platform", "null", 1), ("product_id", "null", 2), ("product_name", "null", 2),
        ("product_name", "too_long", 1),
    ]
    keys = spark.read.parquet(f"{base}/reports/{RUN_DATE}/weather_daily_tb").where("rule = 'duplicate_key'")
    assert rows(keys) == [("TM,STN", "duplicate_key", 0)]


def test_ranking(spark, day):
    got = table(spark, "silver_test.ranking_tb", "platform", "master_category_name", "product_id", "ranking")
    musinsa = [("musinsa", "여성-상의-셔츠", 100 + i, i) for i in range(1, 18) if i not in (3, 4, 5, 6)]
    musinsa += [("musinsa", "여성-상의-셔츠", 206, 7), ("musinsa", "남성-상의-셔츠", 101, 1), ("musinsa", "남성-상의-셔츠", 102, 2)]
    assert got == sorted(musinsa + [
        ("ably", "여성-상의-티셔츠", 1, 1), ("ably", "여성-상의-티셔츠", 2, 2), ("ably", "Unknown", 1, 5),
        ("29CM", "남성-아우터-자켓", 10, 1), ("29CM", "남성-아우터-자켓", 11, 2), ("29CM", "여성-아우터-자켓", 10, 3), ("29CM", "여성", 12, 1),
    ], key=repr)


def test_categories(spark, day):
    assert table(spark, "silver_test.master_category_tb") == sorted([
        ("여성-상의-티셔츠", "여성", "상의", "티셔츠"), ("Unknown", "Unknown", "", ""), ("남성-아우터-자켓", "남성", "아우터", "자켓"),
        ("여성-아우터-자켓", "여성", "아우터", "자켓"), ("여성", "여성", "", ""), ("여성-상의-셔츠", "여성", "상의", "셔츠"),
        ("남성-상의-셔츠", "남성", "상의", "셔츠"),
    ], key=repr)
    assert table(spark, "silver_test.sub_category_tb") == sorted([
        ("Blazers", "29CM", "남성-아우터-자켓", "블레이저", DAY), ("Blazers", "29CM", "여성-아우터-자켓", "블레이저", DAY),
        ("Unlisted", "29CM", "여성", None, DAY),
    ], key=repr)


def test_reviews(spark, day):
    got = table(spark, "silver_test.platform_product_review_detail_tb", "platform", "product_id", "review_content",
                "review_rating", "review_date", "reviewer_height", "reviewer_weight", "selected_options")
    assert got == sorted([
        ("ably", 1, "좋아요", 5, dt.date(2025, 1, 1), 160.0, None, "블랙, M"),
        ("ably", 1, None, None, None, None, 50.0, ""),
        ("29CM", 10, "굿", 4, dt.date(2024, 12, 31), 170.0, 60.0, "네이비"),
        ("29CM", 10, "음", 2, dt.date(2024, 12, 30), None, None, None),
        ("musinsa", 101, "첫", 5, DAY, 175.0, 60.0, "M"),
        ("musinsa", 101, "둘", 5, DAY, None, 60.0, "M"),
    ], key=repr)


def test_snaps(spark, day):
    assert table(spark, "silver_test.musinsa_snap_brand_ranking_tb", "brand_id", "rank", "previous_rank", "labels_name_1", "labels_name_2") == [
        ("a", 1, 3, "미니멀", "스포티"), ("b", 2, 0, "걸리시", None), ("c", 3, 1, None, None),
    ]
    assert table(spark, "gold_test.musinsa_snap_brand_ranking_tb", "brand_name", "curr_rank", "prev_diff_rank", "labels") == [
        ("A", 1, -2, "미니멀, 스포티"), ("B", 2, 2, "걸리시"), ("C", 3, 2, None),
    ]
    assert table(spark, "silver_test.musinsa_snap_user_ranking_tb", "story_id", "aggregation_like_count", "tags", "gender") == [
        (1, 9, "겨울,코디", "여성"), (11, None, "", "여성"), (12, None, "", "남성"), (2, 9, "겨울,코디", "남성"),
    ]


def test_trend(spark, day):
    got = spark.table("silver_test.naver_shopping_kwd_tb").collect()
    assert sorted((r.gender, r.keyword_name, r.period, r.ratio, r.category_code) for r in got) == sorted(
        (g, w, dt.date(2025, 1, d), 50.5 if d == 1 else 100.0, 50000000)
        for g, w in (("여성", "니트"), ("여성", "코트"), ("남성", "슬랙스")) for d in (1, 2)
    )
    ids = {(r.gender, r.keyword_name): r.trend_id for r in got}
    assert len({(g, i) for (g, _), i in ids.items()}) == 3
    assert ("코트", 100.0, "01-02", DAY) in table(spark, "gold_test.naver_shopping_kwd_tb")


def test_videos(spark, day):
    got = table(spark, "silver_test.youtube_video_tb", "gender", "category_name", "duration_seconds", "published_at", "view_count")
    assert got == sorted([
        (g, f"{g}_아우터_자켓_점퍼", 300, dt.datetime(2025, 1, 1, 10), 1234) for g in ("여성", "남성")
    ], key=repr)


def test_weather(spark, day):
    base, _ = day
    got = table(spark, "silver_test.weather_daily_tb", "TM", "STN", "WS_AVG", "TA_AVG", "RN_DAY", "RN_POW_MAX")
    first = dt.date(2025, 1, 1)
    assert got == [(first, 105, 1.0, 0.0, 0.0, 0.0), (first, 108, 0.0, 0.0, 0.0, 0.0), (first, 90, 1.5, 2.25, 12.25, 0.0)]
    assert rejects(spark, base, "weather_daily_tb") == [(["TM:null"],)]
    assert table(spark, "silver_test.weather_center_location_tb") == [(108, "서울"), (90, "속초")]
    assert rejects(spark, base, "weather_center_location_tb") == [(["STN_KO:null"],)]
    assert table(spark, "gold_test.weather_gold_tb") == [
        ("서울", first, 0.0, 0.0, 0.0, 0.0), ("속초", first, 2.3, 7.1, -3.4, 12.3),
    ]


def test_product_marts(spark, day):
    left = table(spark, "gold_test.total_product_gold_tb", "platform", "cat_depth_1", "cat_depth_2", "product_id", "ranking", "final_price")
    assert len(left) == spark.table("silver_test.ranking_tb").count()
    assert ("ably", "Unknown", "", 1, 5, 10000) in left
    assert ("29CM", "남성", "아우터", 10, 1, 15000) in left
    assert ("29CM", None, None, 11, 2, None) in left
    inner = table(spark, "gold_test.product_ranking_detail_gold_tb", "platform", "product_id", "ranking", "cat_depth_1")
    # Product 10 is ranked in two categories and described in two: four rows.
    assert [r for r in inner if r[1] == 10] == sorted(
        [("29CM", 10, rank, gender) for rank in (1, 3) for gender in ("남성", "여성")], key=repr)


def test_a_day_can_be_run_again(spark, day):
    _, run = day
    names = [f"silver_test.{n}" for n in CONTRACTS if n != "product_review_detail_tb"]
    names += [f"gold_test.{r.tableName}" for r in spark.sql("show tables in gold_test").collect()]
    before = {n: table(spark, n) for n in names}
    run()
    for n in names:
        spark.catalog.refreshTable(n)
        assert table(spark, n) == before[n], n


def test_every_job_runs_from_the_command_line(spark, day, tmp_path):
    from hemline import run

    base, _ = day
    (tmp_path / "ably.csv").write_text("code,master_category_name,small_category_name\n" + "\n".join(",".join(r) for r in ABLY_CATEGORIES))
    (tmp_path / "cm29.csv").write_text("file_key,depth2,depth3,depth4\n" + "\n".join(",".join(r) for r in CM29_CATEGORIES))
    zone = f"{base}/bronze/{RUN_DATE}"
    sources = {
        "ably_product_detail": "ably/ranking_data/*/*.json", "ably_ranking": "ably/ranking_data/*/*.json",
        "ably_reviews": "ably/review_data/*/*.json", "musinsa_ranking": "musinsa/ranking_data",
        "musinsa_product_detail": "musinsa/product_detail_data/*/*/*.json", "musinsa_reviews": "musinsa/product_review_data",
        "cm29_reviews": "29cm/29cm_reviews/*/*/*.json", "snap_brand_ranking": "otherapis/musinsa_snap_brand_ranking_raw_data/*.json",
        "snap_story_ranking": "otherapis/musinsa_MEN_ranking_story_group_raw_data", "keyword_trend": "otherapis/남성_keyword_trends/*.json",
        "videos": "otherapis/남성_youtoube_videos_by_categories_raw_data", "weather_daily": "otherapis/weekly_weather_data_raw_data/*.txt",
        "weather_stations": "otherapis/weather_station_data_raw_data",
    }
    for name in run.DAY_JOBS:
        source = f"{zone}/{sources.get(name, '29cm/29cm_product/*/*/*.json')}"
        categories = tmp_path / ("ably.csv" if name.startswith("ably") else "cm29.csv")
        target = str(tmp_path / name)
        run.main(["job", name, source, target, "--run-date", RUN_DATE, "--gender", "남성", "--categories", str(categories)], spark)
        assert spark.read.parquet(target).count() > 0, name


def test_a_bad_value_of_bronze_is_counted_by_the_load(spark, tmp_path):
    """From the payload through silver Parquet to the table's report, with three sources of one table."""
    from bronze_day import ably_item, cm29_product, detail, line, pretty, put

    from hemline.plans import product
    from hemline.sources.writers import load_table, write_parquet

    base = str(tmp_path)
    bad = ably_item(3, 3, "원피스")
    bad["logging"]["analytics"] |= {"SALES_PRICE": "n/a", "REVIEW_RATING": "good", "LIKES_COUNT": ""}
    put(base, "ably", "8_18.json", pretty([bad, ably_item(1, 1, "티셔츠")]))
    put(base, "29cm", "Man/Outer/Blazers.json", pretty([cm29_product(10, 1) | {"final_price": "n/a", "created_at": "today"}]))
    put(base, "musinsa", "104.json", line(detail(104, "여성-상의-셔츠", like_counting="many", original_price="?")))
    zone = f"{base}/bronze/{RUN_DATE}"
    ably = spark.createDataFrame(ABLY_CATEGORIES, "code string, master_category_name string, small_category_name string")
    cm29 = spark.createDataFrame(CM29_CATEGORIES, "file_key string, depth2 string, depth3 string, depth4 string")
    frames = [
        product.ably_product_detail(product.ably_listing(product.read_ably_listing(spark, f"{zone}/ably/*.json"), ably), RUN_DATE, mark_bad=True),
        product.cm29_product_detail(product.cm29_listing(product.read_cm29_listing(spark, f"{zone}/29cm/*/*/*.json"), cm29), mark_bad=True),
        product.musinsa_product_detail(product.read_musinsa_detail(spark, f"{zone}/musinsa/*.json"), mark_bad=True),
    ]
    for i, frame in enumerate(frames):
        write_parquet(frame, f"{base}/silver/{i}")
    silver = [spark.read.parquet(f"{base}/silver/{i}") for i in range(3)]
    assert rows(silver[0].where("product_id = 3").select("final_price", "like_counting", "bad_columns")) == [
        (None, None, ["final_price", "review_avg_rating"])]
    report = load_table(CONTRACTS["product_detail_tb"], silver, "bad_values_test", f"{base}/table").report
    assert {r["column_name"]: r["bad_rows"] for r in report.where("rule = 'bad_value' and bad_rows > 0").collect()} == {
        "final_price": 2, "review_avg_rating": 1, "like_counting": 1, "created_at": 1, "original_price": 1}


def test_every_job_marks_what_it_cannot_read(spark):
    from hemline.plans import ranking, review, schemas, snap, trend, video

    def payload(text, schema):
        one = spark.createDataFrame([(text,)], "value string")
        return one.selectExpr(f"from_json(value, '{' '.join(schemas.as_text(schema).split())}') as r").select("r.*")

    def marked(df):
        return sorted(tuple(sorted(r["bad_columns"])) for r in df.collect())

    brand = {"id": "d", "ranking": {"rank": 4, "previousRank": "none"}, "followerCount": "5k", "snaps": []}
    assert marked(snap.brand_ranking(payload(json.dumps({"data": {"list": [brand]}}), schemas.SNAP_BRAND), RUN_DATE, mark_bad=True)) == [
        ("follower_count", "previous_rank")]
    story = {"id": "s1", "aggregations": {"likeCount": 3}}
    assert marked(snap.story_ranking(payload(json.dumps({"data": {"list": [story]}}), schemas.SNAP_STORY), "MEN", RUN_DATE, mark_bad=True)) == [("story_id",)]
    result = {"startDate": "2024-12-26", "endDate": "x", "timeUnit": "date", "results": [
        {"keyword": ["패딩"], "data": [{"period": "2025-01-32", "ratio": "high"}, {"period": "2025-01-01", "ratio": 1}]}]}
    assert marked(trend.keyword_trend(payload(json.dumps(result), schemas.KEYWORD_TREND), "men", RUN_DATE, mark_bad=True)) == [
        ("end_date",), ("end_date", "period", "ratio")]
    assert marked(review.ably_reviews(payload(json.dumps(
        {"goods_sno": 1, "eval": "bad", "created_at": "not a date", "height": " ", "weight": 50}), schemas.ABLY_REVIEW), RUN_DATE, mark_bad=True)) == [
        ("review_date", "review_rating")]
    assert marked(review.cm29_reviews(payload(json.dumps(
        {"product_id": 1, "insertTimestamp": "", "userSize": ["tall", "60kg"]}), schemas.CM29_REVIEW), mark_bad=True)) == [("reviewer_height",)]
    musinsa = {"list": [{"goods": {"goodsNo": 7}, "grade": "5", "createDate": "2025-01-01T10:00:00", "userProfileInfo": {"userWeight": "?"}}]}
    assert marked(review.musinsa_reviews(payload(json.dumps(musinsa), schemas.MUSINSA_REVIEW), RUN_DATE, mark_bad=True)) == [
        ("review_date", "reviewer_weight")]
    assert marked(video.videos(payload(json.dumps({"videoId": "v", "publishedAt": "soon", "viewCount": "1,234"}), schemas.VIDEO), "남성", RUN_DATE, mark_bad=True)) == [
        ("published_at", "view_count")]
    item = payload(json.dumps({"item": {"like": {"goods_sno": 5}, "ranking": "first"}}), schemas.ABLY_ITEM).selectExpr("*", "'c' as master_category_name")
    assert marked(ranking.ably_ranking(item, RUN_DATE, mark_bad=True)) == [("ranking",)]


def test_unreadable_records_are_kept(spark, tmp_path):
    from bronze_day import put

    base = str(tmp_path)
    write_day(base)
    put(base, "ably/ranking_data", "8_20/8_20.json", '[{"item": {"like"')
    put(base, "otherapis/musinsa_snap_brand_ranking_raw_data", "page_3.json", "{]\n{\"data\": 5}\n")
    kept = daily.store_unreadable(spark, base, RUN_DATE)
    assert rows(kept.select("topic", "reason", "record")) == sorted([
        ("ably_listing", "unreadable_record", '[{"item": {"like"'), ("snap_brand", "unreadable_record", "{]"),
        ("snap_brand", "unreadable_record", '{"data": 5}'), ("musinsa_detail", "unreadable_record", "<html>denied</html>")], key=repr)
    assert all(r["source_path"].endswith(".json") for r in kept.collect())
