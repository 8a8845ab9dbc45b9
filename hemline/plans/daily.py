"""One day from bronze to gold.

``store_unreadable`` keeps the bronze records that can't be read, ``bronze_to_silver`` writes the
silver Parquet of a day, ``load_silver`` refreshes the typed tables from it and stores what they
reject, ``build_gold`` rebuilds the marts. Silver rows carry the names of the columns whose bronze
value no cast could read (``bad_columns``), and the load counts them by table and column.
Every step overwrites its output, so a day can be run again. Errors are not caught.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hemline import contracts
from hemline.fixed_values import (
    GENDER_FEMALE,
    GENDER_MALE,
    GOLD_SCHEMA,
    PLATFORM_29CM,
    PLATFORM_ABLY,
    PLATFORM_MUSINSA,
    SILVER_SCHEMA,
    TOPICS,
    ZONE_BRONZE,
    ZONE_SILVER,
)
from hemline.operators.project import union_all
from hemline.plans import category, marts, product, ranking, review, schemas, snap, trend, video, weather
from hemline.sources.readers import read_parquet, split_unreadable, unreadable_lines, zone_path
from hemline.sources.writers import build_mart, load_table, write_parquet

GENDERS = {"women": GENDER_FEMALE, "men": GENDER_MALE}

# Silver folders a table is loaded from.
_SILVER = {
    "product_detail_tb": ["29cm/product_detail_tb", "musinsa/product_detail_tb", "ably/product_detail_tb"],
    "ranking_tb": ["29cm/ranking_tb", "musinsa/ranking_tb", "ably/ranking_tb"],
    "master_category_tb": ["all/master_category_tb"],
    "sub_category_tb": ["29cm/sub_category_tb"],
    "musinsa_snap_brand_ranking_tb": [TOPICS["snap_brand"]],
    "musinsa_snap_user_ranking_tb": [TOPICS["snap_story_women"], TOPICS["snap_story_men"]],
    "naver_shopping_kwd_tb": [TOPICS["trend_women"], TOPICS["trend_men"]],
    "youtube_video_tb": [TOPICS["video_women"], TOPICS["video_men"]],
    "weather_daily_tb": [TOPICS["weather_daily"]],
    "weather_center_location_tb": [TOPICS["weather_stations"]],
}
_REVIEWS = {
    PLATFORM_29CM: "29cm/29cm_product_review_detail_tb",
    PLATFORM_MUSINSA: "musinsa/musinsa_product_review_detail_tb",
    PLATFORM_ABLY: "ably/ably_product_review_detail_tb",
}


@contextmanager
def _kept(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a parsed frame while several outputs are written from it."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def bronze_to_silver(
    spark: SparkSession, base: str, run_date: str, ably_categories: DataFrame, cm29_categories: DataFrame,
    trend_ids: str | None = None,
) -> None:
    """Write all silver folders of the day.

    ``ably_categories``: code, master_category_name, small_category_name.
    ``cm29_categories``: file_key, depth2, depth3, depth4.
    ``trend_ids``: the table that keeps the ids of keyword results from day to day.
    """

    def bronze(topic: str, *rest: str) -> str:
        return zone_path(base, ZONE_BRONZE, run_date, TOPICS[topic], *rest)

    def silver(folder: str) -> str:
        return zone_path(base, ZONE_SILVER, run_date, folder)

    raw = product.read_ably_listing(spark, bronze("ably_listing", "*/*.json"))
    with _kept(product.ably_listing(raw, ably_categories)) as listing:
        write_parquet(product.ably_product_detail(listing, run_date, mark_bad=True), silver("ably/product_detail_tb"))
        write_parquet(ranking.ably_ranking(listing, run_date, mark_bad=True), silver("ably/ranking_tb"))

    raw = product.read_cm29_listing(spark, bronze("cm29_listing", "*/*/*.json"))
    with _kept(product.cm29_listing(raw, cm29_categories)) as listing:
        write_parquet(product.cm29_product_detail(listing, mark_bad=True), silver("29cm/product_detail_tb"))
        write_parquet(ranking.cm29_ranking(listing, mark_bad=True), silver("29cm/ranking_tb"))
        write_parquet(category.cm29_master_category(listing), silver("29cm/master_category_tb"))
        write_parquet(category.cm29_sub_category(listing, mark_bad=True), silver("29cm/sub_category_tb"))

    documents = ranking.read_musinsa_ranking(spark, bronze("musinsa_ranking"))
    write_parquet(ranking.musinsa_ranking(documents, run_date, mark_bad=True), silver("musinsa/ranking_tb"), ["master_category_name"])
    lines = product.read_musinsa_detail(spark, bronze("musinsa_detail", "*/*/*.json"))
    write_parquet(product.musinsa_product_detail(lines, mark_bad=True), silver("musinsa/product_detail_tb"))

    rankings = [read_parquet(spark, silver(f), ["master_category_name"]) for f in _SILVER["ranking_tb"]]
    write_parquet(category.master_category(rankings), silver("all/master_category_tb"))

    reviews = {
        PLATFORM_ABLY: review.ably_reviews(
            review.read_ably_reviews(spark, bronze("ably_reviews", "*/reviews_*.json")), run_date, mark_bad=True
        ),
        PLATFORM_29CM: review.cm29_reviews(
            review.read_cm29_reviews(spark, bronze("cm29_reviews", "*/*/*_reviews.json")), mark_bad=True
        ),
        PLATFORM_MUSINSA: review.musinsa_reviews(
            review.read_musinsa_reviews(spark, bronze("musinsa_reviews")), run_date, mark_bad=True
        ),
    }
    for platform, frame in reviews.items():
        write_parquet(frame, silver(_REVIEWS[platform]))

    pages = snap.read_brand_pages(spark, bronze("snap_brand", "*.json"))
    write_parquet(snap.brand_ranking(pages, run_date, mark_bad=True), silver(TOPICS["snap_brand"]))
    for suffix, gender in GENDERS.items():
        stories = snap.read_story_pages(spark, bronze(f"snap_story_{suffix}"))
        write_parquet(snap.story_ranking(stories, gender, run_date, mark_bad=True), silver(TOPICS[f"snap_story_{suffix}"]))
        results = trend.read_trend(spark, bronze(f"trend_{suffix}", "*.json"))
        if trend_ids:
            trend.register_results(results, gender, trend_ids, f"{base.rstrip('/')}/dim/{trend_ids}")
        write_parquet(
            trend.keyword_trend(results, gender, run_date, mark_bad=True, dictionary=trend_ids), silver(TOPICS[f"trend_{suffix}"]))
        found = video.read_videos(spark, bronze(f"video_{suffix}"))
        write_parquet(video.videos(found, gender, run_date), silver(TOPICS[f"video_{suffix}"]))

    observations = weather.read_weather_lines(spark, bronze("weather_daily", "*.txt"))
    write_parquet(weather.weather_daily(observations, mark_bad=True), silver(TOPICS["weather_daily"]))
    stations = weather.read_weather_lines(spark, bronze("weather_stations"))
    write_parquet(weather.weather_stations(stations, mark_bad=True), silver(TOPICS["weather_stations"]))


#: How each JSON topic is read, and the files below its folder.
_JSON_TOPICS = {
    "ably_listing": (product.read_ably_listing, "*/*.json"),
    "ably_reviews": (review.read_ably_reviews, "*/reviews_*.json"),
    "cm29_listing": (product.read_cm29_listing, "*/*/*.json"),
    "cm29_reviews": (review.read_cm29_reviews, "*/*/*_reviews.json"),
    "musinsa_ranking": (ranking.read_musinsa_ranking, ""),
    "musinsa_reviews": (review.read_musinsa_reviews, ""),
    "snap_brand": (snap.read_brand_pages, "*.json"),
    "snap_story_women": (snap.read_story_pages, ""),
    "snap_story_men": (snap.read_story_pages, ""),
    "trend_women": (trend.read_trend, "*.json"),
    "trend_men": (trend.read_trend, "*.json"),
    "video_women": (video.read_videos, ""),
    "video_men": (video.read_videos, ""),
}


def store_unreadable(spark: SparkSession, base: str, run_date: str) -> DataFrame:
    """Write the day's bronze records that can't be read to ``rejected/<day>/records``, by topic.

    Returns the stored rows: topic, source_path, piece_start, record, readable, reason. One more
    parse of the day's JSON; nothing is shuffled but the rejects.
    """
    def path(topic: str, rest: str) -> str:
        return zone_path(base, ZONE_BRONZE, run_date, TOPICS[topic], *([rest] if rest else []))

    parts = []
    for topic, (read, rest) in _JSON_TOPICS.items():
        _, rejects = split_unreadable(read(spark, path(topic, rest), keep_unreadable=True))
        parts.append(rejects.select(F.lit(topic).alias("topic"), "*"))
    lines = product.read_musinsa_detail(spark, path("musinsa_detail", "*/*/*.json"), keep_path=True)
    parts.append(unreadable_lines(lines, schemas.as_text(schemas.MUSINSA_DETAIL)).select(F.lit("musinsa_detail").alias("topic"), "*"))
    target = zone_path(base, "rejected", run_date, "records")
    rejects = union_all(parts)
    write_parquet(rejects, target, ["topic"])
    return spark.read.schema(rejects.schema).parquet(target)


def load_silver(spark: SparkSession, base: str, run_date: str, schema: str = SILVER_SCHEMA) -> None:
    """Refresh every silver table from the day's folders. Rejected rows go to the
    ``rejected`` zone with their reasons, the counts of broken rules to ``reports``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")

    def frame(folder: str) -> DataFrame:
        return read_parquet(spark, zone_path(base, ZONE_SILVER, run_date, folder))

    sources = {table: [frame(f) for f in folders] for table, folders in _SILVER.items()}
    sources[contracts.PLATFORM_REVIEW_DETAIL.name] = [
        frame(folder).withColumn("platform", F.lit(platform)) for platform, folder in _REVIEWS.items()
    ]
    for table, frames in sources.items():
        location = f"{base.rstrip('/')}/tables/{schema}/{table}"
        loaded = load_table(contracts.CONTRACTS[table], frames, f"{schema}.{table}", location)
        write_parquet(loaded.rejected, zone_path(base, "rejected", run_date, table))
        write_parquet(loaded.report, zone_path(base, "reports", run_date, table))


def build_gold(
    spark: SparkSession, base: str, silver_schema: str = SILVER_SCHEMA, gold_schema: str = GOLD_SCHEMA
) -> None:
    """Rebuild every mart from the silver tables."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {gold_schema}")

    def silver(table: str) -> DataFrame:
        return spark.table(f"{silver_schema}.{table}")

    built: dict[str, Callable[[], DataFrame]] = {
        "total_product_gold_tb": lambda: marts.total_product(
            silver("ranking_tb"), silver("master_category_tb"), silver("product_detail_tb")
        ),
        "product_ranking_detail_gold_tb": lambda: marts.product_ranking_detail(
            silver("ranking_tb"), silver("product_detail_tb")
        ),
        "naver_shopping_kwd_tb": lambda: marts.keyword_trend(silver("naver_shopping_kwd_tb")),
        "musinsa_snap_brand_ranking_tb": lambda: marts.snap_brand_ranking(silver("musinsa_snap_brand_ranking_tb")),
        "weather_gold_tb": lambda: marts.weather(silver("weather_daily_tb"), silver("weather_center_location_tb")),
    }
    for table, mart in built.items():
        build_mart(mart(), f"{gold_schema}.{table}", f"{base.rstrip('/')}/tables/{gold_schema}/{table}")
