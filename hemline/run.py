"""Command line, for spark-submit or ``python -m hemline.run``.

    day  BASE [--run-date D] --ably-categories CSV --cm29-categories CSV
    job  NAME SOURCE TARGET [--run-date D] [--gender G] [--categories CSV] [--limit N]

``day`` runs bronze to gold below BASE. ``job`` runs one job, from raw payloads or from a
silver table, from a source path (wildcards allowed) to a Parquet folder. The run date defaults to today
in the business time zone.
"""

from __future__ import annotations

import argparse
from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession

from hemline.fixed_values import BUSINESS_ZONE, ITEM_COMPONENT_ID, NEWEST_REVIEWS
from hemline.operators.nested import components_of_kind
from hemline.plans import category, collect, daily, product, ranking, review, snap, trend, video, weather
from hemline.session import build_session
from hemline.sources.readers import SOURCE_PATH, read_csv, read_json, read_parquet, source_key
from hemline.sources.writers import write_parquet

ABLY_DIMENSION = "code string, master_category_name string, small_category_name string"
CM29_DIMENSION = "file_key string, depth2 string, depth3 string, depth4 string"


def today() -> str:
    return datetime.now(ZoneInfo(BUSINESS_ZONE)).date().isoformat()


def _ably(spark, a) -> DataFrame:
    return product.ably_listing(product.read_ably_listing(spark, a.source), read_csv(spark, a.categories, ABLY_DIMENSION))


def _cm29(spark, a) -> DataFrame:
    return product.cm29_listing(product.read_cm29_listing(spark, a.source), read_csv(spark, a.categories, CM29_DIMENSION))


def _pages(spark, a) -> DataFrame:
    """Pages of components, with the category their file is named after."""
    return read_json(spark, a.source, multiline=True, keep_path=True).withColumn("category", source_key())


#: Jobs over raw payloads and silver tables.
COLLECT_JOBS = {
    # from raw payloads
    "listing_products": lambda s, a: collect.listing_products(read_json(s, a.source, multiline=True), a.run_date),
    "page_products": lambda s, a: collect.page_products(collect.read_pages(s, a.source), keep=[SOURCE_PATH]),
    "listing_items": lambda s, a: collect.listing_items(_pages(s, a), "category", SOURCE_PATH),
    "product_work_list": lambda s, a: collect.product_work_list(
        components_of_kind(_pages(s, a), "components", ITEM_COMPONENT_ID, keep=["category"]), "category"),
    "select_videos": lambda s, a: video.select_videos(
        read_json(s, a.source, multiline=True, keep_path=True).withColumn("category_name", source_key())),
    "category_groups": lambda s, a: collect.category_groups(
        collect.category_tuples(read_json(s, a.source, collect.CATEGORY_TREE, multiline=True, keep_path=True), "tree", SOURCE_PATH)),
    # from silver tables
    "newest_reviews": lambda s, a: collect.newest_reviews(
        read_parquet(s, a.source), "product_id", "review_date", "review_content", a.limit),
    "top_keywords": lambda s, a: trend.top_keywords(read_parquet(s, a.source), a.run_date),
    "top_keywords_rescaled": lambda s, a: trend.top_keywords_rescaled(read_parquet(s, a.source), a.run_date),
}

#: Bronze to silver.
DAY_JOBS = {
    "ably_product_detail": lambda s, a: product.ably_product_detail(_ably(s, a), a.run_date),
    "ably_ranking": lambda s, a: ranking.ably_ranking(_ably(s, a), a.run_date),
    "ably_reviews": lambda s, a: review.ably_reviews(review.read_ably_reviews(s, a.source), a.run_date),
    "cm29_product_detail": lambda s, a: product.cm29_product_detail(_cm29(s, a)),
    "cm29_ranking": lambda s, a: ranking.cm29_ranking(_cm29(s, a)),
    "cm29_master_category": lambda s, a: category.cm29_master_category(_cm29(s, a)),
    "cm29_sub_category": lambda s, a: category.cm29_sub_category(_cm29(s, a)),
    "cm29_reviews": lambda s, a: review.cm29_reviews(review.read_cm29_reviews(s, a.source)),
    "musinsa_product_detail": lambda s, a: product.musinsa_product_detail(product.read_musinsa_detail(s, a.source)),
    "musinsa_reviews": lambda s, a: review.musinsa_reviews(review.read_musinsa_reviews(s, a.source), a.run_date),
    "musinsa_ranking": lambda s, a: ranking.musinsa_ranking(ranking.read_musinsa_ranking(s, a.source), a.run_date),
    "snap_brand_ranking": lambda s, a: snap.brand_ranking(snap.read_brand_pages(s, a.source), a.run_date),
    "snap_story_ranking": lambda s, a: snap.story_ranking(snap.read_story_pages(s, a.source), a.gender, a.run_date),
    "keyword_trend": lambda s, a: trend.keyword_trend(trend.read_trend(s, a.source), a.gender, a.run_date),
    "videos": lambda s, a: video.videos(video.read_videos(s, a.source), a.gender, a.run_date),
    "weather_daily": lambda s, a: weather.weather_daily(weather.read_weather_lines(s, a.source)),
    "weather_stations": lambda s, a: weather.weather_stations(weather.read_weather_lines(s, a.source)),
}

JOBS = COLLECT_JOBS | DAY_JOBS


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="hemline", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = top.add_subparsers(dest="command", required=True)
    day = commands.add_parser("day")
    day.add_argument("base")
    day.add_argument("--run-date", default=today())
    day.add_argument("--ably-categories", required=True)
    day.add_argument("--cm29-categories", required=True)
    day.add_argument("--trend-ids", help="table that keeps the ids of keyword results; without it they hold for one day")
    job = commands.add_parser("job")
    job.add_argument("name", choices=sorted(JOBS))
    job.add_argument("source")
    job.add_argument("target")
    job.add_argument("--run-date", default=today())
    job.add_argument("--gender")
    job.add_argument("--categories")
    job.add_argument("--limit", type=int, default=NEWEST_REVIEWS["ably"])
    return top


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(arguments)
    spark = spark or build_session("hemline")
    if a.command == "job":
        write_parquet(JOBS[a.name](spark, a), a.target)
        return
    dimensions = read_csv(spark, a.ably_categories, ABLY_DIMENSION), read_csv(spark, a.cm29_categories, CM29_DIMENSION)
    daily.store_unreadable(spark, a.base, a.run_date)
    daily.bronze_to_silver(spark, a.base, a.run_date, *dimensions, trend_ids=a.trend_ids)
    daily.load_silver(spark, a.base, a.run_date)
    daily.build_gold(spark, a.base)


if __name__ == "__main__":
    main()
