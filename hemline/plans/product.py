"""Product details of the three platforms, one listing frame per platform."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hemline.contracts import PRODUCT_DETAIL
from hemline.fixed_values import GENDER_FOLDERS, PLATFORM_ABLY, UNMAPPED_CATEGORY
from hemline.functions.documents import json_parse
from hemline.functions.text import compose_category, translate_name
from hemline.operators.lookup import map_lookup
from hemline.plans import schemas
from hemline.sources.readers import SOURCE_PATH, read_json, read_text, source_key


def read_ably_listing(spark: SparkSession, path: str, **options) -> DataFrame:
    """Pretty-printed item arrays, one file per category code."""
    return read_json(spark, path, schemas.as_text(schemas.ABLY_ITEM), multiline=True, keep_path=True, **options)


def ably_listing(raw: DataFrame, categories: DataFrame) -> DataFrame:
    """Raw items with their category names; a code without names is 'Unknown'.

    ``categories``: code, master_category_name, small_category_name.
    """
    coded = raw.withColumn("category_code", source_key())
    names = ["master_category_name", "small_category_name"]
    return map_lookup(coded, "category_code", categories, "code", names, UNMAPPED_CATEGORY)


def ably_product_detail(listing: DataFrame, run_date: str, mark_bad: bool = False) -> DataFrame:
    return PRODUCT_DETAIL.conform(listing, {
        "platform": F.lit(PLATFORM_ABLY),
        "product_id": "item.like.goods_sno",
        "img_url": "item.image",
        "product_name": "logging.analytics.GOODS_NAME",
        "brand_name_kr": "logging.analytics.MARKET_NAME",
        "brand_name_en": F.lit(""),
        "original_price": "item.first_page_rendering.original_price",
        "final_price": "logging.analytics.SALES_PRICE",
        "discount_ratio": "logging.analytics.DISCOUNT_RATE",
        "review_counting": "logging.analytics.REVIEW_COUNT",
        "review_avg_rating": "logging.analytics.REVIEW_RATING",
        "like_counting": "logging.analytics.LIKES_COUNT",
        "created_at": F.lit(run_date),
    }, mark_bad)


def read_cm29_listing(spark: SparkSession, path: str, **options) -> DataFrame:
    """Pretty-printed product arrays below gender/group folders, one file per category."""
    return read_json(spark, path, schemas.as_text(schemas.CM29_PRODUCT), multiline=True, keep_path=True, **options)


def cm29_listing(raw: DataFrame, categories: DataFrame) -> DataFrame:
    """Raw products with gender (from the folder), category levels and composed name.

    ``categories``: file_key, depth2, depth3, depth4. A file without levels keeps NULLs
    and its composed name is the gender alone.
    """
    folder = F.regexp_extract(SOURCE_PATH, r"/([^/]+)/[^/]+/[^/]+$", 1)
    keyed = raw.withColumns({"gender": translate_name(folder, GENDER_FOLDERS), "file_key": source_key()})
    levels = categories.select(
        F.col("file_key").alias("code"), F.col("depth2").alias("cat_depth_2"),
        F.col("depth3").alias("cat_depth_3"), F.col("depth4").alias("small_category_name"),
    )
    named = map_lookup(keyed, "file_key", levels, "code", ["cat_depth_2", "cat_depth_3", "small_category_name"])
    return named.withColumn("master_category_name", compose_category("gender", "cat_depth_2", "cat_depth_3"))


def cm29_product_detail(listing: DataFrame, mark_bad: bool = False) -> DataFrame:
    return PRODUCT_DETAIL.conform(listing, mark_bad=mark_bad)


def read_musinsa_detail(spark: SparkSession, path: str, **options) -> DataFrame:
    """One JSON record per line, carried as text."""
    return read_text(spark, path, **options)


def musinsa_product_detail(lines: DataFrame, mark_bad: bool = False) -> DataFrame:
    """``lines`` has the JSON text in ``value``; a malformed line gives a row of NULLs."""
    record = lines.select(json_parse("value", schemas.as_text(schemas.MUSINSA_DETAIL)).alias("record")).select("record.*")
    return PRODUCT_DETAIL.conform(record.withColumnsRenamed({
        "image_src": "img_url", "discount_rate": "discount_ratio", "review_count": "review_counting",
    }), mark_bad=mark_bad)
