"""Product rankings of the three platforms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hemline.contracts import RANKING
from hemline.fixed_values import PLATFORM_ABLY, PLATFORM_MUSINSA, RANKED_MODULES_FROM, RANKED_MODULES_TO
from hemline.functions.text import compose_category
from hemline.operators.nested import module_items
from hemline.operators.quality import drop_null_rows
from hemline.plans import schemas
from hemline.sources.readers import read_json, source_key


def ably_ranking(listing: DataFrame, run_date: str, mark_bad: bool = False) -> DataFrame:
    """From the listing frame of ``plans.product.ably_listing``."""
    return RANKING.conform(listing, {
        "platform": F.lit(PLATFORM_ABLY),
        "product_id": "item.like.goods_sno",
        "ranking": "item.ranking",
        "created_at": F.lit(run_date),
    }, mark_bad)


def cm29_ranking(listing: DataFrame, mark_bad: bool = False) -> DataFrame:
    """From the listing frame of ``plans.product.cm29_listing``."""
    return RANKING.conform(listing, mark_bad=mark_bad)


def modules_outside(documents: DataFrame, first: int = RANKED_MODULES_FROM, last: int = RANKED_MODULES_TO) -> DataFrame:
    """One row: modules, and items in them, that ``musinsa_ranking`` leaves out by their position."""
    placed = F.transform("data.modules", lambda m, i: F.struct(i.alias("i"), F.coalesce(F.size(m["items"]), F.lit(0)).alias("n")))
    outside = F.filter(placed, lambda m: (m["i"] < first) | (m["i"] > last))
    items = F.aggregate(outside, F.lit(0), lambda n, m: n + F.greatest(m["n"], F.lit(0)))
    return documents.agg(
        F.coalesce(F.sum(F.size(outside)), F.lit(0)).alias("modules"), F.coalesce(F.sum(items), F.lit(0)).alias("items"))


def read_musinsa_ranking(spark: SparkSession, path: str, **options) -> DataFrame:
    """All category documents in one scan; the category is in the file name."""
    return read_json(spark, path, schemas.as_text(schemas.MUSINSA_RANKING), recursive=True, name_pattern="*.json", keep_path=True, **options)


def musinsa_ranking(
    documents: DataFrame, run_date: str, first: int = RANKED_MODULES_FROM, last: int = RANKED_MODULES_TO, mark_bad: bool = False,
) -> DataFrame:
    """Items of the ranked modules, at positions ``first``..``last``; the modules around them
    (banners, links) hold no ranked items. File names are gender_depth2_depth3_depth4."""
    levels = F.split(source_key(), "_")
    category = compose_category(F.get(levels, 0), F.get(levels, 1), F.get(levels, 2))
    items = module_items(
        documents.withColumn("master_category_name", category), "data.modules", "items", ["master_category_name"],
        first=first, last=last,
    )
    return drop_null_rows(RANKING.conform(items, {
        "platform": F.lit(PLATFORM_MUSINSA),
        "product_id": "item.id",
        "ranking": "item.info.onClickBrandName.eventLog.ga4.payload.index",
        "created_at": F.lit(run_date),
    }, mark_bad))
