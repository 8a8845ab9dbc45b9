"""Gold marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemline.fixed_values import WEATHER_MART_COLUMNS
from hemline.functions.arrays import label_pair
from hemline.functions.dates import month_day
from hemline.functions.text import category_level
from hemline.operators.lookup import broadcast_if_small
from hemline.operators.project import difference

_DETAIL = [
    "img_url", "brand_name_kr", "original_price", "final_price",
    "discount_ratio", "review_counting", "review_avg_rating", "like_counting",
]


def _side(df: DataFrame, prefix: str) -> DataFrame:
    """The frame with prefixed names, so that both join sides may come from one lineage."""
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in df.columns])


def _product_columns() -> list:
    levels = [category_level("p_master_category_name", n).alias(f"cat_depth_{n}") for n in (1, 2, 3)]

    def renamed(prefix: str, names: list[str]) -> list:
        return [F.col(prefix + name).alias(name) for name in names]

    return [
        *renamed("r_", ["platform"]), *levels, *renamed("p_", ["small_category_name"]),
        *renamed("r_", ["product_id"]), *renamed("p_", ["product_name"]), *renamed("r_", ["ranking"]),
        *renamed("p_", _DETAIL), *renamed("r_", ["created_at"]),
    ]


def _same(*names: str):
    return [F.col(f"r_{name}") == F.col(f"p_{name}") for name in names]


def product_ranking_detail(ranking: DataFrame, detail: DataFrame) -> DataFrame:
    """Ranked products with their details, joined on product and platform only: a product
    listed in several categories meets each of its detail rows."""
    joined = _side(ranking, "r_").join(_side(detail, "p_"), _same("product_id", "platform"))
    return joined.select(*_product_columns())


def total_product(ranking: DataFrame, master_category: DataFrame, detail: DataFrame) -> DataFrame:
    """Every ranked product with the details of the same product, platform and category,
    NULL where there are none.

    The category table adds no column and, being distinct, no row: the optimizer drops
    that join.
    """
    known = master_category.select(F.col("master_category_name").alias("r_category")).distinct()
    ranked = _side(ranking, "r_")
    ranked = ranked.join(known, ranked["r_master_category_name"] == known["r_category"], "left")
    same = _same("product_id", "platform", "master_category_name")
    return ranked.join(_side(detail, "p_"), same, "left").select(*_product_columns())


def keyword_trend(trend: DataFrame) -> DataFrame:
    return trend.select("keyword_name", "ratio", month_day("period").alias("period"), "created_at")


def snap_brand_ranking(brands: DataFrame) -> DataFrame:
    """Rank, movement against the previous rank, and up to two labels in one text."""
    labels = F.array_compact(F.array("labels_name_1", "labels_name_2"))
    return brands.select(
        "brand_name", F.col("rank").alias("curr_rank"),
        difference("rank", "previous_rank").alias("prev_diff_rank"),
        "follower_count", label_pair(labels).alias("labels"), "created_at", "img_url",
    )


def weather(daily: DataFrame, stations: DataFrame) -> DataFrame:
    """Daily observations with the station's name; measures rounded to one decimal."""
    side = broadcast_if_small(stations.select("STN_ID", "STN_KO"))
    joined = daily.join(side, daily["STN"] == side["STN_ID"])
    return joined.select(*[
        (F.col(c) if c in ("STN_KO", "TM") else F.round(F.col(c).cast("double"), 1)).alias(name)
        for c, name in WEATHER_MART_COLUMNS.items()
    ])
