"""Records and work lists from raw payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hemline.fixed_values import (
    BRAND_LINK_MARK,
    EXCLUDED_MEDIUM_CATEGORIES,
    EXCLUDED_SMALL_CATEGORIES,
    IMAGE_HOST_29CM,
    ITEM_COMPONENT_ID,
    LARGE_CATEGORY_FEMALE,
    LARGE_CATEGORY_MALE,
    LISTING_SIZE,
    PAGE_JSON_ID,
    PAGE_META,
    PAGE_REVIEW_PATH,
    PAGE_TITLE_SUFFIX,
    PLATFORM_29CM,
    PRODUCT_BATCH_SIZE,
)
from hemline.functions.arrays import distinct_names, membership_flag
from hemline.functions.documents import json_path, page_fields
from hemline.functions.text import text_after
from hemline.operators.nested import enumerate_items, tree_leaves
from hemline.operators.quality import keep_present, skip_empty
from hemline.operators.ranking import item_batches, last_wins, top_n
from hemline.sources.readers import SOURCE_PATH


def listing_products(listings: DataFrame, run_date: str, keep: list[str] | None = None) -> DataFrame:
    """Product records of raw listings; the rank is the position in the listing."""
    keep = keep or []
    filled = skip_empty(listings, items="data.products")
    ranked = enumerate_items(filled, "data.products", keep, "p", "ranking")
    categories = F.col("p.frontCategoryInfo")

    def names(field: str):
        return F.transform(categories, lambda c: c[field])

    def kept_names(field: str, excluded: list[str]):
        return F.coalesce(distinct_names(names(field), excluded), F.array().cast("array<string>"))

    return ranked.select(
        *keep, "ranking",
        F.col("p.itemNo").alias("product_id"),
        F.col("p.itemName").alias("product_name"),
        F.col("p.frontBrandNo").alias("frontBrandNo"),
        F.col("p.frontBrandNameKor").alias("brand_name_kr"),
        F.col("p.frontBrandNameEng").alias("brand_name_en"),
        F.col("p.consumerPrice").alias("original_price"),
        F.col("p.lastSalePrice").alias("final_price"),
        F.col("p.lastSalePercent").alias("discount_ratio"),
        F.col("p.reviewCount").alias("review_counting"),
        F.col("p.reviewAveragePoint").alias("review_avg_rating"),
        F.col("p.heartCount").alias("like_counting"),
        membership_flag(
            names("categoryLargeName"), LARGE_CATEGORY_MALE, LARGE_CATEGORY_FEMALE, ("M/W", "M", "W")
        ).alias("gender"),
        kept_names("categoryMediumName", EXCLUDED_MEDIUM_CATEGORIES).alias("categoryMediumNames"),
        kept_names("categorySmallName", EXCLUDED_SMALL_CATEGORIES).alias("categorySmallNames"),
        F.lit(PLATFORM_29CM).alias("platform"),
        F.lit(run_date).alias("created_at"),
        F.concat(F.lit(IMAGE_HOST_29CM), "p.imageUrl").alias("img_url"),
        F.col("p.isSoldOut").alias("soldout_status"),
        F.col("p.isNew").alias("isNew"),
    )


def read_pages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per HTML file: its text in ``html`` and where it came from."""
    pages = spark.read.option("wholetext", True).text(path)
    return pages.select(F.col("value").alias("html"), F.col("_metadata.file_path").alias(SOURCE_PATH))


def page_products(pages: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """Product fields of HTML pages; what a page lacks is NULL.

    The English brand name is the slug of the first brand link.
    """
    parts = page_fields(pages, html, list(PAGE_META.values()), PAGE_JSON_ID, keep)
    brand_link = F.get(F.filter("links", lambda link: link.contains(BRAND_LINK_MARK)), 0)
    found = parts.select(
        *(keep or []),
        F.regexp_replace("title", PAGE_TITLE_SUFFIX, "").alias("product_name"),
        text_after(brand_link, BRAND_LINK_MARK).alias("brand_name_en"),
        *[F.get("meta", i).alias(name) for i, name in enumerate(PAGE_META)],
        json_path("script", PAGE_REVIEW_PATH).alias("_review"),
    )
    return found.select(
        "*",
        json_path("_review", "$.totalCount").alias("review_count"),
        json_path("_review", "$.satisfactionScore").alias("review_avg_rating"),
    ).drop("_review")


def listing_items(
    pages: DataFrame, category: str, page: str, size: int = LISTING_SIZE, kind: int = ITEM_COMPONENT_ID
) -> DataFrame:
    """First ``size`` items of every category over its pages of components, with ``ranking``.

    A page can give no more than ``size`` of them, so every page is cut inside its row
    before its items become rows.
    """
    lists = F.transform(
        F.filter("components", lambda c: (c["component_id"] == kind) & c["entity"]["item_list"].isNotNull()),
        lambda c: c["entity"]["item_list"],
    )
    head = F.slice(F.flatten(lists), 1, size)
    items = enumerate_items(pages.select(category, page, head.alias("_head")), "_head", [category, page], rank="item_pos")
    best = top_n(items, [category], [F.asc(page), F.asc("item_pos")], size, rank="ranking")
    return best.select(category, "ranking", "item")


def product_work_list(
    items: DataFrame, category: str, product: str = "item.item.like.goods_sno", batch_size: int = PRODUCT_BATCH_SIZE
) -> DataFrame:
    """Batches of distinct product ids per category; items without an id are skipped."""
    complete = keep_present(items, product).select(category, F.col(product).alias("product_id"))
    return item_batches(complete.where(F.col("product_id") != 0), [category], "product_id", batch_size, "product_ids")


#: Stored category trees: gender -> depth 2 -> depth 3 -> names.
CATEGORY_TREE = "tree map<string,map<string,map<string,array<string>>>>"


def category_tuples(trees: DataFrame, tree: str, position: str) -> DataFrame:
    """Rows (depth_1 .. depth_4) of all category trees merged.

    A tree is gender -> depth 2 -> depth 3 -> names. Where several trees hold the same
    depth 2 of a gender, the one with the highest ``position`` replaces the others.
    """
    genders = trees.select(position, F.explode(tree).alias("depth_1", "_branch"))
    branches = genders.select(position, "depth_1", F.explode("_branch").alias("depth_2", "_subtree"))
    merged = last_wins(branches, ["depth_1", "depth_2"], [position])
    return tree_leaves(merged, "_subtree", ["depth_3", "depth_4"], ["depth_1", "depth_2"])


def category_groups(tuples: DataFrame, batch_size: int = PRODUCT_BATCH_SIZE) -> DataFrame:
    """Lists of the depth-4 names per gender, depth 2 and depth 3."""
    return item_batches(tuples, ["depth_1", "depth_2", "depth_3"], "depth_4", batch_size, "categories")


def newest_reviews(reviews: DataFrame, product: str, written: str, review_id: str, n: int) -> DataFrame:
    """The ``n`` newest reviews of every product."""
    return top_n(reviews, [product], [F.desc(written), F.desc(review_id)], n)
