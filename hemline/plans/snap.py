"""Brand and story rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hemline.contracts import SNAP_BRAND_RANKING, SNAP_USER_RANKING
from hemline.fixed_values import GENDER_SYNONYMS
from hemline.functions.arrays import field_to_text
from hemline.functions.casts import as_column
from hemline.functions.text import translate_name
from hemline.operators.grouping import left_join_using
from hemline.operators.nested import explode_items, explode_two_levels
from hemline.operators.ranking import top_items
from hemline.plans import schemas
from hemline.sources.readers import read_json

LABELS = ["labels_name_1", "labels_name_2"]


def gender_word(c: Column | str) -> Column:
    """One word per gender whatever the source calls it; an unknown word stays."""
    return translate_name(c, GENDER_SYNONYMS, as_column(c))


def read_brand_pages(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_json(spark, path, schemas.as_text(schemas.SNAP_BRAND), **options)


def brand_ranking(pages: DataFrame, run_date: str, mark_bad: bool = False) -> DataFrame:
    """Brands with their two most frequent snap labels (NULL where there are fewer)."""
    brands = explode_items(pages, "data.list", "brand").select("brand.*")
    labels = explode_two_levels(brands, "snaps", "labels", ["id"], inner_name="label").select(
        "id", F.col("label.name").alias("label_name")
    )
    best = top_items(labels, "id", "label_name", 2, LABELS)
    return SNAP_BRAND_RANKING.conform(left_join_using(brands.drop("snaps"), best, "id"), {
        "brand_id": "id",
        "brand_name": "nickname",
        "img_url": "profileImageUrl",
        "rank": "ranking.rank",
        "previous_rank": F.coalesce(F.col("ranking.previousRank").cast("string"), F.lit("0")),
        "follower_count": "followerCount",
        "created_at": F.lit(run_date),
    }, mark_bad)


def read_story_pages(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_json(spark, path, schemas.as_text(schemas.SNAP_STORY), **options)


def story_ranking(pages: DataFrame, gender: str, run_date: str, mark_bad: bool = False) -> DataFrame:
    stories = explode_items(pages, "data.list", "story")
    return SNAP_USER_RANKING.conform(stories, {
        "story_id": "story.id",
        "content_type": "story.contentType",
        "aggregation_like_count": "story.aggregations.likeCount",
        "tags": field_to_text("story.tags", "name"),
        "created_at": F.lit(run_date),
        "gender": gender_word(F.lit(gender)),
    }, mark_bad)
