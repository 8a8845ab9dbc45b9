"""Videos: selection from raw search results, and the silver table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hemline.contracts import VIDEO
from hemline.fixed_values import VIDEO_MAX_SECONDS, VIDEO_MIN_SECONDS, VIDEOS_PER_CATEGORY
from hemline.functions.dates import utc_text_to_timestamp
from hemline.functions.text import duration_seconds
from hemline.plans import schemas
from hemline.plans.snap import gender_word
from hemline.sources.readers import read_json


def read_videos(spark: SparkSession, path: str, **options) -> DataFrame:
    """All files at any depth; the category is a field, not the path."""
    return read_json(spark, path, schemas.as_text(schemas.VIDEO), recursive=True, name_pattern="*.json", **options)


def videos(raw: DataFrame, gender: str | None, run_date: str, mark_bad: bool = False) -> DataFrame:
    return VIDEO.conform(raw, {
        "video_id": "videoId",
        "gender": gender_word(F.lit(gender).cast("string")),
        "channel_title": "channelName",
        "img_url": "thumbnailUrl",
        "duration_seconds": "duration",
        "published_at": utc_text_to_timestamp("publishedAt"),
        "view_count": "viewCount",
        "like_count": "likeCount",
        "created_at": F.lit(run_date),
    }, mark_bad, {"published_at": "publishedAt"})


def select_videos(
    searches: DataFrame,
    category: str = "category_name",
    low: int = VIDEO_MIN_SECONDS,
    high: int = VIDEO_MAX_SECONDS,
    per_category: int = VIDEOS_PER_CATEGORY,
) -> DataFrame:
    """First videos of fitting length of every search result, in result order.

    ``searches``: the category column and the ``items`` array of one search. A missing
    count is '0'. The choice is made inside the array, without a shuffle.
    """
    timed = F.transform("items", lambda v: F.struct(
        v.alias("video"), duration_seconds(v["contentDetails"]["duration"]).alias("seconds")
    ))
    fitting = F.filter(timed, lambda t: t["seconds"].between(low, high))
    chosen = searches.select(category, F.explode(F.slice(fitting, 1, per_category)).alias("t"))
    chosen = chosen.select(category, F.col("t.video").alias("v"), "t.seconds")

    def count(name: str):
        return F.coalesce(F.col(f"v.statistics.{name}"), F.lit("0")).alias(name)

    return chosen.select(
        F.col(category).alias("category_name"),
        F.col("v.id").alias("videoId"),
        F.col("v.snippet.title").alias("title"),
        F.col("v.snippet.publishedAt").alias("publishedAt"),
        F.coalesce("v.snippet.description", F.lit("")).alias("description"),
        F.col("v.snippet.channelTitle").alias("channelName"),
        F.col("v.snippet.thumbnails.high.url").alias("thumbnailUrl"),
        F.coalesce("v.snippet.tags", F.array().cast("array<string>")).alias("tags"),
        F.coalesce("v.snippet.categoryId", F.lit("")).alias("categoryId"),
        F.col("seconds").alias("duration"),
        F.col("v.contentDetails.dimension").alias("dimension"),
        F.col("v.contentDetails.definition").alias("definition"),
        count("viewCount"), count("likeCount"), count("commentCount"),
    )
