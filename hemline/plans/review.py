"""Product reviews of the three platforms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hemline.contracts import REVIEW_DETAIL
from hemline.functions.arrays import array_to_text, element
from hemline.functions.dates import offset_text_to_date, text_to_date
from hemline.functions.text import strip_unit
from hemline.operators.nested import explode_items
from hemline.operators.project import distinct_rows
from hemline.plans import schemas
from hemline.sources.readers import read_json


def read_ably_reviews(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_json(spark, path, schemas.as_text(schemas.ABLY_REVIEW), multiline=True, **options)


def ably_reviews(raw: DataFrame, run_date: str, mark_bad: bool = False) -> DataFrame:
    return REVIEW_DETAIL.conform(raw, {
        "product_id": "goods_sno",
        "review_content": "contents",
        "review_rating": "eval",
        "review_date": text_to_date("created_at"),
        "reviewer_height": "height",
        "reviewer_weight": "weight",
        "selected_options": array_to_text("goods_option"),
        "created_at": F.lit(run_date),
    }, mark_bad, {"review_date": "created_at"})


def read_cm29_reviews(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_json(spark, path, schemas.as_text(schemas.CM29_REVIEW), multiline=True, **options)


def cm29_reviews(raw: DataFrame, mark_bad: bool = False) -> DataFrame:
    """Height and weight come as texts like '170cm' and '60kg'; the first option counts."""
    return REVIEW_DETAIL.conform(raw, {
        "review_content": "contents",
        "review_rating": "point",
        "review_date": text_to_date("insertTimestamp"),
        "reviewer_height": strip_unit(element("userSize", 0), "cm"),
        "reviewer_weight": strip_unit(element("userSize", 1), "kg"),
        "selected_options": element("optionValue", 0),
    }, mark_bad, {
        "review_date": "insertTimestamp", "reviewer_height": element("userSize", 0), "reviewer_weight": element("userSize", 1)})


def read_musinsa_reviews(spark: SparkSession, path: str, **options) -> DataFrame:
    """One document per line. The scan parses the JSON: with ``from_json`` on text the
    filter that an explode implies would parse every document a second time."""
    return read_json(spark, path, schemas.as_text(schemas.MUSINSA_REVIEW), recursive=True, name_pattern="*.json", **options)


def musinsa_reviews(documents: DataFrame, run_date: str, mark_bad: bool = False) -> DataFrame:
    """Distinct reviews of all documents; dates are business dates of offset timestamps."""
    reviews = explode_items(documents, "list", "review")
    return distinct_rows(REVIEW_DETAIL.conform(reviews, {
        "product_id": "review.goods.goodsNo",
        "review_content": "review.content",
        "review_rating": "review.grade",
        "review_date": offset_text_to_date("review.createDate"),
        "reviewer_height": "review.userProfileInfo.userHeight",
        "reviewer_weight": "review.userProfileInfo.userWeight",
        "selected_options": "review.goodsOption",
        "created_at": F.lit(run_date),
    }, mark_bad, {"review_date": "review.createDate"}))
