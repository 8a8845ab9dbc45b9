"""Category tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemline.contracts import MASTER_CATEGORY, SUB_CATEGORY
from hemline.functions.text import category_level
from hemline.operators.project import distinct_rows, union_all


def cm29_master_category(listing: DataFrame) -> DataFrame:
    return distinct_rows(MASTER_CATEGORY.conform(listing, {"cat_depth_1": "gender"}))


def cm29_sub_category(listing: DataFrame, mark_bad: bool = False) -> DataFrame:
    return distinct_rows(SUB_CATEGORY.conform(listing, {
        "sub_category_id": "file_key",
        "master_category_id": "master_category_name",
        "cat_depth_4": "small_category_name",
    }, mark_bad))


def master_category(rankings: list[DataFrame]) -> DataFrame:
    """Categories of all platforms, one row per composed name."""
    names = distinct_rows(union_all([r.select("master_category_name") for r in rankings]))
    present = names.where(F.col("master_category_name").isNotNull())
    return MASTER_CATEGORY.conform(present, {
        f"cat_depth_{n}": category_level("master_category_name", n) for n in (1, 2, 3)
    })
