"""Row filters and defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemline.fixed_values import WEATHER_COMMENT, WEATHER_MARKERS
from hemline.functions.text import is_text_record, record_fields


def text_records(
    lines: DataFrame,
    separator: str,
    column: str = "value",
    comment: str = WEATHER_COMMENT,
    markers: list[str] = WEATHER_MARKERS,
) -> DataFrame:
    """Data lines of a text set as one ``fields`` array per line; other columns are kept.

    Take fields with ``record_field`` and cast them with the ``functions.casts``: a
    plain cast may be evaluated ahead of the line filter and fail on a comment.
    """
    kept = [c for c in lines.columns if c != column]
    return lines.where(is_text_record(column, comment, markers)).select(
        *kept, record_fields(column, separator).alias("fields")
    )


def drop_null_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in any (listed) column."""
    return df.na.drop("any", subset=columns)


def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    return df.na.fill(defaults)


def keep_between(df: DataFrame, column: str, low, high) -> DataFrame:
    """Rows whose value lies within the bounds, both included."""
    return df.where(F.col(column).between(low, high))


def keep_present(df: DataFrame, *paths: str) -> DataFrame:
    """Rows where every dotted path holds a value."""
    for path in paths:
        df = df.where(F.col(path).isNotNull())
    return df


def skip_empty(df: DataFrame, total: str | None = None, items: str | None = None) -> DataFrame:
    """Drop payloads that report no entries (``total``) or hold none (``items``)."""
    if total:
        df = df.where(F.col(total) > 0)
    if items:
        df = df.where(F.size(items) > 0)
    return df
