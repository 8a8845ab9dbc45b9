"""Projections and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemline.functions.casts import as_column


def tag(df: DataFrame, **constants) -> DataFrame:
    """Add constant columns; a (value, type) pair casts, so (None, 'string') is a typed null."""
    columns = {}
    for name, value in constants.items():
        columns[name] = F.lit(value[0]).cast(value[1]) if isinstance(value, tuple) else F.lit(value)
    return df.withColumns(columns)


def struct_fields(df: DataFrame, column: str) -> DataFrame:
    """Replace a struct column by its fields."""
    others = [c for c in df.columns if c != column]
    return df.select(*others, f"{column}.*")


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames, matched by column name; a missing column is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct rows (of the given columns); combined before the shuffle."""
    return (df.select(*columns) if columns else df).distinct()


def difference(current: Column | str, previous: Column | str) -> Column:
    """Movement of a rank; NULL when either side is."""
    return as_column(current) - as_column(previous)
