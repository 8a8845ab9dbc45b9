"""Joins back to a base table, counts and lists per group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def label_counts(df: DataFrame, group: str, label: str, name: str = "label_count") -> DataFrame:
    """Rows per (group, label); combined before the shuffle."""
    return df.groupBy(group, label).agg(F.count(F.lit(1)).alias(name))


def left_join_using(base: DataFrame, other: DataFrame, *keys: str) -> DataFrame:
    """Base rows with the columns of ``other``, NULL where it has no such key."""
    return base.join(other, list(keys), "left")


def join_same_keys(base: DataFrame, other: DataFrame, keys: list[str], *values: str) -> DataFrame:
    """Base rows with ``values`` of the row of ``other`` with the same keys, NULL equal to NULL.

    ``other`` has one row per key. Only its side is unique, so a hot key of the base
    may be split by the adaptive skew join.
    """
    other = other.select(*[F.col(k).alias(f"_same_{k}") for k in keys], *values)
    same = [base[k].eqNullSafe(other[f"_same_{k}"]) for k in keys]
    return base.join(other, same, "left").select(base["*"], *[other[v] for v in values])
