"""Dimension lookup by key.

A lookup never changes the number of fact rows: the dimension is checked to be
unique per key. It is broadcast only when its rows and bytes, summed by each task before
anything moves, are within the bounds; otherwise both sides are shuffled and Spark
splits a hot key (adaptive skew join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def _measure(df: DataFrame, *key: str):
    """(rows, bytes, distinct keys). Tasks send sums, and for keys each different key once."""
    row_bytes = F.octet_length(F.to_json(F.struct("*")))
    distinct = F.count_distinct(*key) if key else F.lit(None)
    return df.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes), F.lit(0)), distinct).first()


def is_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether the frame is within both bounds."""
    rows, size, _ = _measure(df)
    return rows <= max_rows and size <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


def require_unique(dim: DataFrame, key: list[str]) -> None:
    """Raise when a key occurs twice; such a dimension would multiply fact rows."""
    twice = dim.groupBy(*key).count().where("count > 1").limit(5).collect()
    if twice:
        raise ValueError(f"dimension is not unique per {key}: {[tuple(r)[:-1] for r in twice]}")


def map_lookup(
    df: DataFrame,
    key: str,
    dim: DataFrame,
    dim_key: str,
    values: list[str],
    default: str | None = None,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Add ``values`` of the dimension row whose ``dim_key`` equals ``key``.

    Keys without a dimension row get ``default`` (NULL when not given).
    """
    dim = dim.where(F.col(dim_key).isNotNull()).select(F.col(dim_key).alias("_lookup_key"), *values)
    rows, size, keys = _measure(dim, "_lookup_key")
    small = rows <= max_broadcast_rows and size <= MAX_BROADCAST_BYTES
    if keys < rows:
        require_unique(dim, ["_lookup_key"])
    joined = df.join(F.broadcast(dim) if small else dim.hint("shuffle_merge"), F.col(key) == F.col("_lookup_key"), "left")
    if default is not None:
        # Only keys without a dimension row take the default; a NULL inside the row stays.
        absent = F.col("_lookup_key").isNull()
        joined = joined.withColumns({v: F.when(absent, F.lit(default)).otherwise(F.col(v)) for v in values})
    return joined.drop("_lookup_key")
