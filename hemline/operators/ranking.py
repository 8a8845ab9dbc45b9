"""Top-n, newest-n, latest value, last-wins and stable ids.

Every order must end in a unique column, or ties make the result arbitrary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hemline.operators.grouping import join_same_keys
from hemline.session import shared_dir

# Spark prunes "row_number <= n" to the n best rows of each task before the shuffle, for n up to
# this setting.
_PRUNED_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"
#: Pieces of a group that meet in one task.
_FAN_IN = 64


def _first(df: DataFrame, keys: list[str], order: list[Column], n: int, position: str) -> DataFrame:
    ranked = df.withColumn(position, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(position) <= n)


def top_n(
    df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str | None = None, pieces: int | None = None
) -> DataFrame:
    """The first ``n`` rows of each group, with their position in column ``rank``.

    For n within Spark's pruning limit (1000 unless set otherwise) every task keeps only
    its n best rows of a group before the shuffle, so a hot group never meets in one task.
    Beyond the limit groups are cut into pieces by input partition (which also parts equal
    rows), four for each core of the cluster; each piece keeps its n best, and these meet in a
    tree of at most 64 pieces a step. ``pieces`` asks for that also below the limit, for groups
    fed by so many tasks that their n best rows each are too many for one task.
    """
    if n > int(df.sparkSession.conf.get(_PRUNED_LIMIT, "1000")):
        pieces = pieces or max(_FAN_IN, 4 * df.sparkSession.sparkContext.defaultParallelism)
    df = df.withColumn("_piece", F.pmod(F.spark_partition_id(), F.lit(pieces))) if pieces else df
    while pieces:
        df = _first(df, [*keys, "_piece"], order, n, "_position").drop("_position")
        pieces = -(-pieces // _FAN_IN) if pieces > _FAN_IN else 0
        df = df.withColumn("_piece", F.pmod("_piece", F.lit(pieces))) if pieces else df.drop("_piece")
    best = _first(df, keys, order, n, rank or "_rank")
    return best if rank else best.drop("_rank")


def full_rank(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """Every row with its position in its group, in column ``name``.

    Rows are dealt by ranges of (keys, order) and numbered inside their range, so a hot group
    is numbered by many tasks; the offsets come from the row counts per group and range. The
    dealt rows are written once, as ranges are drawn from a sample that another run of the
    plan would draw again.
    """
    ranges = df.repartitionByRange(*[F.col(k) for k in keys], *order).withColumn("_range", F.spark_partition_id())
    path = shared_dir(df.sparkSession, "ranges")
    ranges.write.parquet(path)
    rows = df.sparkSession.read.schema(ranges.schema).parquet(path)
    inside = F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(*order))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select(*keys, "_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    placed = join_same_keys(rows.withColumn("_inside", inside), offsets, [*keys, "_range"], "_before")
    return placed.withColumn(name, F.col("_before") + F.col("_inside")).drop("_range", "_inside", "_before")


def top_n_overall(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of the whole frame (each task sends its n best)."""
    return df.orderBy(*order).limit(n)


def top_items(
    df: DataFrame, group: str, item: str, n: int, names: list[str], present_only: bool = True, times: str | None = None
) -> DataFrame:
    """The ``n`` most frequent items of each group, one column each.

    Ties go to the smaller item; NULL where a group has fewer. ``times`` names a column that
    says how often a row counts. Counting is combined
    before the shuffle and the pivot reuses the ranking's partitioning.
    """
    if present_only:
        df = df.where(F.col(item).isNotNull())
    counts = df.groupBy(group, item).agg((F.sum(times) if times else F.count(F.lit(1))).alias("_n"))
    best = top_n(counts, [group], [F.desc("_n"), F.asc(item)], n, rank="_pos")
    return best.groupBy(group).agg(
        *[F.max(F.when(F.col("_pos") == i + 1, F.col(item))).alias(names[i]) for i in range(n)]
    )


def latest_value(df: DataFrame, keys: list[str], value: str, order: list[str], default=None, name: str = "latest") -> DataFrame:
    """Value of the last row per key; ``default`` when that value is NULL."""
    last = F.max_by(F.col(value), F.struct(*order))
    if default is not None:
        last = F.coalesce(last, F.lit(default))
    return df.groupBy(*keys).agg(last.alias(name))


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the one that comes last in ``order``."""
    rest = [c for c in df.columns if c not in keys]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last"))
    return last.select(*keys, "_last.*").select(*df.columns)


def stable_ids(df: DataFrame, natural_key: list[str], name: str = "id", prefix_digits: int = 3) -> DataFrame:
    """Distinct natural keys with a dense id from 1, the same in every run on the same keys.

    Ids follow the order of the key's digest. Digests spread evenly, so the leading hex
    digits cut the distinct keys into even ranges that are numbered in parallel; the
    ranges' offsets come from one short table (16 ** prefix_digits rows at most).
    """
    key_text = F.to_json(F.struct(*natural_key), {"ignoreNullFields": "false"})
    # The digest is never NULL and the join is a left one: otherwise a test for NULL would
    # be pushed below the distinct, and the digest computed for every input row. As both
    # branches then start from the same distinct keys, its shuffle is done once.
    digest = F.coalesce(F.md5(key_text), F.lit(""))
    keys = df.select(*natural_key).distinct().withColumn("_digest", digest)
    keys = keys.withColumn("_range", F.substring("_digest", 1, prefix_digits))
    numbered = keys.withColumn("_pos", F.row_number().over(Window.partitionBy("_range").orderBy("_digest")))
    sizes = keys.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    return numbered.join(F.broadcast(offsets), "_range", "left").select(
        *natural_key, (F.col("_offset") + F.col("_pos")).alias(name)
    )


def with_stable_id(df: DataFrame, natural_key: list[str], name: str = "id") -> DataFrame:
    """Add the stable id of each row's natural key (NULLs in the key match NULLs)."""
    return join_same_keys(df, stable_ids(df, natural_key, name), natural_key, name)

def item_batches(df: DataFrame, keys: list[str], item: str, batch_size: int, name: str = "items") -> DataFrame:
    """Distinct items per group as sorted lists of ``batch_size``, the last one shorter.

    Columns: keys, ``batch`` (from 0), ``items``. Batches follow the order of the items, so
    that the lists of a group, one after the other, are its sorted list. No task holds more
    than a batch of a group.
    """
    items = df.where(F.col(item).isNotNull()).select(*keys, item).distinct()
    placed = full_rank(items, keys, [F.asc(item)], "_position")
    placed = placed.withColumn("batch", F.floor((F.col("_position") - 1) / F.lit(batch_size)).cast("int"))
    return placed.groupBy(*keys, "batch").agg(F.array_sort(F.collect_list(item)).alias(name))
