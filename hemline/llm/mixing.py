"""Mixing sources to target weights along a time-varying curriculum.

Sources share all words by weight; no source gives more than ``max_repeats`` times its words, and
what it can't give goes to the others by weight. Within a source, documents stand in the order of a
digest of their id and are read again in the same order when the target exceeds the source. The
weight of a source changes over the run from ``1 - g`` to ``1 + g``; the integral of that schedule,
scaled to the target, is the source's demand for words up to a time. Inverting it at the middle of a
copy gives the copy its training position in [0, 1], and copies are range-sorted by position. The
copy at which the demand ends is taken in part.

Cumulative sizes come from digest ranges: sums per (source, range), then a running sum inside each
range, so a source with a third of all rows is spread over as many tasks as its ranges.

NULL and empty texts have size 0 and take nothing; rows without an id are ordered, and spread over the
ranges, by a digest of their text; a NULL source is a source of its own, the last.
Repeated rows are documents of their own. Only the named columns are read; an empty table gives an
empty plan.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hemline.llm.common import SPACE, keep
from hemline.operators.ranking import full_rank

WEIGHTS = (1, 2, 3)
#: Change of a source's weight over the run, by rank: falls, stays, rises.
SLOPES = (-0.5, 0.0, 0.5)
MAX_REPEATS = 3
ROWS_PER_RANGE = 4_000


def n_spaced_words(text: Column) -> Column:
    pieces = F.split(F.coalesce(text, F.lit("")), SPACE)
    return F.size(F.array_remove(pieces, "")).cast("long")


def targets(source_sizes: DataFrame, weights: tuple[int, ...], max_repeats: int, slopes: tuple[float, ...]) -> DataFrame:
    """Target words of each source from (source, source_size): weights with a ceiling.

    With sources by ceiling per weight, the level before each source is what is left over the
    weights left; the highest of these is the level at which the ceilings hold.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(named) - 1
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (F.col("rank") % len(values) + 1).cast("int"))
    ranked = source_sizes.withColumn("rank", rank).withColumn("weight", pick(weights)).withColumn("slope", pick(slopes))
    ceiling = ranked.withColumn("ceiling", max_repeats * F.col("source_size"))
    before = Window.orderBy(F.col("ceiling") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(1))
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("ceiling").over(before), F.lit(0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    filled = ceiling.withColumn("level", level).withColumn("level", F.max("level").over(every))
    return filled.select(
        "source", "source_size", "weight", "slope",
        F.least(F.col("ceiling").cast("double"), F.col("level") * F.col("weight")).alias("target"),
    )


def position(used: Column, slope: Column) -> Column:
    """The time at which the integral of ``1 + slope * (2 t - 1)`` reaches ``used`` (0 to 1)."""
    fall = 1 - slope
    root = (F.sqrt(fall * fall + 4 * slope * used) - fall) / (2 * slope)
    return F.when(slope == 0, used).otherwise(root)


def plan(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    slopes: tuple[float, ...] = SLOPES,
    max_repeats: int = MAX_REPEATS,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target and ``copies``, an array of
    (copy, position, take) of the copies that the mix reads, in part for the last of a source."""
    sized = keep(docs.select(
        F.col("doc_id"), F.col("source"), n_spaced_words(F.col("text")).alias("size"),
        F.md5(F.coalesce(
            F.col("doc_id").cast("string"),
            F.concat(F.lit("text "), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))),
        ).cast("binary")).alias("digest"),
    ), "mix-sizes")
    digits = max(1, math.ceil(math.log(max(sized.count() / rows_per_range, 2), 16)))
    sized = sized.withColumn("range", F.substring("digest", 1, digits))
    sums = keep(sized.groupBy("source", "range").agg(F.sum("size").alias("range_size")), "mix-ranges")
    goals = targets(sums.groupBy("source").agg(F.sum("range_size").alias("source_size")), weights, max_repeats, slopes)
    goals = goals.select(F.col("source").alias("goal_source"), "source_size", "slope", "target")
    offsets = sums.select(
        F.col("source").alias("range_source"), F.col("range").alias("range_key"),
        F.coalesce(F.sum("range_size").over(
            Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"),
    ).join(goals, F.col("range_source").eqNullSafe(F.col("goal_source")))
    within = Window.partitionBy("source", "range").orderBy("digest", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0))).join(
        offsets, F.col("source").eqNullSafe(F.col("range_source")) & (F.col("range") == F.col("range_key")))
    goal = F.round("target").cast("long")

    def copy(k: int) -> Column:
        start = F.col("offset") + F.col("inside") + k * F.col("source_size")
        take = F.greatest(F.lit(0), F.least(F.col("size"), goal - start))
        at = position((start + take / F.lit(2.0)) / F.nullif(goal, F.lit(0)), F.col("slope"))
        return F.when(take > 0, F.struct(F.lit(k).alias("copy"), at.alias("position"), take.alias("take")))

    return placed.select(
        "doc_id", "source", "size", "source_size", "target",
        F.filter(F.array(*[copy(k) for k in range(max_repeats)]), lambda c: c.isNotNull()).alias("copies"),
    )


def manifest(planned: DataFrame) -> DataFrame:
    """One row per copy that the mix reads, range-sorted by training position."""
    rows = planned.select("doc_id", "source", "size", F.explode("copies").alias("c"))
    return rows.select("doc_id", "source", "size", "c.copy", "c.position", "c.take").orderBy("position", "doc_id", "copy")


def in_training_order(planned: DataFrame) -> DataFrame:
    """Adds ``first_position``, the training position of a document's first copy, and ``training_rank``,
    its place among the documents by that position (equal ones by id and size); NULL where the mix takes nothing.

    Documents are range-sorted by position and numbered range by range, so no task holds them all.
    """
    timed = planned.withColumn("first_position", F.try_element_at("copies", F.lit(1))["position"])
    order = [F.asc("first_position"), F.asc("doc_id"), F.asc("size")]
    ranked = full_rank(timed.where(F.col("first_position").isNotNull()), [], order, "training_rank")
    unread = timed.where(F.col("first_position").isNull()).withColumn("training_rank", F.lit(None).cast("long"))
    return ranked.withColumn("training_rank", F.col("training_rank").cast("long")).unionByName(unread)
