"""Keyword trends: daily ratios per keyword, ratios of several requests on one scale, and the keywords
with the highest last ratio."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hemline.contracts import KEYWORD_TREND
from hemline.fixed_values import TREND_CATEGORY_CODE, TREND_CATEGORY_NAME, TREND_LOOKBACK_DAYS, TREND_TOP
from hemline.functions.arrays import element
from hemline.operators.nested import explode_items
from hemline.operators.project import tag
from hemline.operators.lasting import register_keys, with_lasting_id
from hemline.operators.ranking import latest_value, top_n, with_stable_id
from hemline.plans import schemas
from hemline.plans.snap import gender_word
from hemline.session import shared_dir
from hemline.sources.readers import read_json


def read_trend(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_json(spark, path, schemas.as_text(schemas.KEYWORD_TREND), **options)


def keyword_results(documents: DataFrame, gender: str) -> DataFrame:
    """One row per keyword result, its daily points still an array."""
    results = explode_items(documents, "results", "result", ["startDate", "endDate", "timeUnit"])
    return results.select(
        F.col("startDate").alias("start_date"), F.col("endDate").alias("end_date"),
        F.col("timeUnit").alias("time_unit"),
        element("result.keyword", 0).alias("keyword_name"),
        F.col("result.data").alias("points"),
        gender_word(F.lit(gender)).alias("gender"),
    )


#: What identifies a keyword result.
RESULT_KEY = ["start_date", "end_date", "time_unit", "gender", "keyword_name"]


def register_results(documents: DataFrame, gender: str, table: str, location: str) -> int:
    """Give the keyword results that the dictionary ``table`` lacks their lasting ids; returns how many."""
    return register_keys(keyword_results(documents, gender), RESULT_KEY, table, location, "trend_id")


def keyword_trend(
    documents: DataFrame, gender: str, run_date: str, mark_bad: bool = False, dictionary: str | None = None
) -> DataFrame:
    """Daily ratios. ``trend_id`` numbers the keyword results of ``documents``, the same in every run on them.

    With the table of a ``dictionary`` (``register_results`` comes first) ids stay from day to day.
    """
    results = keyword_results(documents, gender)
    numbered = with_lasting_id(results, RESULT_KEY, dictionary, "trend_id") if dictionary else with_stable_id(
        results, RESULT_KEY, "trend_id")
    points = explode_items(numbered, "points", "point", ["trend_id", *RESULT_KEY])
    points = tag(points, category_name=TREND_CATEGORY_NAME, category_code=TREND_CATEGORY_CODE)
    return KEYWORD_TREND.conform(points, {
        "period": "point.period", "ratio": "point.ratio", "created_at": F.lit(run_date),
    }, mark_bad)


def _written(df: DataFrame, label: str) -> DataFrame:
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _request_groups(links: DataFrame) -> DataFrame:
    """(gender, request, group): the smallest request that is reached over shared points."""
    point = ["gender", "keyword_name", "period"]
    state = _written(links.select("gender", "request", F.col("request").alias("group")).distinct(), "trend-groups")
    while True:
        lowest = links.join(state, ["gender", "request"]).groupBy(*point).agg(F.min("group").alias("group"))
        reached = links.join(lowest, point).groupBy("gender", "request").agg(F.min("group").alias("reached"))
        moved = _written(state.join(reached, ["gender", "request"]), "trend-groups")
        state = moved.select("gender", "request", F.col("reached").alias("group"))
        if moved.where("reached <> group").isEmpty():
            return state


def rescale(points: DataFrame, digits: int = 6) -> DataFrame:
    """Adds ``group``, ``factor`` and ``scaled``: ratios of different requests on one scale.

    A request scales its ratios to its own maximum, so two requests compare only through points
    (keyword and period) that both hold. ``points``: request, gender, keyword_name, period, ratio.
    Requests that shared points connect, over any number of steps, form a group, named by its smallest
    request. From there factors spread: a request next to scaled ones takes the factor that brings the
    sum of its shared points to the sum of their scaled values, averaged where several requests hold a point. At
    last the largest value of a group is 100, and values are rounded to ``digits``. Only ratios above 0
    link; a request without one is a group of its own. Groups are not comparable with each other.

    The graph is that of requests and points, never of pairs of requests, so a keyword that all requests
    carry costs its points only. Each round is two joins and aggregates of the points, written to
    the shared folder; there are as many rounds as the longest chain of requests has links, two or three
    where requests carry common keywords. The rounds run while this is called.
    """
    point, request = ["gender", "keyword_name", "period"], ["gender", "request"]
    positive = points.where((F.col("ratio") > 0) & F.col("request").isNotNull())
    links = _written(positive.groupBy(*request, "keyword_name", "period").agg(F.max("ratio").alias("ratio")), "trend-links")
    groups = _request_groups(links)
    state = _written(groups.withColumn("factor", F.when(F.col("request") == F.col("group"), F.lit(1.0))), "trend-factors")
    while True:
        valued = links.join(state.where("factor is not null"), request).groupBy(*point).agg(
            F.avg(F.col("ratio") * F.col("factor")).alias("value"))
        waiting = links.join(state.where("factor is null").select(*request), request)
        found = waiting.join(valued, point).groupBy(*request).agg((F.sum("value") / F.sum("ratio")).alias("found"))
        known = _written(state.join(found, request, "left"), "trend-factors")
        state = known.select(*request, "group", F.coalesce("factor", "found").alias("factor"))
        if known.where("found is not null").isEmpty():
            break
    top = links.join(state, request).groupBy("gender", "group").agg(F.max(F.col("ratio") * F.col("factor")).alias("top"))
    factors = state.join(top, ["gender", "group"]).select(
        F.col("gender").alias("_gender"), F.col("request").alias("_request"), "group", (100 * F.col("factor") / F.col("top")).alias("factor"))
    same = points["gender"].eqNullSafe(factors["_gender"]) & (points["request"] == factors["_request"])
    return points.join(factors, same, "left").select(
        points["*"], F.coalesce("group", "request").alias("group"), F.coalesce("factor", F.lit(1.0)).alias("factor"),
    ).withColumn("scaled", F.round(F.col("ratio") * F.col("factor"), digits))


def top_keywords(
    points: DataFrame, run_date: str, n: int = TREND_TOP, lookback_days: int = TREND_LOOKBACK_DAYS,
    keys: tuple[str, ...] = ("gender",),
) -> DataFrame:
    """Per gender the ``n`` keywords with the highest ratio on their last day in the look-back range.

    ``points``: gender, keyword_name, period, ratio; a keyword without points in the
    range counts as 0. Ties go to the smaller name. Other ``keys`` rank within those columns.
    """
    end = F.lit(run_date).cast("date")
    in_range = F.col("period").between(F.date_sub(end, lookback_days), end)
    seen = points.select(
        *keys, "keyword_name",
        F.when(in_range, F.col("period")).alias("period"),
        F.when(in_range, F.col("ratio")).alias("ratio"),
    )
    last = latest_value(seen, [*keys, "keyword_name"], "ratio", ["period", "ratio"], 0.0, "last_ratio")
    return top_n(last, list(keys), [F.desc("last_ratio"), F.asc("keyword_name")], n, rank="position")


def top_keywords_rescaled(
    points: DataFrame, run_date: str, n: int = TREND_TOP, lookback_days: int = TREND_LOOKBACK_DAYS
) -> DataFrame:
    """``top_keywords`` over points of several requests, within each group of comparable ones.

    ``points`` as for ``rescale``; a point that several requests hold counts with its largest scaled ratio.
    """
    scaled = rescale(points).drop("ratio").withColumnRenamed("scaled", "ratio")
    return top_keywords(scaled, run_date, n, lookback_days, ("gender", "group"))
