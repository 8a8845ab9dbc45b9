"""Table contracts: columns, types, required values, byte limits and keys.

A Parquet-backed table accepts NULL in a NOT NULL column and text of any length,
so the rules are checked as DataFrame operations: ``conform`` casts and orders the
columns, ``report`` counts the rows that break a rule, ``split`` separates rows
that can be loaded from rows that cannot. Text limits are bytes, as in a warehouse.
A value that a cast can't read becomes NULL; ``conform`` can keep the names of such
columns, and then ``report`` counts them too (rule ``bad_value``). The names travel as a
column through Parquet and through further contracts; blank text is a missing value, not a bad one.
Keys are informational: duplicates are counted, not removed.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemline.functions.casts import to_date, to_double, to_int, to_long

# Casts of text; other sources are cast directly.
_TEXT_CASTS = {"int": to_int, "bigint": to_long, "double": to_double, "date": to_date}


#: Column with the names of the columns whose value could not be read.
BAD_COLUMNS = "bad_columns"


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    required: bool = False
    max_bytes: int | None = None

    def cast(self, c: Column, source_type: str) -> Column:
        if source_type == self.type:
            return c
        if source_type == "string" and self.type in _TEXT_CASTS:
            return _TEXT_CASTS[self.type](c)
        return c.try_cast(self.type)


@dataclass(frozen=True)
class TableContract:
    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...] = field(default=())

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    def schema_ddl(self) -> str:
        return ", ".join(f"`{f.name}` {f.type}" for f in self.fields)

    def create_sql(self, table: str, location: str | None = None) -> str:
        columns = ", ".join(
            f"`{f.name}` {f.type}{' NOT NULL' if f.required else ''}" for f in self.fields
        )
        where = f" LOCATION '{location}'" if location else ""
        return f"CREATE TABLE {table} ({columns}) USING parquet{where}"

    def conform(
        self, df: DataFrame, mapping: dict[str, Column | str] | None = None, mark_bad: bool = False,
        read_from: dict[str, Column | str] | None = None,
    ) -> DataFrame:
        """Project, cast and order to this table; unmapped columns go by their own name.

        ``mark_bad`` adds ``bad_columns``; a frame that has it already keeps its entries. Where
        the mapping itself reads a column's text, ``read_from`` names that text: a column that is NULL
        though its text is not blank is bad as well.
        """
        mapping, read_from = mapping or {}, (read_from or {}) if mark_bad else {}
        unknown = (set(mapping) | set(read_from)) - set(self.columns)
        if unknown:
            raise ValueError(f"{self.name} has no column {sorted(unknown)}")

        def as_column(c: Column | str) -> Column:
            return F.col(c) if isinstance(c, str) else c

        texts = [as_column(c).alias(f"_text_{name}") for name, c in read_from.items()]
        before = [F.col(BAD_COLUMNS)] if mark_bad and BAD_COLUMNS in df.columns else []
        mapped = df.select(*[as_column(mapping.get(f.name, f.name)).alias(f.name) for f in self.fields], *texts, *before)
        types = dict(mapped.dtypes)
        casts = {f.name: f.cast(F.col(f.name), types[f.name]) for f in self.fields}
        marks = []
        if mark_bad:
            lost = []
            for f in self.fields:
                text = f"_text_{f.name}" if f.name in read_from else f.name
                if types[text] != f.type:
                    present = F.trim(text) != "" if types[text] == "string" else F.col(text).isNotNull()
                    lost.append(F.when(present & casts[f.name].isNull(), F.lit(f.name)))
            new = F.array_compact(F.array(*lost)) if lost else F.array().cast("array<string>")
            marks = [F.concat(*before, new).alias(BAD_COLUMNS)]
        return mapped.select(*[c.alias(name) for name, c in casts.items()], *marks)

    def by_position(self, df: DataFrame, mark_bad: bool = False) -> DataFrame:
        """Conform a frame whose columns have the right order but other names."""
        if len(df.columns) != len(self.fields):
            raise ValueError(f"{self.name} takes {len(self.fields)} columns, got {len(df.columns)}")
        return self.conform(df.toDF(*self.columns), mark_bad=mark_bad)

    def _rules(self) -> list[tuple[str, str, Column]]:
        rules = []
        for f in self.fields:
            if f.required or f.name in self.key:
                rules.append((f.name, "null", F.col(f.name).isNull()))
            if f.max_bytes:
                rules.append((f.name, "too_long", F.octet_length(f.name) > f.max_bytes))
        return rules

    def counted_rules(self, df: DataFrame) -> list[tuple[str, str, Column]]:
        """(column, rule, condition) of everything that is counted row by row."""
        bad = [(f.name, "bad_value", F.array_contains(BAD_COLUMNS, f.name)) for f in self.fields]
        return self._rules() + (bad if BAD_COLUMNS in df.columns else [])

    def reject_reasons(self) -> Column:
        """Array of 'column:rule' for every row-level rule the row breaks."""
        reasons = [F.when(broken, F.lit(f"{name}:{rule}")) for name, rule, broken in self._rules()]
        return F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")

    def rejects(self) -> Column:
        """Whether a row breaks any rule that keeps it from the table."""
        return reduce(lambda a, b: a | b, [F.coalesce(broken, F.lit(False)) for *_, broken in self._rules()], F.lit(False))

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(loadable rows, rejected rows with ``reject_reasons``); together they are ``df``."""
        return df.where(~self.rejects()), df.where(self.rejects()).withColumn("reject_reasons", self.reject_reasons())

    def duplicate_keys(self, df: DataFrame) -> DataFrame:
        """One row with the number of surplus rows per key: (key, count) pairs are combined before the shuffle."""
        surplus = df.groupBy(*self.key).agg(F.count(F.lit(1)).alias("n")).agg(
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("bad_rows"))
        return surplus.select(F.lit(",".join(self.key)).alias("column_name"), F.lit("duplicate_key").alias("rule"), "bad_rows")

    def report(self, df: DataFrame) -> DataFrame:
        """Rows (column_name, rule, bad_rows); key duplicates count surplus rows.

        One pass without a shuffle of rows for the row-level rules.
        """
        rules = self.counted_rules(df)
        parts = []
        if rules:
            counts = df.agg(*[F.count_if(broken).alias(f"r{i}") for i, (_, _, broken) in enumerate(rules)])
            rows = F.array(*[
                F.struct(F.lit(name).alias("column_name"), F.lit(rule).alias("rule"), F.col(f"r{i}").alias("bad_rows"))
                for i, (name, rule, _) in enumerate(rules)
            ])
            parts.append(counts.select(F.inline(rows)))
        if self.key:
            parts.append(self.duplicate_keys(df))
        nothing = df.sparkSession.createDataFrame([], "column_name string, rule string, bad_rows bigint")
        return reduce(DataFrame.unionByName, parts or [nothing])


def _text(name: str, max_bytes: int, required: bool = False) -> Field:
    return Field(name, "string", required, max_bytes)


# Column names, types and limits of the loaded tables; ids are kept as wide as the sources have them.

PRODUCT_DETAIL = TableContract("product_detail_tb", (
    _text("platform", 100, True),
    _text("master_category_name", 32),
    _text("small_category_name", 50),
    Field("product_id", "bigint", True),
    _text("img_url", 1000),
    _text("product_name", 512, True),
    _text("brand_name_kr", 100),
    _text("brand_name_en", 100),
    Field("original_price", "int"),
    Field("final_price", "int"),
    Field("discount_ratio", "int"),
    Field("review_counting", "int"),
    Field("review_avg_rating", "double"),
    Field("like_counting", "int"),
    Field("created_at", "date", True),
))

RANKING = TableContract("ranking_tb", (
    _text("platform", 100, True),
    _text("master_category_name", 32, True),
    Field("product_id", "bigint", True),
    Field("ranking", "int", True),
    Field("created_at", "date", True),
))

MASTER_CATEGORY = TableContract("master_category_tb", (
    _text("master_category_name", 32, True),
    _text("cat_depth_1", 32),
    _text("cat_depth_2", 32),
    _text("cat_depth_3", 32),
), key=("master_category_name",))

SUB_CATEGORY = TableContract("sub_category_tb", (
    _text("sub_category_id", 100),
    _text("platform", 100),
    _text("master_category_id", 32),
    _text("cat_depth_4", 50),
    Field("created_at", "date"),
))

REVIEW_DETAIL = TableContract("product_review_detail_tb", (
    Field("product_id", "bigint", True),
    _text("review_content", 8000),
    Field("review_rating", "int"),
    Field("review_date", "date"),
    Field("reviewer_height", "double"),
    Field("reviewer_weight", "double"),
    _text("selected_options", 200),
    Field("created_at", "date", True),
))

# The reviews of all platforms in one table.
PLATFORM_REVIEW_DETAIL = TableContract(
    "platform_product_review_detail_tb", (_text("platform", 100, True), *REVIEW_DETAIL.fields)
)

SNAP_BRAND_RANKING = TableContract("musinsa_snap_brand_ranking_tb", (
    _text("brand_id", 100),
    _text("brand_name", 100),
    _text("img_url", 3000),
    Field("rank", "int"),
    Field("previous_rank", "int"),
    Field("follower_count", "int"),
    _text("labels_name_1", 100),
    _text("labels_name_2", 100),
    Field("created_at", "date"),
), key=("brand_id",))

SNAP_USER_RANKING = TableContract("musinsa_snap_user_ranking_tb", (
    Field("story_id", "bigint"),
    _text("content_type", 64),
    Field("aggregation_like_count", "int"),
    _text("tags", 500),
    Field("created_at", "date"),
    _text("gender", 8),
), key=("story_id",))

KEYWORD_TREND = TableContract("naver_shopping_kwd_tb", (
    Field("trend_id", "bigint"),
    Field("start_date", "date"),
    Field("end_date", "date"),
    _text("time_unit", 10),
    _text("category_name", 100),
    Field("category_code", "int"),
    _text("keyword_name", 100),
    _text("gender", 8),
    Field("period", "date"),
    Field("ratio", "double"),
    Field("created_at", "date"),
))

WEATHER_DAILY = TableContract("weather_daily_tb", (
    Field("TM", "date", True),
    Field("STN", "int", True),
    Field("WS_AVG", "double"),
    Field("WS_MAX", "double"),
    Field("TA_AVG", "double"),
    Field("TA_MAX", "double"),
    Field("TA_MIN", "double"),
    Field("HM_AVG", "double"),
    Field("HM_MIN", "double"),
    Field("FG_DUR", "double"),
    Field("CA_TOT", "double"),
    Field("RN_DAY", "double"),
    Field("RN_DUR", "double"),
    Field("RN_60M_MAX", "double"),
    Field("RN_POW_MAX", "double"),
), key=("TM", "STN"))

WEATHER_STATION = TableContract("weather_center_location_tb", (
    Field("STN_ID", "int"),
    _text("STN_KO", 100, True),
), key=("STN_ID",))

VIDEO = TableContract("youtube_video_tb", (
    _text("video_id", 20),
    _text("gender", 8),
    _text("category_name", 100, True),
    _text("channel_title", 200, True),
    _text("title", 1000, True),
    _text("img_url", 1000, True),
    Field("duration_seconds", "int", True),
    Field("published_at", "timestamp_ntz", True),
    Field("view_count", "int", True),
    Field("like_count", "int"),
    Field("created_at", "date"),
), key=("video_id",))

CONTRACTS = {c.name: c for c in (
    PRODUCT_DETAIL, RANKING, MASTER_CATEGORY, SUB_CATEGORY, REVIEW_DETAIL, PLATFORM_REVIEW_DETAIL,
    SNAP_BRAND_RANKING, SNAP_USER_RANKING, KEYWORD_TREND, WEATHER_DAILY, WEATHER_STATION, VIDEO,
)}
