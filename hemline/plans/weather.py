"""Weather observations and stations from text records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hemline.contracts import BAD_COLUMNS, WEATHER_DAILY, WEATHER_STATION
from hemline.fixed_values import STATION_ID_FIELD, STATION_NAME_FIELD, WEATHER_FIELDS
from hemline.functions.dates import compact_date
from hemline.functions.text import record_field
from hemline.operators.quality import fill_defaults, text_records
from hemline.sources.readers import read_text


def read_weather_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_text(spark, path)


def weather_daily(lines: DataFrame, mark_bad: bool = False) -> DataFrame:
    """Comma-separated daily records. Missing or unreadable measures become 0.0; a
    record without a readable date or station stays, for the contract to reject. ``mark_bad``
    keeps the names of unreadable columns, which the contract counts."""
    records = text_records(lines, ",")
    day = record_field("fields", 0)
    unreadable = F.when(day.isNotNull() & compact_date(day).isNull(), F.array(F.lit("TM"))).otherwise(F.array().cast("array<string>"))
    records = records.withColumn(BAD_COLUMNS, unreadable)
    daily = WEATHER_DAILY.conform(records, {
        "TM": compact_date(day),
        "STN": record_field("fields", 1),
        **{name: record_field("fields", position) for name, position in WEATHER_FIELDS.items()},
    }, mark_bad)
    return fill_defaults(daily, {name: 0.0 for name in WEATHER_FIELDS})


def weather_stations(lines: DataFrame, mark_bad: bool = False) -> DataFrame:
    """Blank-separated station records: number and name."""
    records = text_records(lines, r"\s+")
    return WEATHER_STATION.conform(records, {
        "STN_ID": record_field("fields", STATION_ID_FIELD),
        "STN_KO": record_field("fields", STATION_NAME_FIELD),
    }, mark_bad)
