"""Words, letters and intermediate tables shared by the corpus operators."""

from __future__ import annotations

import os
import shutil
import tempfile
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hemline.session import shared_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Capital letters beyond ASCII, which ``lower`` would change too.
OTHER_CAPITALS = r"[\p{IsUppercase}\p{Lt}&&[^A-Z]]"
SPACE = r"[\x20\x09-\x0D]"
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    """A to Z in lower case, every other character as it is.

    ``translate`` looks up each character, so it only runs on texts with other capitals.
    """
    return F.when(text.rlike(OTHER_CAPITALS), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def spaced_words(text: Column) -> Column:
    """Runs of characters other than blank and control white space; no words for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def alnum_words(text: Column) -> Column:
    """Runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower case."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_ALNUM), "")


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark: SparkSession = df.sparkSession
    path = shared_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Fewer rows per Arrow batch: texts may be long, and a batch is held in memory."""
    ship_package(spark)
    now = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if now <= 0 or now > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def without(docs: DataFrame, dropped: DataFrame, broadcast_rows: int = 500_000) -> DataFrame:
    """The rows of ``docs`` whose (doc_id, text_key) isn't among the ``dropped`` ones.

    The dropped keys are counted; a small number is broadcast, a larger one joined by a shuffle.
    """
    keys = keep(dropped.select(F.col("doc_id").alias("dropped_id"), F.col("text_key").alias("dropped_key")).distinct(), "dropped")
    small = keys.count() <= broadcast_rows
    same = docs["doc_id"].eqNullSafe(F.col("dropped_id")) & (text_key(docs["text"]) == F.col("dropped_key"))
    return docs.join(F.broadcast(keys) if small else keys, same, "left_anti")


@lru_cache(maxsize=1)
def _packed() -> str:
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    base = os.path.join(tempfile.mkdtemp(), "hemline")
    return shutil.make_archive(base, "zip", os.path.dirname(home), "hemline")


def ship_package(spark: SparkSession) -> None:
    """Hand this package to Python workers that could not import it from their path."""
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if home in os.environ.get("PYTHONPATH", "").split(os.pathsep) or os.getcwd() == home:
        return
    if not any(f.endswith("/hemline.zip") for f in spark.sparkContext.listFiles):
        spark.sparkContext.addPyFile(_packed())
