"""Ids that stay: a dictionary of natural keys that only grows.

``ranking.stable_ids`` numbers the keys of one run, so a new key renumbers others. Here the ids of
earlier runs lie in a table, and only keys that it lacks get new ones, above its highest id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemline.operators.grouping import join_same_keys
from hemline.operators.ranking import stable_ids
from hemline.sources import batches


def register_keys(df: DataFrame, natural_key: list[str], table: str, location: str, name: str = "id") -> int:
    """Add the keys of ``df`` that the dictionary ``table`` lacks; returns how many were new.

    Distinct keys are anti-joined with the dictionary (NULL equals NULL) and numbered in parallel by
    ranges of their digest, above the highest stored id, so ids are dense over all batches. The new
    keys are one batch: it is visible as a whole or not at all, and of two runs that register at
    the same time the later one fails and may be repeated. A key keeps its id for ever.
    """
    spark = df.sparkSession
    keys = df.select(*natural_key).distinct()
    batches.create(spark, table, f"{', '.join(f'`{c}` {t}' for c, t in keys.dtypes)}, `{name}` bigint", location)
    known = spark.table(table)
    top = known.agg(F.coalesce(F.max(name), F.lit(0))).first()[0]
    stored = known.select(*[F.col(c).alias(f"_known_{c}") for c in natural_key])
    same = reduce(lambda a, b: a & b, [keys[c].eqNullSafe(stored[f"_known_{c}"]) for c in natural_key])
    numbered = stable_ids(keys.join(stored, same, "left_anti"), natural_key, name)
    number = batches.append(numbered.withColumn(name, F.col(name) + F.lit(top)), table)
    return spark.table(table).where(F.col(batches.BATCH) == number).count()


def with_lasting_id(df: DataFrame, natural_key: list[str], table: str, name: str = "id") -> DataFrame:
    """Add each row's id from the dictionary; NULL for keys that were not registered."""
    dictionary = df.sparkSession.table(table).select(*natural_key, name)
    return join_same_keys(df, dictionary, natural_key, name)
