"""Writers: dated Parquet, replaced JSON partitions, table loads and marts."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hemline.contracts import TableContract
from hemline.sources import publish


def write_parquet(
    df: DataFrame, path: str, partition_by: list[str] | None = None, max_records_per_file: int | None = None
) -> None:
    """Overwrite Parquet at ``path``.

    Partitioned output is rebalanced on its partition columns first: a folder gets few
    files of the advisory size, and a folder holding much of the data gets many
    writers instead of one.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def replace_json(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Write JSON folders, replacing exactly those that occur in ``df``."""
    (
        df.hint("rebalance", *partition_by).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", False)
        .partitionBy(*partition_by).json(path)
    )


def append_positional(df: DataFrame, contract: TableContract, table: str) -> DataFrame:
    """Append to an existing table; columns map by position, whatever their names.

    Rows that break a rule of the contract are left out and returned with their reasons.
    """
    good, rejected = contract.split(contract.by_position(df, mark_bad=True))
    good.select(*contract.columns).write.insertInto(table, overwrite=False)
    return rejected


def refresh_table(spark: SparkSession, contract: TableContract, table: str, location: str | None = None) -> None:
    """Drop the table and create it empty with the contract's types."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(contract.create_sql(table, location))


class Loaded(NamedTuple):
    """What a load leaves to store: rejected rows with their reasons (lazy), rule counts, and what was published."""

    rejected: DataFrame
    report: DataFrame
    published: publish.Published | None = None


def load_table(
    contract: TableContract,
    sources: list[DataFrame],
    table: str,
    location: str | None = None,
    max_rejected: float | None = None,
) -> Loaded:
    """Full refresh of a table from all sources, in one pass, published when it is whole.

    Sources are conformed by name; rows that break a row rule are left out. Rules are counted
    while the good rows are written beside the current version. The new version is refused, and
    the table left as it is, when a source fails, when the written rows are not as many as the
    counted ones, or when more than the share ``max_rejected`` of all rows was left out. The sources
    are read again only for rows that were rejected. Surplus keys are counted on the table.
    """
    spark = sources[0].sparkSession
    conformed = reduce(DataFrame.unionByName, [contract.conform(s, mark_bad=True) for s in sources])
    rules = contract.counted_rules(conformed)
    seen = Observation()
    marked = conformed.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(contract.rejects()).alias("rejected"),
        *[F.count_if(broken).alias(f"r{i}") for i, (*_, broken) in enumerate(rules)])

    def whole(staged: DataFrame) -> None:
        counts, written = seen.get, staged.count()
        good = counts.get("rows", 0) - counts.get("rejected", 0)
        if written != good:
            raise publish.CheckFailed(f"{table}: {written} rows written of {good}")
        if max_rejected is not None and counts.get("rejected", 0) > max_rejected * counts.get("rows", 0):
            raise publish.CheckFailed(f"{table}: {counts['rejected']} of {counts['rows']} rows rejected")

    published = publish.publish(
        marked.where(~contract.rejects()).select(*contract.columns), table, location, lambda path: contract.create_sql(table, path), whole)
    counts = seen.get
    report = spark.createDataFrame(
        [(name, rule, counts.get(f"r{i}", 0)) for i, (name, rule, _) in enumerate(rules)], "column_name string, rule string, bad_rows bigint")
    if contract.key:
        report = report.unionByName(contract.duplicate_keys(spark.table(table)))
    _, rejected = contract.split(conformed)
    return Loaded(rejected if counts.get("rejected") else rejected.limit(0), report, published)


def save_table(df: DataFrame, table: str, location: str | None = None) -> None:
    """Replace a table by the rows of ``df``; the old rows stay until the new ones are written."""
    publish.publish(df, table, location)


build_mart = save_table
