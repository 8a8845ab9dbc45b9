"""Tables that grow by whole batches, and loads that may be repeated.

A batch is written to a folder of its own and becomes visible by one change in the catalog: its
partition is added to the table. A batch that fails before that leaves nothing to be read, and two
writers that took the same number can't both add it: the second one fails and changes nothing.

``load_new_files`` appends the files that no earlier load has taken. Each load notes path, size and
time of its files in a ledger table. The ledger's entries count only for numbers of visible batches,
so rows, rejects and ledger become valid by the same change.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hemline.contracts import TableContract
from hemline.sources import publish

BATCH = "batch_no"
LEDGER, REJECTS = "__files", "__rejects"
_WILDCARD = re.compile(r"([\\*?\[\]{}])")
_FILE_COLUMNS = "path string, size bigint, modified timestamp"


class ChangedFiles(ValueError):
    """Files that were loaded before have other contents now; the table is unchanged."""


class FileLoad(NamedTuple):
    """Files taken by a load, its batch (None if there was nothing new), and the rows loaded and rejected."""

    files: int
    batch: int | None
    rows: int
    rejected: int


def _quoted(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


def create(spark: SparkSession, table: str, columns: str, location: str) -> None:
    """Make an empty table of batches at a folder, unless there is one."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {BATCH} int) USING parquet PARTITIONED BY ({BATCH}) "
              f"LOCATION '{_quoted(location.rstrip('/'))}'")


def numbers(spark: SparkSession, table: str) -> list[int]:
    """Numbers of the visible batches."""
    if not spark.catalog.tableExists(table):
        return []
    return sorted(int(r[0].partition("=")[2]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect())


def new_folder(spark: SparkSession, table: str, number: int) -> str:
    """A folder that no other attempt at this batch uses."""
    return f"{publish.current_location(spark, table).rstrip('/')}/batch-{number:08d}-{uuid.uuid4().hex[:8]}"


def add(spark: SparkSession, table: str, number: int, folder: str) -> None:
    """Make a written folder visible as a batch; fails if that number is taken."""
    publish.make_folder(spark, folder)  # a batch without rows is one too
    spark.sql(f"ALTER TABLE {table} ADD PARTITION ({BATCH}={number}) LOCATION '{_quoted(folder)}'")
    spark.catalog.refreshTable(table)


def append(df: DataFrame, table: str) -> int:
    """Append the rows of ``df`` (columns of the table by name, without the batch) as the next batch; returns its number."""
    spark = df.sparkSession
    number = max(numbers(spark, table), default=0) + 1
    folder = new_folder(spark, table, number)
    columns = [c for c in spark.table(table).columns if c != BATCH]
    try:
        df.select(*columns).write.parquet(folder)
        add(spark, table, number, folder)
    except BaseException:
        publish.remove(spark, folder)
        raise
    return number


def list_files(spark: SparkSession, path: str | list[str], recursive: bool = False) -> DataFrame:
    """path, size and time of the files at a path with wildcards; no contents are read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    return reader.load(path).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def loaded_files(spark: SparkSession, table: str) -> DataFrame:
    """The ledger: every file whose rows the table holds, with its batch."""
    done = numbers(spark, table)
    if not done or not spark.catalog.tableExists(table + LEDGER):
        return spark.createDataFrame([], f"{_FILE_COLUMNS}, {BATCH} int")
    return spark.table(table + LEDGER).where(F.col(BATCH).isin(done))


def load_new_files(
    spark: SparkSession,
    path: str | list[str],
    read: Callable[[list[str]], DataFrame],
    contract: TableContract,
    table: str,
    location: str,
    recursive: bool = False,
) -> FileLoad:
    """Append the rows of all files at ``path`` that were not loaded before, mapped by position.

    ``read`` gives the rows of a list of paths. Rows that break a rule of the contract go to the table
    ``{table}__rejects`` with their reasons, by the same pass and in the same batch. Run again on the
    same files it adds nothing; after a failure, all of the failed load's files are new. A file that
    was loaded and has another size or time now raises ``ChangedFiles``: its rows stand in the table.

    The driver holds the paths of the new files, as it does for every scan of files.
    """
    root, plain = location.rstrip("/"), ", ".join(f"`{f.name}` {f.type}" for f in contract.fields)
    create(spark, table, plain, f"{root}/rows")
    create(spark, table + REJECTS, f"{plain}, reject_reasons array<string>", f"{root}/rejects")
    create(spark, table + LEDGER, _FILE_COLUMNS, f"{root}/files")
    known = loaded_files(spark, table).select("path", F.col("size").alias("old_size"), F.col("modified").alias("old_modified"))
    listed = list_files(spark, path, recursive).join(known, "path", "left").collect()
    changed = [f.path for f in listed if f.old_size is not None and (f["size"], f.modified) != (f.old_size, f.old_modified)]
    if changed:
        raise ChangedFiles(f"{table}: {len(changed)} loaded files have changed, first {min(changed)}")
    new = sorted((f.path, f["size"], f.modified) for f in listed if f.old_size is None)
    if not new:
        return FileLoad(0, None, 0, 0)
    # numbers of failed loads stay in the ledger unseen, so the next one is above all of them
    number = max(numbers(spark, table) + numbers(spark, table + REJECTS) + numbers(spark, table + LEDGER), default=0) + 1
    folders = {name: new_folder(spark, name, number) for name in (table, table + REJECTS, table + LEDGER)}
    rows = contract.by_position(read([_WILDCARD.sub(r"\\\1", p) for p, *_ in new]))
    marked = rows.withColumn("reject_reasons", contract.reject_reasons()).withColumn("fate", F.when(contract.rejects(), "rejected").otherwise("loaded"))
    try:
        marked.write.partitionBy("fate").parquet(folders[table])
        spark.createDataFrame(new, _FILE_COLUMNS).write.parquet(folders[table + LEDGER])
        add(spark, table + LEDGER, number, folders[table + LEDGER])
        add(spark, table + REJECTS, number, f"{folders[table]}/fate=rejected")
        add(spark, table, number, f"{folders[table]}/fate=loaded")  # now all three count
    except BaseException:
        for folder in folders.values():
            publish.remove(spark, folder)
        raise
    of = lambda name: spark.table(name).where(F.col(BATCH) == number).count()
    return FileLoad(len(new), number, of(table), of(table + REJECTS))


def rejected_rows(spark: SparkSession, table: str) -> DataFrame:
    """Rows that loads left out, with their reasons and batch; those of failed loads don't count."""
    done = numbers(spark, table)
    rejects = spark.table(table + REJECTS)
    return rejects.where(F.col(BATCH).isin(done)) if done else rejects.limit(0)
