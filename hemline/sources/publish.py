"""Write, check, publish: how a table gets new contents without ever losing the old ones.

Every version of a table is a folder of its own below the table's root. ``publish`` writes the next
version beside the current one, has it checked there, and only then points the table to it, which is
one change in the catalog. Whatever fails before that leaves the table as it was, and queries that
still read the last version find their files: it is kept, and ``rollback`` returns to it.

The next version may be computed from the table itself. One load of a table runs at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

VERSION = "version-"
#: Versions that stay: the current one and the one before.
KEPT = 2


class Published(NamedTuple):
    """The folder the table now reads, the one it read before, and the rows of the new one."""

    version: str
    previous: str | None
    rows: int


class CheckFailed(ValueError):
    """A staged version was refused; the table is unchanged."""


def _files(spark: SparkSession, path: str):
    """The file system of a path and the path as it names it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _files(spark, path)
    fs.delete(p, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _files(spark, path)
    fs.mkdirs(p)


def versions(spark: SparkSession, root: str) -> list[str]:
    """Folders of all versions below ``root``, the oldest first."""
    fs, p = _files(spark, root)
    if not fs.exists(p):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(p))
    return [f"{root.rstrip('/')}/{n}" for n in names if n.startswith(VERSION)]


def current_location(spark: SparkSession, table: str) -> str | None:
    """The folder that the table reads; None if there is no such table."""
    if not spark.catalog.tableExists(table):
        return None
    return spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"]


def root_of(spark: SparkSession, table: str, location: str | None = None) -> str:
    """Where the versions of a table lie: ``location``, else a folder beside its database's tables."""
    if location:
        return location.rstrip("/")
    parts = table.replace("`", "").split(".")
    database = spark.catalog.getDatabase(parts[-2] if len(parts) > 1 else spark.catalog.currentDatabase())
    return f"{database.locationUri.rstrip('/')}/{parts[-1]}__versions"


def _name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def _switch(spark: SparkSession, table: str, staged: DataFrame, version: str, create: Callable[[str], str] | None) -> None:
    """Point the table to ``version``: by one change of its location, or anew where its columns differ."""
    quoted = version.replace("\\", "\\\\").replace("'", "\\'")
    if spark.catalog.tableExists(table):
        managed = spark.catalog.getTable(table).tableType == "MANAGED"
        if not managed and spark.table(table).dtypes == staged.dtypes:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{quoted}'")
            spark.catalog.refreshTable(table)
            return
        if managed:  # dropping it would remove its files: they are taken from it first
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{quoted}.taken-over'")
        spark.sql(f"DROP TABLE {table}")  # the files of an external table stay
    columns = ", ".join(f"`{name.replace('`', '``')}` {kind}" for name, kind in staged.dtypes)
    spark.sql(create(version) if create else f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{quoted}'")


def publish(
    df: DataFrame,
    table: str,
    location: str | None = None,
    create: Callable[[str], str] | None = None,
    check: Callable[[DataFrame], None] | None = None,
    kept: int = KEPT,
) -> Published:
    """Replace the contents of ``table`` by the rows of ``df``.

    ``check`` sees the staged version as it was written and raises to refuse it. ``create`` gives
    the statement that makes the table at a folder; without it, its columns are those of ``df``.
    Versions older than the ``kept`` newest are removed after the switch.
    """
    spark = df.sparkSession
    root = root_of(spark, table, location)
    numbers = [int(_name(v)[len(VERSION):].split("-")[0]) for v in versions(spark, root)]
    version = f"{root}/{VERSION}{max(numbers, default=0) + 1:08d}-{uuid.uuid4().hex[:8]}"
    try:
        df.write.parquet(version)
        staged = spark.read.schema(df.schema).parquet(version)
        rows = staged.count()  # from the files' footers
        if check:
            check(staged)
    except BaseException:
        remove(spark, version)
        raise
    previous = current_location(spark, table)
    _switch(spark, table, staged, version, create)
    before = [v for v in versions(spark, root) if _name(v) < _name(version)]
    stays = {_name(v) for v in before[len(before) - (kept - 1):]} | ({_name(previous)} if previous and kept > 1 else set())
    for old in before:
        if _name(old) not in stays:
            remove(spark, old)
    return Published(version, previous, rows)


def rollback(spark: SparkSession, table: str) -> str:
    """Point the table back to the newest version before its current one; returns that folder."""
    now = current_location(spark, table)
    if now is None or not _name(now).startswith(VERSION):
        raise ValueError(f"{table} is no published table")
    before = [v for v in versions(spark, now.rstrip("/").rsplit("/", 1)[0]) if _name(v) < _name(now)]
    if not before:
        raise ValueError(f"{table} has no version before {_name(now)}")
    _switch(spark, table, spark.read.parquet(before[-1]), before[-1], None)
    return before[-1]
