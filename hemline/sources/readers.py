"""Bronze and silver readers. Schemas are explicit; inference is an option, not a default."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hemline.functions.text import file_stem

SOURCE_PATH = "source_path"
#: Text of a record that could not be read, and the place in its file at which its piece begins.
UNREADABLE, PIECE_START = "unreadable", "piece_start"


def zone_path(base: str, zone: str, run_date: str, *parts: str) -> str:
    """``base/zone/run_date/platform/topic...``"""
    return "/".join([base.rstrip("/"), zone, run_date, *[p.strip("/") for p in parts]])


def read_json(
    spark: SparkSession,
    path: str | list[str],
    schema=None,
    *,
    multiline: bool = False,
    recursive: bool = False,
    name_pattern: str | None = None,
    keep_path: bool = False,
    keep_unreadable: bool = False,
) -> DataFrame:
    """JSON documents: one per line, or (``multiline``) one pretty value per file.

    A file holding an array gives a row per element. ``path`` may hold wildcards;
    ``recursive`` descends into folders; ``name_pattern`` filters file names;
    ``keep_path`` adds the ``source_path`` column.

    A record that can't be read gives a row of NULLs; one with a value of another kind than its
    schema's, a row without that value. ``keep_unreadable`` (with a ``schema`` in DDL) adds what
    ``split_unreadable`` parts: the text of such records, the file and the place of the file's
    piece that they lie in.
    """
    reader = _reader(spark, f"{schema}, {UNREADABLE} string" if keep_unreadable else schema, recursive, name_pattern)
    reader = reader.option("multiLine", multiline).option("columnNameOfCorruptRecord", UNREADABLE)
    df = _with_path(reader.json(path), keep_path or keep_unreadable)
    if not keep_unreadable:
        return df
    return df.withColumn(PIECE_START, F.col("_metadata.file_block_start"))


def split_unreadable(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that could be read, at least in part; records that could not) of a frame read with ``keep_unreadable``.

    The records have source_path, piece_start, the text in ``record``, what could be read of it
    as JSON in ``readable``, and the reason: ``unreadable_record``, or ``unreadable_value`` for a
    record that is among the rows too. Together the two frames lose nothing of the source.
    """
    fields = [c for c in raw.columns if c not in (UNREADABLE, SOURCE_PATH, PIECE_START)]
    nothing = reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNull() for c in fields])
    whole = F.col(UNREADABLE).isNull()
    rows = raw.where(whole | ~nothing).select(*[f"`{c}`" for c in fields], SOURCE_PATH)
    rejects = raw.where(~whole).select(
        SOURCE_PATH, PIECE_START, F.col(UNREADABLE).alias("record"), F.to_json(F.struct(*[f"`{c}`" for c in fields])).alias("readable"),
        F.when(nothing, "unreadable_record").otherwise("unreadable_value").alias("reason"))
    return rows, rejects


def unreadable_lines(lines: DataFrame, schema: str) -> DataFrame:
    """The lines (column ``value``, with ``source_path``) that are no JSON records of this schema, in the same form."""
    parsed = lines.select("*", F.from_json("value", f"{schema}, {UNREADABLE} string", {"columnNameOfCorruptRecord": UNREADABLE}).alias("_r"))
    bare = parsed.where(F.col(f"_r.{UNREADABLE}").isNotNull())
    readable = F.to_json(F.col("_r").dropFields(UNREADABLE))
    return bare.select(
        SOURCE_PATH, F.lit(None).cast("bigint").alias(PIECE_START), F.col("value").alias("record"), readable.alias("readable"),
        F.when(readable == "{}", "unreadable_record").otherwise("unreadable_value").alias("reason"))


def read_text(
    spark: SparkSession,
    path: str | list[str],
    *,
    recursive: bool = False,
    name_pattern: str | None = None,
    keep_path: bool = False,
) -> DataFrame:
    """One row per line, in column ``value``."""
    return _with_path(_reader(spark, None, recursive, name_pattern).text(path), keep_path)


def read_csv(spark: SparkSession, path: str | list[str], schema=None, *, separator: str = ",") -> DataFrame:
    """Delimited text with a header; types are inferred only without a schema."""
    reader = _reader(spark, schema, False, None).option("header", True).option("sep", separator)
    return (reader if schema else reader.option("inferSchema", True)).csv(path)


def read_parquet(spark: SparkSession, path: str | list[str], columns: list[str] | None = None) -> DataFrame:
    """Parquet; the scan reads only ``columns``."""
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    return df.select(*columns) if columns else df


def _reader(spark, schema, recursive, name_pattern):
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if name_pattern:
        reader = reader.option("pathGlobFilter", name_pattern)
    return reader


def _with_path(df: DataFrame, keep: bool) -> DataFrame:
    # _metadata resolves only on the reader's own frame, so it is taken here. The path
    # is percent-encoded; a plus sign in it is a plus sign.
    encoded = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return df.select("*", F.url_decode(encoded).alias(SOURCE_PATH)) if keep else df


def source_key(extension: str = "json") -> Column:
    """Category key of a row: stem of the file it came from."""
    return file_stem(SOURCE_PATH, extension)


#: Places that the rows of one key are dealt to.
KEY_PARTS = 64

_FORMATS = ("parquet", "json", "csv", "txt", "text")


def read_sized(
    spark: SparkSession,
    path: str,
    fmt: str,
    key: str | None = None,
    target_mb: int = 128,
    lo: int | None = None,
    hi: int | None = None,
    schema=None,
) -> DataFrame:
    """Read ``path`` in one of the known formats, laid out in about ``target_mb`` pieces.

    Without ``key`` the scan's own splits are the layout as long as their number lies
    within ``lo`` and ``hi``; only otherwise are the rows spread evenly over the computed
    number of partitions. With ``key`` rows of a key are brought together in at most
    ``KEY_PARTS`` places each, which adaptive execution joins where they are small and splits
    where one is too large. That layout is none that an aggregate by the key could rely on: it
    combines its rows first. An unknown format is an error; HTML is read as a text column (see
    ``functions.documents``).
    """
    if fmt not in _FORMATS:
        raise ValueError(f"unsupported format: {fmt}")
    if fmt == "parquet":
        df = read_parquet(spark, path)
    elif fmt == "json":
        df = read_json(spark, path, schema)
    elif fmt == "text":
        df = read_text(spark, path)
    else:
        df = read_csv(spark, path, schema)
    if key is None and within(df.rdd.getNumPartitions(), lo, hi):
        return df
    n = partition_count(input_bytes(spark, path), target_mb, lo, hi)
    if not key:
        return df.repartition(n)
    part = F.pmod(F.spark_partition_id(), F.lit(min(KEY_PARTS, n)))
    return df.withColumn("_key_part", part).hint("rebalance", n, key, "_key_part").drop("_key_part")


def within(n: int, lo: int | None, hi: int | None) -> bool:
    return (lo is None or n >= lo) and (hi is None or n <= hi)


#: Bytes of files up to which ``spread`` moves rows.
SPREAD_BYTES = 256 * 1024 * 1024


def spread(df: DataFrame, path: str, max_bytes: int = SPREAD_BYTES) -> DataFrame:
    """Give every core a share of a small input that comes in fewer pieces than there are cores.

    For parsing-heavy work on small files below ``path``; files of more than ``max_bytes`` are
    left as scanned, however many cores there are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores or input_bytes(df.sparkSession, path) > max_bytes:
        return df
    return df.repartition(cores)


def partition_count(total_bytes: int, target_mb: int = 128, lo: int | None = None, hi: int | None = None) -> int:
    """Whole pieces of ``target_mb`` in ``total_bytes``, at least 1, within the bounds."""
    n = max(1, int(total_bytes / (1024 * 1024) / target_mb))
    if lo:
        n = max(n, lo)
    if hi:
        n = min(n, hi)
    return n


def input_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below ``path`` (wildcards allowed). Lists files, opens none."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
