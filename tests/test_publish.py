"""Tables keep their rows until new ones are written and checked."""

import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from hemline.contracts import Field, TableContract
from hemline.sources import publish, writers

TABLE = TableContract("t", (Field("id", "int", True), Field("name", "string", False, 3)))


def frame(spark, *values):
    return spark.createDataFrame(list(values), "id int, name string")


def gone(spark):
    """A source that fails while it is read."""
    return frame(spark, (1, "x")).withColumn("name", F.raise_error(F.lit("gone")).cast("string"))


def test_a_failing_source_leaves_the_old_rows(spark, tmp_path):
    root = str(tmp_path / "t")
    writers.load_table(TABLE, [frame(spark, (1, "a"), (2, "b"))], "keep_test", root)
    for load in (
        lambda: writers.load_table(TABLE, [frame(spark, (3, "c")), gone(spark)], "keep_test", root),
        lambda: writers.save_table(gone(spark), "keep_test", root),
        lambda: writers.load_table(TABLE, [spark.read.schema("id int, name string").parquet(str(tmp_path / "no such folder"))], "keep_test", root),
    ):
        with pytest.raises(Exception):
            load()
        assert rows(spark.table("keep_test")) == [(1, "a"), (2, "b")]
        assert len(publish.versions(spark, root)) == 1


def test_a_refused_version_is_not_published(spark, tmp_path):
    root = str(tmp_path / "t")
    bad = [frame(spark, (1, "a"), (None, "b"), (None, "c"))]
    with pytest.raises(publish.CheckFailed):
        writers.load_table(TABLE, bad, "refuse_test", root, max_rejected=0.5)
    assert not spark.catalog.tableExists("refuse_test")
    loaded = writers.load_table(TABLE, bad, "refuse_test", root, max_rejected=0.7)
    assert rows(spark.table("refuse_test")) == [(1, "a")] and loaded.rejected.count() == 2
    assert loaded.published.rows == 1 and loaded.published.previous is None

    def nothing(staged):
        raise publish.CheckFailed("no")

    with pytest.raises(publish.CheckFailed):
        publish.publish(frame(spark, (9, "z")), "refuse_test", root, check=nothing)
    assert rows(spark.table("refuse_test")) == [(1, "a")]


def test_two_versions_are_kept_and_one_can_return(spark, tmp_path):
    root = str(tmp_path / "t")
    for n in range(1, 5):
        publish.publish(frame(spark, (n, "x")), "versions_test", root)
        assert rows(spark.table("versions_test")) == [(n, "x")]
    assert len(publish.versions(spark, root)) == 2 and len(os.listdir(root)) == 2
    publish.rollback(spark, "versions_test")
    assert rows(spark.table("versions_test")) == [(3, "x")]
    publish.publish(spark.table("versions_test").withColumn("id", F.col("id") * 10), "versions_test", root)  # from itself
    assert rows(spark.table("versions_test")) == [(30, "x")]
    assert publish.rollback(spark, "versions_test") is not None
    with pytest.raises(ValueError):
        spark.sql("create table plain_test (id int) using parquet")
        publish.rollback(spark, "plain_test")


def test_a_query_that_began_before_still_finds_its_files(spark, tmp_path):
    root = str(tmp_path / "t")
    publish.publish(frame(spark, (1, "old")), "reader_test", root)
    old = spark.read.parquet(publish.current_location(spark, "reader_test"))
    publish.publish(frame(spark, (2, "new")), "reader_test", root)
    assert rows(old) == [(1, "old")] and rows(spark.table("reader_test")) == [(2, "new")]


def test_columns_may_change_and_managed_tables_are_taken_over(spark, tmp_path):
    frame(spark, (1, "a")).write.saveAsTable("managed_test")
    publish.publish(frame(spark, (2, "b")), "managed_test")
    assert rows(spark.table("managed_test")) == [(2, "b")]
    publish.publish(spark.createDataFrame([(1.5,)], "`other name` double"), "managed_test")
    assert spark.table("managed_test").dtypes == [("other name", "double")] and rows(spark.table("managed_test")) == [(1.5,)]
    publish.rollback(spark, "managed_test")
    assert rows(spark.table("managed_test")) == [(2, "b")]
    quoted = str(tmp_path / "it's")
    publish.publish(frame(spark, (5, "q")), "quoted_test", quoted)
    assert rows(spark.table("quoted_test")) == [(5, "q")]


def test_empty_tables_are_published(spark, tmp_path):
    published = publish.publish(frame(spark, (1, "a")).limit(0), "empty_test", str(tmp_path / "t"))
    assert published.rows == 0 and spark.table("empty_test").count() == 0
