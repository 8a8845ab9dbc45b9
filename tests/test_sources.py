"""Readers and writers."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from hemline.contracts import Field, TableContract
from hemline.session import shared_dir
from hemline.sources import readers, writers


def test_zone_path():
    assert readers.zone_path("s3a://zone/", "bronze", "2025-01-02", "shop", "/topic/") == "s3a://zone/bronze/2025-01-02/shop/topic"


def test_multiline_array_gives_a_row_per_element(spark, tmp_path):
    (tmp_path / "a b+c&한글.json").write_text(json.dumps([{"k": 1}, {"k": None}, {}], indent=4))
    df = readers.read_json(spark, str(tmp_path), "k int", multiline=True, keep_path=True)
    assert rows(df.select("k", readers.source_key())) == sorted([(1, "a b+c&한글"), (None, "a b+c&한글"), (None, "a b+c&한글")], key=repr)


def test_recursive_read_with_a_name_pattern(spark, tmp_path):
    for name in ("x/1_ids.json", "x/y/2_ids.json", "x/other.json"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text('{"k": 1}')
    assert readers.read_json(spark, str(tmp_path), "k int", recursive=True, name_pattern="*_ids.json").count() == 2


def test_a_missing_field_or_wrong_type_is_null(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"k": "x", "s": {"v": 1}}\n{broken\n')
    df = readers.read_json(spark, str(tmp_path), "k int, s struct<v: int>")
    assert rows(df.select("k", "s.v")) == sorted([(None, 1), (None, None)], key=repr)


def test_csv_with_and_without_schema(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,x\n2,y\n")
    assert readers.read_csv(spark, str(tmp_path), "id bigint, name string").dtypes[0] == ("id", "bigint")
    assert readers.read_csv(spark, str(tmp_path)).dtypes == [("id", "int"), ("name", "string")]


def test_read_sized(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(1000, numPartitions=3).write.parquet(path)
    assert readers.read_sized(spark, path, "parquet", lo=7, hi=9).rdd.getNumPartitions() == 7
    scanned = readers.read_sized(spark, path, "parquet")
    assert scanned.rdd.getNumPartitions() == spark.read.parquet(path).rdd.getNumPartitions()
    assert readers.read_sized(spark, path, "parquet", key="id").count() == 1000
    with pytest.raises(ValueError, match="unsupported format"):
        readers.read_sized(spark, path, "html")


def test_input_bytes_follows_wildcards(spark, tmp_path):
    for name in ("a/1.txt", "b/2.txt"):
        (tmp_path / name).parent.mkdir()
        (tmp_path / name).write_text("x" * 10)
    assert readers.input_bytes(spark, f"{tmp_path}/*/*.txt") == 20


@pytest.mark.parametrize("size_mb, lo, hi, wanted", [(0, None, None, 1), (300, None, None, 2), (300, 5, None, 5), (3000, None, 8, 8), (3000, 30, None, 30)])
def test_partition_count(size_mb, lo, hi, wanted):
    assert readers.partition_count(size_mb * 1024 * 1024, 128, lo, hi) == wanted


def test_spread_leaves_many_partitions_and_large_files_alone(spark, tmp_path):
    (tmp_path / "file.bin").write_bytes(b"x" * 1_000)
    path, many, one = str(tmp_path), spark.range(100, numPartitions=9), spark.range(100, numPartitions=1)
    assert readers.spread(many, path) is many
    assert readers.spread(one, path).rdd.getNumPartitions() == 4
    assert readers.spread(one, path, max_bytes=999) is one


def test_hot_key_of_a_keyed_read_is_dealt_and_counted_first(spark, tmp_path):
    path = str(tmp_path / "keyed")
    spark.range(20_000, numPartitions=8).selectExpr("if(id % 10 = 0, cast(id as string), 'hot') as k", "id").write.parquet(path)
    df = readers.read_sized(spark, path, "parquet", key="k", target_mb=1)
    counted = df.groupBy("k").count()
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(k") == 2 and "partial_count" in plan and "_key_part" in plan
    assert counted.where("k = 'hot'").first()["count"] == 18_000


def test_shared_dir_uses_the_configured_folder(spark):
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_partitioned_write_keeps_all_rows_of_a_hot_folder(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(3000).withColumn("p", F.when(F.col("id") < 1000, F.col("id") % 5).otherwise(9))
    writers.write_parquet(df, path, ["p"])
    writers.write_parquet(df, path, ["p"])
    assert readers.read_parquet(spark, path).count() == 3000


def test_files_are_cut_at_the_record_limit(spark, tmp_path):
    path = str(tmp_path / "cut")
    writers.write_parquet(spark.range(100, numPartitions=1), path, max_records_per_file=30)
    assert len(spark.read.parquet(path).inputFiles()) == 4


def test_replace_json_touches_only_the_given_folders(spark, tmp_path):
    path = str(tmp_path / "j")
    df = spark.createDataFrame([(1, None, "a"), (2, "x", "b")], "id int, v string, p string")
    writers.replace_json(df, path, ["p"])
    writers.replace_json(df.where("p = 'a'").withColumn("v", F.lit("new")), path, ["p"])
    assert rows(readers.read_json(spark, path, "id int, v string, p string")) == [(1, "new", "a"), (2, "x", "b")]


TABLE = TableContract("t", (Field("id", "int", True), Field("name", "string", False, 3)))


def test_load_table_refreshes_and_separates_rejects(spark, tmp_path):
    location = str(tmp_path / "t")
    a = spark.createDataFrame([("1", "abc")], "id string, name string")
    b = spark.createDataFrame([("toolong", 2), ("x", None)], "name string, id int")
    c = spark.createDataFrame([("n/a", "y")], "id string, name string")
    for _ in range(2):
        loaded = writers.load_table(TABLE, [a, b, c], "load_test", location)
    assert rows(spark.table("load_test")) == [(1, "abc")]
    assert rows(loaded.rejected.select("reject_reasons")) == [(["id:null"],), (["id:null"],), (["name:too_long"],)]
    assert rows(loaded.report) == [("id", "bad_value", 1), ("id", "null", 2), ("name", "bad_value", 0), ("name", "too_long", 1)]


def test_append_positional_adds_to_the_table(spark, tmp_path):
    writers.refresh_table(spark, TABLE, "append_test", str(tmp_path / "a"))
    df = spark.createDataFrame([("7", "x")], "name string, id string")
    writers.append_positional(df, TABLE, "append_test")
    writers.append_positional(df, TABLE, "append_test")
    assert rows(spark.table("append_test")) == [(7, "x"), (7, "x")]
    broken = spark.createDataFrame([("8", "abcdef"), (None, "z"), ("9", "ok")], "name string, id string")
    rejected = writers.append_positional(broken, TABLE, "append_test")
    assert rows(rejected.select("id", "reject_reasons")) == [(8, ["name:too_long"]), (None, ["id:null"])]
    assert rows(spark.table("append_test")) == [(7, "x"), (7, "x"), (9, "ok")]


@pytest.mark.parametrize("multiline", [False, True])
def test_unreadable_records_and_values(spark, tmp_path, multiline):
    texts = ['{"a": 1, "b": "x", "c": {"d": 1.5}}', '{"a": 1, "b"', '{"a": "n/a", "b": "y"}', '{"a": 2, "c": {"d": "n/a"}}', "[1]", '{"z": 0}']
    for i, text in enumerate(texts):
        (tmp_path / f"{i}.json").write_text(text + "\n")
    raw = readers.read_json(spark, str(tmp_path), "a int, b string, c struct<d: double>", multiline=multiline, keep_unreadable=True)
    kept, rejects = readers.split_unreadable(raw)
    assert kept.columns == ["a", "b", "c", "source_path"]
    assert rows(kept.select("a", "b")) == sorted([(1, "x"), (None, "y"), (2, None), (None, None)], key=repr)
    assert rows(rejects.select(F.trim(F.translate("record", "\n", "")), "reason")) == sorted([
        (texts[1], "unreadable_record"), (texts[2], "unreadable_value"), (texts[3], "unreadable_value"), (texts[4], "unreadable_record")], key=repr)
    assert {r["piece_start"] for r in rejects.collect()} == {0}
    assert kept.limit(0).count() == 0
