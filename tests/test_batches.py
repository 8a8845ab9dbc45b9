"""Batches are visible as a whole; loads take a file once; ids stay."""

import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from hemline.contracts import Field, TableContract
from hemline.operators.lasting import register_keys, with_lasting_id
from hemline.sources import batches

TABLE = TableContract("t", (Field("id", "int", True), Field("name", "string", False, 3)))
SCHEMA = "a int, b string"


def put(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.writelines(f"{line}\n" for line in lines)


def loader(spark, root, table):
    def load(read=None):
        read = read or (lambda paths: spark.read.schema(SCHEMA).csv(paths))
        return batches.load_new_files(spark, f"{root}/in/*/*.csv", read, TABLE, table, f"{root}/out")
    return load


def test_a_file_is_loaded_once(spark, tmp_path):
    load = loader(spark, tmp_path, "once_test")
    put(f"{tmp_path}/in/one", "a [1].csv", "1,x", "2,y")
    put(f"{tmp_path}/in/two", "a b.csv", "3,z", ",q", "4,long")
    assert load() == (2, 1, 3, 2)
    assert load() == (0, None, 0, 0)
    put(f"{tmp_path}/in/two", "c.csv", "5,w")
    assert load() == (1, 2, 1, 0)
    assert load() == (0, None, 0, 0)
    assert rows(spark.table("once_test")) == [(1, "x", 1), (2, "y", 1), (3, "z", 1), (5, "w", 2)]
    assert {tuple(r.reject_reasons) for r in batches.rejected_rows(spark, "once_test").collect()} == {("id:null",), ("name:too_long",)}
    ledger = {(r.path.rsplit("/", 1)[1], r["size"], r.batch_no) for r in batches.loaded_files(spark, "once_test").collect()}
    assert ledger == {("a [1].csv", 8, 1), ("a b.csv", 14, 1), ("c.csv", 4, 2)}


def test_a_failed_load_leaves_nothing_and_may_be_repeated(spark, tmp_path, monkeypatch):
    load = loader(spark, tmp_path, "fail_test")
    put(f"{tmp_path}/in/one", "a.csv", "1,x")

    def broken(paths):
        return spark.read.schema(SCHEMA).csv(paths).withColumn("b", F.raise_error(F.lit("gone")).cast("string"))

    with pytest.raises(Exception):
        load(broken)
    assert rows(spark.table("fail_test")) == [] and batches.loaded_files(spark, "fail_test").count() == 0
    # the ledger is registered, the rows are not: its entries don't count
    add = batches.add

    def stops(session, table, number, folder):
        if table == "fail_test":
            raise RuntimeError("killed")
        add(session, table, number, folder)

    with monkeypatch.context() as patched:
        patched.setattr(batches, "add", stops)
        with pytest.raises(RuntimeError):
            load()
    assert rows(spark.table("fail_test")) == [] and batches.rejected_rows(spark, "fail_test").count() == 0
    assert load().rows == 1 and load().files == 0
    assert [r[:2] for r in rows(spark.table("fail_test"))] == [(1, "x")]


def test_a_changed_file_is_refused(spark, tmp_path):
    load = loader(spark, tmp_path, "changed_test")
    put(f"{tmp_path}/in/one", "a.csv", "1,x")
    load()
    put(f"{tmp_path}/in/one", "a.csv", "1,x", "2,y")
    put(f"{tmp_path}/in/one", "b.csv", "3,z")
    with pytest.raises(batches.ChangedFiles):
        load()
    assert [r[:2] for r in rows(spark.table("changed_test"))] == [(1, "x")]


def test_a_number_is_taken_once(spark, tmp_path):
    batches.create(spark, "race_test", "x int", str(tmp_path / "t"))
    frame = spark.createDataFrame([(1,)], "x int")
    assert batches.append(frame, "race_test") == 1
    folder = batches.new_folder(spark, "race_test", 1)
    frame.write.parquet(folder)
    with pytest.raises(Exception):
        batches.add(spark, "race_test", 1, folder)
    assert rows(spark.table("race_test")) == [(1, 1)]


def test_ids_stay_when_keys_come(spark, tmp_path):
    def frame(*values):
        return spark.createDataFrame(list(values), "word string, sex string")

    def day(*values):
        new = register_keys(frame(*values), ["word", "sex"], "ids_test", str(tmp_path / "ids"), "trend_id")
        return new, {(r.word, r.sex): r.trend_id for r in spark.table("ids_test").collect()}

    n1, first = day(("a", "w"), ("b", "w"), ("a", None), ("a", "w"), (None, None))
    n2, second = day(("c", "m"), ("a", None), (None, None), ("d", "w"))
    n3, third = day(("a", "w"), ("d", "w"))
    n4, fourth = day()
    assert (n1, n2, n3, n4) == (4, 2, 0, 0)
    assert sorted(first.values()) == [1, 2, 3, 4] and sorted(second.values()) == [1, 2, 3, 4, 5, 6]
    assert all(second[k] == i for k, i in first.items()) and third == second == fourth
    seen = with_lasting_id(frame(("a", None), ("new", "w")), ["word", "sex"], "ids_test", "trend_id")
    assert rows(seen) == sorted([("a", None, first["a", None]), ("new", "w", None)], key=repr)
