"""Sources and sinks: round trips through files and tables."""

from __future__ import annotations

import uuid

from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from hemline.catalog.registry import query, table
from hemline.contracts import Field, TableContract
from hemline.functions.casts import to_double, to_int, to_long
from hemline.functions.text import record_field, record_fields
from hemline.operators.project import union_all
from hemline.session import shared_dir
from hemline.sources import batches, publish, readers, writers

CUSTOMER_SCHEMA = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
CUSTOMER_SQL = "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer"


def _new_table(label: str) -> str:
    return f"hemline_{label}_{uuid.uuid4().hex}"


@query("scan_json_lines", CUSTOMER_SQL)
def scan_json_lines(spark, d):
    path = shared_dir(spark, "json_lines")
    table(spark, d, "customer").write.json(path)
    return readers.read_json(spark, path, CUSTOMER_SCHEMA)


@query("scan_json_multiline", CUSTOMER_SQL)
def scan_json_multiline(spark, d):
    # One pretty-printed array per file, 5,000 customers at most (the key is unique), in one folder.
    path = shared_dir(spark, "json_multiline")
    rows = table(spark, d, "customer").withColumn("page", F.floor(F.col("c_custkey") / 5_000))
    pages = rows.groupBy("page").agg(
        F.to_json(F.collect_list(F.struct(*[c for c in rows.columns if c != "page"])), {"pretty": "true"}).alias("value")
    )
    pages.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return readers.read_json(spark, f"{path}/*.txt", CUSTOMER_SCHEMA, multiline=True)


@query("scan_json_schema", """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, cast(o_orderdate as date) as o_orderdate, o_orderpriority
from orders
""")
def scan_json_schema(spark, d):
    path = shared_dir(spark, "json_schema")
    table(spark, d, "orders").select(F.struct(
        "o_orderkey",
        F.struct("o_orderstatus", "o_orderpriority").alias("state"),
        F.array(F.struct("o_custkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate"))).alias("bills"),
    ).alias("order")).write.json(path)
    schema = """order struct<o_orderkey: bigint, state: struct<o_orderstatus: string, o_orderpriority: string>,
                bills: array<struct<o_custkey: bigint, o_totalprice: double, o_orderdate: date>>>"""
    read = readers.read_json(spark, path, schema)
    return read.select("order.o_orderkey", "order.state.*", F.get("order.bills", 0).alias("b")).select("*", "b.*").drop("b")


@query("scan_text_lines", "select p_partkey, p_name, p_brand, p_type, p_size, p_retailprice from part")
def scan_text_lines(spark, d):
    path = shared_dir(spark, "text_lines")
    part = table(spark, d, "part")
    part.select(F.concat_ws("|", *[F.col(c).cast("string") for c in part.columns]).alias("value")).write.text(path)
    fields = readers.read_text(spark, path).select(record_fields("value", r"\|").alias("f"))
    return fields.select(
        to_long(record_field("f", 0)).alias("p_partkey"), record_field("f", 1).alias("p_name"),
        record_field("f", 2).alias("p_brand"), record_field("f", 3).alias("p_type"),
        to_int(record_field("f", 4)).alias("p_size"), to_double(record_field("f", 5)).alias("p_retailprice"),
    )


@query("scan_parquet_pruned", "select distinct l_partkey from lineitem")
def scan_parquet_pruned(spark, d):
    return readers.read_parquet(spark, f"{d}/lineitem.parquet", ["l_partkey"]).distinct()


@query("scan_csv", "select s_suppkey, s_name, s_nationkey, s_acctbal from supplier")
def scan_csv(spark, d):
    path = shared_dir(spark, "csv")
    table(spark, d, "supplier").write.option("header", True).csv(path)
    return readers.read_csv(spark, path, "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double")


@query("read_sized", """
select l_returnflag, cast(count(*) as bigint) as n_rows, sum(l_quantity) as sum_qty from lineitem group by l_returnflag
""")
def read_sized(spark, d):
    df = readers.read_sized(spark, f"{d}/lineitem.parquet", "parquet", lo=4)
    return df.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").alias("sum_qty"))


@query("read_sized_by_key", """
select l_returnflag, cast(count(*) as bigint) as n_rows, sum(l_quantity) as sum_qty from lineitem group by l_returnflag
""")
def read_sized_by_key(spark, d):
    df = readers.read_sized(spark, f"{d}/lineitem.parquet", "parquet", key="l_returnflag", target_mb=16)
    return df.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").alias("sum_qty"))


@query("scan_glob", """
select 'wildcard' as way, o_orderpriority as folder, o_orderkey, o_totalprice from orders
union all
select 'recursive', o_orderpriority, o_orderkey, o_totalprice from orders
""")
def scan_glob(spark, d):
    path = shared_dir(spark, "glob")
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    writers.replace_json(orders, path, ["o_orderpriority"])
    schema = "o_orderkey bigint, o_totalprice double"
    folder = F.regexp_extract(readers.SOURCE_PATH, "/o_orderpriority=([^/]+)/", 1)
    ways = {
        "wildcard": readers.read_json(spark, f"{path}/*/*.json", schema, keep_path=True),
        "recursive": readers.read_json(spark, path, schema, recursive=True, name_pattern="*.json", keep_path=True),
    }
    return union_all([
        df.select(F.lit(way).alias("way"), folder.alias("folder"), "o_orderkey", "o_totalprice")
        for way, df in ways.items()
    ])


@query("source_key", "select 'events' as source_key, event_type, cast(count(*) as bigint) as n_rows from events group by event_type")
def source_key(spark, d):
    events = table(spark, d, "events").select("*", F.col("_metadata.file_path").alias(readers.SOURCE_PATH))
    return events.groupBy(readers.source_key("parquet").alias("source_key"), "event_type").agg(F.count(F.lit(1)).alias("n_rows"))


ORDERS_SQL = "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from orders"


@query("path_partitions", ORDERS_SQL)
def path_partitions(spark, d):
    path = readers.zone_path(shared_dir(spark, "zones"), "silver", "2025-01-02", "shop", "orders")
    orders = table(spark, d, "orders")
    writers.write_parquet(orders, path, ["o_orderstatus"])
    return readers.read_parquet(spark, path, orders.columns)


@query("sink_parquet", CUSTOMER_SQL)
def sink_parquet(spark, d):
    path = shared_dir(spark, "sink_parquet")
    customer = table(spark, d, "customer")
    writers.write_parquet(customer.withColumn("c_acctbal", F.lit(0.0)), path)
    writers.write_parquet(customer, path)
    return readers.read_parquet(spark, path)


@query("sink_json_replace", """
select c_custkey, c_name, case when c_mktsegment = 'BUILDING' then 0.0 else c_acctbal end as c_acctbal, c_mktsegment
from customer
""")
def sink_json_replace(spark, d):
    path = shared_dir(spark, "json_replace")
    customer = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    writers.replace_json(customer, path, ["c_mktsegment"])
    again = customer.where("c_mktsegment = 'BUILDING'").withColumn("c_acctbal", F.lit(0.0))
    writers.replace_json(again, path, ["c_mktsegment"])
    schema = "c_custkey bigint, c_name string, c_acctbal double, c_mktsegment string"
    return readers.read_json(spark, path, schema)


PART_ITEM = TableContract("part_item_tb", (
    Field("item_no", "bigint", True), Field("item_name", "string", True, 512), Field("item_size", "int"),
    Field("price", "double"),
), key=("item_no",))


@query("load_positional", """
select 'loaded' as way, p_partkey as item_no, p_name as item_name, p_size as item_size, p_retailprice as price, '' as reasons from part where p_size <> 3 and length(p_name) <= 512
union all select 'rejected', case when p_size <> 3 then p_partkey end, p_name, p_size, p_retailprice, 'item_no:null' from part where p_size = 3
""")
def load_positional(spark, d):
    name = _new_table("positional")
    writers.refresh_table(spark, PART_ITEM, name, shared_dir(spark, "load_positional"))
    part = table(spark, d, "part").select(F.when(F.col("p_size") != 3, F.col("p_partkey")), "p_name", "p_size", "p_retailprice")
    rejected = writers.append_positional(part, PART_ITEM, name)
    loaded = spark.table(name).select(F.lit("loaded").alias("way"), "*", F.lit("").alias("reasons"))
    return loaded.unionByName(rejected.select(
        F.lit("rejected").alias("way"), *PART_ITEM.columns, F.array_join("reject_reasons", ",").alias("reasons")))


@query("load_subfolders", """
select o_orderkey as item_no, o_orderpriority as item_name, cast(o_custkey as int) as item_size, o_totalprice as price from orders
""")
def load_subfolders(spark, d):
    """Append the files of all sub-folders to a table, whichever folder they lie in."""
    path, name = shared_dir(spark, "subfolders"), _new_table("subfolders")
    writers.refresh_table(spark, PART_ITEM, name, shared_dir(spark, "load_subfolders"))
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("folder"), "o_orderpriority", "o_custkey", "o_totalprice")
    writers.replace_json(orders, path, ["folder"])
    found = readers.read_json(spark, f"{path}/*/*.json", "o_orderkey bigint, o_orderpriority string, o_custkey int, o_totalprice double")
    writers.append_positional(found, PART_ITEM, name)
    return spark.table(name)


@query("load_new_files", """
with o as (select *, o_orderkey % 97 = 3 as bad, case when o_orderpriority < '3' then 1 else 2 end as batch_no from orders)
select case when bad then 'rejected' else 'loaded' end as way, case when not bad then o_orderkey end as item_no, o_orderpriority as item_name,
  cast(o_custkey as int) as item_size, o_totalprice as price, batch_no, case when bad then 'item_no:null' else '' end as reasons from o
""")
def load_new_files(spark, d):
    """The folders of a first day, the same day again, all folders, and these again: every file is loaded once."""
    path, name, root = shared_dir(spark, "new_files"), _new_table("new_files"), shared_dir(spark, "load_new_files")
    schema = "o_orderkey bigint, o_orderpriority string, o_custkey int, o_totalprice double"
    key = F.when(F.col("o_orderkey") % 97 != 3, F.col("o_orderkey")).alias("o_orderkey")
    orders = table(spark, d, "orders").select(key, F.col("o_orderpriority").alias("folder"), "o_orderpriority", "o_custkey", "o_totalprice")

    def load():
        return batches.load_new_files(
            spark, f"{path}/*/*.json", lambda paths: readers.read_json(spark, paths, schema), PART_ITEM, name, root)

    for day in (F.col("folder") < "3", F.col("folder") >= "3"):
        writers.replace_json(orders.where(day), path, ["folder"])
        load()
        load()
    loaded = spark.table(name).select(F.lit("loaded").alias("way"), "*", F.lit("").alias("reasons"))
    return loaded.unionByName(batches.rejected_rows(spark, name).select(
        F.lit("rejected").alias("way"), *PART_ITEM.columns, batches.BATCH, F.array_join("reject_reasons", ",").alias("reasons")))


LINE = TableContract("line_tb", (
    Field("l_orderkey", "bigint", True), Field("l_partkey", "bigint", True), Field("l_suppkey", "bigint", True),
    Field("l_linenumber", "int", True), Field("l_quantity", "double"), Field("l_extendedprice", "double"),
    Field("l_returnflag", "string", False, 1), Field("l_linestatus", "string", False, 1),
))


@query("full_refresh", f"select {', '.join(LINE.columns)} from lineitem")
def full_refresh(spark, d):
    name, location = _new_table("refresh"), shared_dir(spark, "full_refresh")
    lineitem = table(spark, d, "lineitem")
    writers.load_table(LINE, [lineitem], name, location)
    writers.load_table(LINE, [lineitem], name, location)
    return spark.table(name)


ORDER_HEAD = TableContract("order_tb", (
    Field("o_orderkey", "bigint", True), Field("o_orderstatus", "string", True, 1),
    Field("o_totalprice", "double"), Field("source", "string", True, 10),
), key=("o_orderkey",))


@query("multi_source_load", """
select o_orderkey, o_orderstatus, o_totalprice, case when o_orderstatus in ('F', 'O') then lower(o_orderstatus) else 'other' end as source from orders
""")
def multi_source_load(spark, d):
    name = _new_table("sources")
    orders = table(spark, d, "orders")
    status = F.coalesce("o_orderstatus", F.lit(""))
    sources = [
        *[orders.where(status == known).withColumn("source", F.lit(known.lower())) for known in ("F", "O")],
        orders.where(~status.isin("F", "O")).withColumn("source", F.lit("other")),
    ]
    writers.load_table(ORDER_HEAD, sources, name, shared_dir(spark, "multi_source"))
    return spark.table(name)


@query("mart_ctas", """
select l_returnflag, l_linestatus, sum(l_quantity) as sum_qty, cast(count(*) as bigint) as n_lines
from lineitem group by l_returnflag, l_linestatus
""")
def mart_ctas(spark, d):
    name = _new_table("mart")
    mart = table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"), F.count(F.lit(1)).alias("n_lines")
    )
    writers.build_mart(mart, name, shared_dir(spark, "mart"))
    return spark.table(name)


@query("staged_refresh", """
select 'after failures' as state, s_suppkey, s_name, s_acctbal from supplier
union all select 'refreshed', s_suppkey, s_name, s_acctbal + 1 from supplier
union all select 'rolled back', s_suppkey, s_name, s_acctbal from supplier
""")
def staged_refresh(spark, d):
    """A table after refreshes that fail in a source and in a check, after a good one from itself, and taken back."""
    name, root = _new_table("staged"), shared_dir(spark, "staged_refresh")
    contract = TableContract("supplier_tb", (
        Field("s_suppkey", "bigint", True), Field("s_name", "string", True, 25), Field("s_acctbal", "double")), key=("s_suppkey",))
    supplier = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    writers.load_table(contract, [supplier], name, root)
    broken = supplier.withColumn("s_name", F.when(F.col("s_suppkey") >= 0, F.raise_error(F.lit("source is gone"))).otherwise(F.col("s_name")))
    doubtful = supplier.withColumn("s_name", F.when(F.col("s_suppkey") % 3 == 0, F.col("s_name")))
    for source in (broken, doubtful):
        try:
            writers.load_table(contract, [supplier, source], name, root, max_rejected=0.1)
        except (SparkRuntimeException, publish.CheckFailed):
            continue
        raise AssertionError("a refresh from a failing source was published")
    states = []

    def note(state):
        # read by folder: a table's own frame would follow the table
        states.append(spark.read.parquet(publish.current_location(spark, name)).select(F.lit(state).alias("state"), "*"))

    note("after failures")
    writers.load_table(contract, [spark.table(name).withColumn("s_acctbal", F.col("s_acctbal") + 1)], name, root)
    note("refreshed")
    publish.rollback(spark, name)
    note("rolled back")
    return union_all(states)


@query("unreadable_records", """
with c as (select c_custkey, c_name, c_nationkey, c_custkey % 10 as k,
  '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_nationkey":' || c_nationkey || '}' as whole from customer)
select 'row' as kind, c_custkey, c_name, case when k <> 3 then c_nationkey end as c_nationkey, null as record from c where k not in (1, 2)
union all select 'unreadable_value', c_custkey, c_name, null, replace(whole, ',"c_nationkey":' || c_nationkey, ',"c_nationkey":"n/a"') from c where k = 3
union all select 'unreadable_record', null, null, null, whole[1:20] from c where k = 1
union all select 'unreadable_record', null, null, null, '<html>' || c_name from c where k = 2
""")
def unreadable_records(spark, d):
    """Lines that are cut, no JSON at all, or hold a value of another kind: rows and rejects of one source."""
    path, k = shared_dir(spark, "unreadable"), F.col("c_custkey") % 10
    nation = F.when(k == 3, '"n/a"').otherwise(F.col("c_nationkey").cast("string"))
    whole = F.concat(F.lit('{"c_custkey":'), "c_custkey", F.lit(',"c_name":"'), "c_name", F.lit('","c_nationkey":'), nation, F.lit("}"))
    line = F.when(k == 1, F.substring(whole, 1, 20)).when(k == 2, F.concat(F.lit("<html>"), "c_name")).otherwise(whole)
    table(spark, d, "customer").select(line.alias("value")).write.text(path)
    schema = "c_custkey bigint, c_name string, c_nationkey int"
    kept, rejects = readers.split_unreadable(readers.read_json(spark, path, schema, keep_unreadable=True))
    readable = F.from_json("readable", schema)
    return kept.select(F.lit("row").alias("kind"), "c_custkey", "c_name", "c_nationkey", F.lit(None).cast("string").alias("record")).unionByName(
        rejects.select(F.col("reason").alias("kind"), readable["c_custkey"].alias("c_custkey"), readable["c_name"].alias("c_name"),
                       readable["c_nationkey"].alias("c_nationkey"), "record"))
