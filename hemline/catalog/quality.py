"""Contracts, filters and defaults."""

from __future__ import annotations

from pyspark.sql import functions as F

from hemline.catalog.registry import query, table, texts
from hemline.contracts import Field, TableContract
from hemline.functions.casts import null_to_zero, to_double, to_int
from hemline.functions.dates import compact_date
from hemline.functions.text import duration_seconds, record_field
from hemline.operators import quality

EVENT = TableContract("event_tb", (
    Field("event_id", "bigint", True), Field("user_id", "bigint", True),
    Field("event_type", "string", True, 5), Field("value", "double", True), Field("props", "string", False, 8),
), key=("user_id", "event_type"))


@query("contract_report", """
with e as (select event_id, nullif(user_id, 7) as user_id, event_type, case when event_type = 'error' then null else value end as value, props from events),
k as (select user_id, event_type, count(*) as n from e group by all)
select 'event_id' as column_name, 'null' as rule, cast(count(*) filter (event_id is null) as bigint) as bad_rows from e
union all select 'user_id', 'null', cast(count(*) filter (user_id is null) as bigint) from e
union all select 'event_type', 'null', cast(count(*) filter (event_type is null) as bigint) from e
union all select 'event_type', 'too_long', cast(count(*) filter (strlen(event_type) > 5) as bigint) from e
union all select 'value', 'null', cast(count(*) filter (value is null) as bigint) from e
union all select 'props', 'too_long', cast(count(*) filter (strlen(props) > 8) as bigint) from e
union all select 'user_id,event_type', 'duplicate_key', cast(sum(n - 1) as bigint) from k
""")
def contract_report(spark, d):
    events = table(spark, d, "events").withColumns({
        "user_id": F.nullif(F.col("user_id"), F.lit(7)),
        "value": F.when(F.col("event_type") != "error", F.col("value")),
    })
    return EVENT.report(EVENT.conform(events))


DOCUMENT = TableContract("document_tb", (
    Field("doc_id", "bigint", True), Field("text", "string", True, 2000), Field("lang", "string", True, 2),
    Field("source", "string", True, 4),
))


@query("contract_bad_values", """
select 'price' as column_name, 'bad_value' as rule, cast(count(*) filter (event_type = 'click') as bigint) as bad_rows from events
union all select 'day', 'bad_value', cast(count(*) filter (event_id % 3 = 0) as bigint) from events
union all select 'name', 'bad_value', 0
union all select 'day', 'null', cast(count(*) filter (event_id % 3 = 0) as bigint) from events
""")
def contract_bad_values(spark, d):
    """Values that no cast can read are counted, missing ones are not."""
    contract = TableContract("reading_tb", (Field("price", "int"), Field("day", "date", True), Field("name", "string")))
    events = table(spark, d, "events").select(
        F.when(F.col("event_type") == "click", "n/a").when(F.col("event_type") != "view", F.floor(F.abs("value")).cast("string")).alias("price"),
        F.when(F.col("event_id") % 3 == 0, "2025-13-01").otherwise("2025-01-02").alias("day"), F.col("event_type").alias("name"),
    )
    return contract.report(contract.conform(events, mark_bad=True))


@query("contract_reject", """
select doc_id, array_to_string([x for x in [
    case when strlen(text) > 2000 then 'text:too_long' end,
    case when nullif(lang, 'de') is null then 'lang:null' end,
    case when strlen(source) > 4 then 'source:too_long' end] if x is not null], ',') as reasons
from documents where strlen(text) > 2000 or nullif(lang, 'de') is null or strlen(source) > 4
""")
def contract_reject(spark, d):
    documents = texts(spark, d, "documents").withColumn("lang", F.nullif("lang", F.lit("de")))
    _, rejected = DOCUMENT.split(DOCUMENT.conform(documents))
    return rejected.select("doc_id", F.array_join("reject_reasons", ",").alias("reasons"))


@query("contract_accept", """
select doc_id, lang, source, strlen(text) as n_bytes from documents
where strlen(text) <= 2000 and nullif(lang, 'de') is not null and strlen(source) <= 4
""")
def contract_accept(spark, d):
    documents = texts(spark, d, "documents").withColumn("lang", F.nullif("lang", F.lit("de")))
    good, _ = DOCUMENT.split(DOCUMENT.conform(documents))
    return good.select("doc_id", "lang", "source", F.octet_length("text").cast("bigint").alias("n_bytes"))


@query("text_records", """
select cast(l_shipdate as date) as day, cast(l_suppkey as int) as station, nullif(l_quantity, 1.0) as qty,
       l_extendedprice as price
from lineitem
""")
def text_records(spark, d):
    record = F.concat_ws(
        ",", F.date_format("l_shipdate", "yyyyMMdd"), F.col("l_suppkey").cast("string"),
        F.coalesce(F.nullif(F.col("l_quantity"), F.lit(1.0)).cast("string"), F.lit("")),
        F.col("l_extendedprice").cast("string"),
    )
    padded = F.concat(F.lit("  "), record, F.lit(" "))
    noise = [F.lit("# comment, 1"), F.lit("   "), F.lit("#START7777"), F.lit(" 7777END")]
    lines = texts(spark, d, "lineitem").select(
        F.explode(F.when(F.col("l_linenumber") == 1, F.array(*noise, padded)).otherwise(F.array(padded))).alias("value")
    )
    return quality.text_records(lines, ",").select(
        compact_date(record_field("fields", 0)).alias("day"), to_int(record_field("fields", 1)).alias("station"),
        to_double(record_field("fields", 2)).alias("qty"), to_double(record_field("fields", 3)).alias("price"),
    )


EVENT_NULLS = {
    "kind": "nullif(event_type, 'view')",
    "amount": "case when value >= 5 then value end",
}


@query("drop_null_rows", """
select event_id, nullif(event_type, 'view') as kind, value as amount from events
where event_type <> 'view' and value >= 5
""")
def drop_null_rows(spark, d):
    events = table(spark, d, "events").selectExpr("event_id", *[f"{sql} as {name}" for name, sql in EVENT_NULLS.items()])
    return quality.drop_null_rows(events)


@query("fill_defaults", """
select event_id, coalesce(nullif(event_type, 'view'), 'none') as kind,
       case when value >= 5 then value else 0.0 end as amount
from events
""")
def fill_defaults(spark, d):
    events = table(spark, d, "events").selectExpr("event_id", *[f"{sql} as {name}" for name, sql in EVENT_NULLS.items()])
    return quality.fill_defaults(events, {"kind": "none", "amount": 0.0})


@query("null_to_zero", "select event_id, case when event_type = 'error' then 0.0 else value end as amount from events")
def null_to_zero_query(spark, d):
    amount = F.when(F.col("event_type") != "error", F.col("value"))
    return table(spark, d, "events").select("event_id", null_to_zero(amount).alias("amount"))


@query("keep_between", "select doc_id, cast(n_chars as int) as seconds from documents where n_chars between 120 and 1800")
def keep_between(spark, d):
    n = F.col("n_chars")
    spoken = F.concat(
        F.lit("PT"), F.when(n >= 3600, F.concat(F.floor(n / 3600).cast("string"), F.lit("H"))).otherwise(""),
        F.floor(n % 3600 / 60).cast("string"), F.lit("M"), (n % 60).cast("string"), F.lit("S"),
    )
    videos = texts(spark, d, "documents").select("doc_id", duration_seconds(spoken).alias("seconds"))
    return quality.keep_between(videos, "seconds", 120, 1800)


@query("drop_missing_path", """
select c_custkey, c_acctbal from customer where c_mktsegment <> 'MACHINERY' and c_nationkey <> 3
""")
def drop_missing_path(spark, d):
    customer = table(spark, d, "customer").select("c_custkey", F.when(
        F.col("c_mktsegment") != "MACHINERY",
        F.struct(F.when(F.col("c_nationkey") != 3, F.struct("c_acctbal")).alias("like")),
    ).alias("item"))
    return quality.keep_present(customer, "item.like.c_acctbal").select("c_custkey", "item.like.c_acctbal")


@query("skip_empty", """
select doc_id, cast(len(string_split(text, chr(10))) - 1 as int) as total
from documents where len(string_split(text, chr(10))) > 1
""")
def skip_empty(spark, d):
    lines = F.split("text", "\n")
    payloads = texts(spark, d, "documents").select(
        "doc_id", (F.size(lines) - 1).alias("total"), F.slice(lines, 2, F.size(lines)).alias("entries")
    )
    return quality.skip_empty(payloads, "total", "entries").select("doc_id", "total")
