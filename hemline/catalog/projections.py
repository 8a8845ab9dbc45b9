"""Projections, lookups, set operations and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from hemline.catalog.registry import query, table, texts
from hemline.contracts import Field, TableContract
from hemline.fixed_values import DEPTH2_NAMES, DEPTH3_KEYS
from hemline.functions import arrays, dates, documents, text
from hemline.operators import grouping, lookup, project
from hemline.plans.snap import gender_word

ITEM = TableContract("item_tb", (
    Field("item_no", "int", True), Field("brand_no", "int"), Field("kind_no", "int"), Field("price", "int"),
    Field("rate", "double"), Field("name", "string", True, 512), Field("made_on", "date"),
))


@query("conform_cast", """
select cast(p_partkey as int) as item_no, cast(replace(p_brand, 'Brand#', '') as int) as brand_no,
       cast(null as int) as kind_no, cast(trunc(p_retailprice) as int) as price, cast(p_size as double) as rate,
       p_name as name, case when p_size <= 28 then make_date(2025, 2, p_size) end as made_on
from part
""")
def conform_cast(spark, d):
    part = table(spark, d, "part").withColumnsRenamed({"p_name": "name"})
    return ITEM.conform(part, {
        "item_no": F.col("p_partkey").cast("string"),
        "brand_no": F.regexp_replace("p_brand", "Brand#", ""),
        "kind_no": "p_type",
        "price": F.col("p_retailprice").cast("string"),
        "rate": F.col("p_size").cast("string"),
        "made_on": F.concat(F.lit("2025-02-"), F.lpad(F.col("p_size").cast("string"), 2, "0")),
    })


@query("tag_columns", """
select c_custkey, 'shop' as platform, date '2025-01-02' as created_at, '' as brand_name_en, cast(null as varchar) as depth
from customer
""")
def tag_columns(spark, d):
    return project.tag(
        table(spark, d, "customer").select("c_custkey"),
        platform="shop", created_at=("2025-01-02", "date"), brand_name_en="", depth=(None, "string"),
    )


def _order_documents(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", F.struct(F.struct("o_orderstatus", "o_totalprice").alias("bill"), "o_orderpriority").alias("doc")
    )


@query("struct_path", "select o_orderkey, o_orderstatus as status, o_totalprice as total from orders")
def struct_path(spark, d):
    return _order_documents(spark, d).select(
        "o_orderkey", F.col("doc.bill.o_orderstatus").alias("status"), F.col("doc.bill.o_totalprice").alias("total")
    )


@query("struct_star", "select o_orderkey, o_orderpriority, o_orderstatus, o_totalprice from orders")
def struct_star(spark, d):
    return project.struct_fields(project.struct_fields(_order_documents(spark, d), "doc"), "bill")


@query("array_get", """
select p_partkey, string_split(p_name, ' ')[1] as first_word, string_split(p_name, ' ')[2] as second_word,
       string_split(p_name, ' ')[6] as sixth_word
from part
""")
def array_get(spark, d):
    words = F.split("p_name", " ")
    return table(spark, d, "part").select(
        "p_partkey", arrays.element(words, 0).alias("first_word"), arrays.element(words, 1).alias("second_word"),
        arrays.element(words, 5).alias("sixth_word"),
    )


def _codes(spark, d):
    """Customers with a code of which the dimension knows about half, and the dimension."""
    customer = table(spark, d, "customer").select("c_custkey", F.concat(F.lit("8_"), F.col("c_nationkey") * 2).alias("code"))
    dim = table(spark, d, "nation").select(
        F.concat(F.lit("8_"), "n_nationkey").alias("code"), F.col("n_name").alias("small_category_name"),
        F.concat(F.lit("region-"), "n_regionkey").alias("master_category_name"),
    )
    return customer, dim


@query("category_lookup_default", """
select c_custkey, '8_' || (c_nationkey * 2) as code,
       case when n_nationkey is null then 'Unknown' else 'region-' || n_regionkey end as master_category_name,
       coalesce(n_name, 'Unknown') as small_category_name
from customer left join nation on n_nationkey = c_nationkey * 2
""")
def category_lookup_default(spark, d):
    customer, dim = _codes(spark, d)
    return lookup.map_lookup(customer, "code", dim, "code", ["master_category_name", "small_category_name"], "Unknown")


@query("category_lookup_null", """
select c_custkey, '8_' || (c_nationkey * 2) as code, n_name as small_category_name
from customer left join nation on n_nationkey = c_nationkey * 2
""")
def category_lookup_null(spark, d):
    customer, dim = _codes(spark, d)
    return lookup.map_lookup(customer, "code", dim, "code", ["small_category_name"])


@query("category_lookup_large", """
select l_orderkey, l_linenumber, l_partkey, l_quantity, p_name, p_brand
from lineitem left join part on p_partkey = l_partkey
""")
def category_lookup_large(spark, d):
    # A dimension beyond the broadcast bound: the join shuffles instead.
    lineitem = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return lookup.map_lookup(
        lineitem, "l_partkey", table(spark, d, "part"), "p_partkey", ["p_name", "p_brand"], max_broadcast_rows=100
    )


@query("master_category", """
select distinct concat_ws('-', p_brand, nullif(p_type, 'ECONOMY'), nullif(p_size, 7)) as master_category_name from part
""")
def master_category(spark, d):
    name = text.compose_category(
        "p_brand", F.nullif("p_type", F.lit("ECONOMY")), F.nullif(F.col("p_size"), F.lit(7)).cast("string")
    )
    return project.distinct_rows(table(spark, d, "part").select(name.alias("master_category_name")))


@query("category_names", """
select p_partkey,
       case k when 0 then '신발' when 1 then '아우터' when 2 then '상의' when 3 then '하의' end as depth_2,
       case k when 0 then 'shoes' when 1 then 'knit' when 2 then 'skirt' when 3 then 'coat' end as depth_3_key,
       case k when 0 then '여성' when 1 then '남성' else 'kids' end as gender
from (select p_partkey, p_size % 5 as k from part)
""")
def category_names(spark, d):
    def pick(*names):
        return F.get(F.array(*[F.lit(n) for n in names]), F.col("p_size") % 5)

    return table(spark, d, "part").select(
        "p_partkey",
        text.translate_name(pick("shoes", "outer", "top", "bottom", "other"), DEPTH2_NAMES).alias("depth_2"),
        text.translate_name(pick("전체", "니트", "스커트", "코트"), DEPTH3_KEYS).alias("depth_3_key"),
        gender_word(pick("female", "MEN", "kids", "kids", "kids")).alias("gender"),
    )


@query("split_category", """
select p_partkey, split_part(c, '-', 1) as depth_1, split_part(c, '-', 2) as depth_2, split_part(c, '-', 3) as depth_3,
       split_part(c, '-', 4) as depth_4
from (select p_partkey, case when p_size = 7 then null else concat_ws('-', p_brand, p_type, p_size) end as c from part)
""")
def split_category(spark, d):
    name = F.when(F.col("p_size") != 7, text.compose_category("p_brand", "p_type", F.col("p_size").cast("string")))
    return table(spark, d, "part").select(
        "p_partkey", *[text.category_level(name, n).alias(f"depth_{n}") for n in (1, 2, 3, 4)]
    )


@query("label_pair", """
select l_orderkey, l_linenumber, l_partkey,
       case when l_returnflag <> 'N' and l_linestatus <> 'O' then l_returnflag || ', ' || l_linestatus
            when l_returnflag <> 'N' then l_returnflag when l_linestatus <> 'O' then l_linestatus end as labels
from lineitem
""")
def label_pair(spark, d):
    labels = F.array_compact(F.array(F.nullif("l_returnflag", F.lit("N")), F.nullif("l_linestatus", F.lit("O"))))
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", arrays.label_pair(labels).alias("labels")
    )


@query("rank_diff", """
select l_orderkey, l_partkey, l_linenumber - nullif(cast(l_quantity as int), 5) as prev_diff_rank from lineitem
""")
def rank_diff(spark, d):
    previous = F.nullif(F.col("l_quantity").cast("int"), F.lit(5))
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", project.difference("l_linenumber", previous).alias("prev_diff_rank")
    )


@query("union_by_name", """
select s_name as name, s_acctbal as balance, cast(null as varchar) as segment from supplier
union all select c_name, c_acctbal, c_mktsegment from customer
""")
def union_by_name(spark, d):
    supplier = table(spark, d, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"))
    customer = table(spark, d, "customer").select(
        F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance")
    )
    return project.union_all([supplier, customer]).select("name", "balance", "segment")


@query("distinct_rows", "select distinct l_returnflag, l_linestatus, l_suppkey from lineitem")
def distinct_rows(spark, d):
    return project.distinct_rows(table(spark, d, "lineitem"), "l_returnflag", "l_linestatus", "l_suppkey")


@query("left_join_using", """
select c_custkey, c_name, n_orders, top_price from customer left join
 (select o_custkey as k, cast(count(*) as bigint) as n_orders, max(o_totalprice) as top_price
  from orders where o_orderstatus = 'P' group by 1) on k = c_custkey
""")
def left_join_using(spark, d):
    spent = table(spark, d, "orders").where("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.max("o_totalprice").alias("top_price")
    )
    return grouping.left_join_using(table(spark, d, "customer").select("c_custkey", "c_name"), spent, "c_custkey")


@query("iso_duration", """
select doc_id, cast(n_chars as int) as seconds, cast(n_chars % 60 as int) as short_seconds,
       cast(floor(n_chars / 60) * 60 as int) as minutes_only, cast(null as int) as other_form
from documents
""")
def iso_duration(spark, d):
    n = F.col("n_chars")
    hours, minutes = F.floor(n / 3600).cast("string"), F.floor(n % 3600 / 60).cast("string")
    full = F.concat(F.lit("PT"), hours, F.lit("H"), minutes, F.lit("M"), (n % 60).cast("string"), F.lit("S"))
    return texts(spark, d, "documents").select(
        "doc_id",
        text.duration_seconds(full).alias("seconds"),
        text.duration_seconds(F.concat(F.lit("PT"), (n % 60).cast("string"), F.lit("S"))).alias("short_seconds"),
        text.duration_seconds(F.concat(F.lit("PT"), F.floor(n / 60).cast("string"), F.lit("M"))).alias("minutes_only"),
        text.duration_seconds(F.concat(F.lit("P"), n.cast("string"), F.lit("D"))).alias("other_form"),
    )


@query("strip_unit", """
select p_partkey, cast(p_size as double) as height, cast(null as double) as weight,
       cast(p_retailprice as double) as price
from part
""")
def strip_unit(spark, d):
    return table(spark, d, "part").select(
        "p_partkey",
        text.strip_unit(F.concat(F.col("p_size").cast("string"), F.lit("cm")), "cm").alias("height"),
        text.strip_unit(F.concat("p_type", F.lit("kg")), "kg").alias("weight"),
        text.strip_unit(F.concat(F.col("p_retailprice").cast("string"), F.lit(" kg")), "kg").alias("price"),
    )


@query("text_to_date", """
select event_id, cast(ts as date) as day, cast(null as date) as bad_day from events
""")
def text_to_date(spark, d):
    return table(spark, d, "events").select(
        "event_id", dates.text_to_date(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("day"),
        dates.text_to_date("event_type").alias("bad_day"),
    )


@query("compact_date", "select event_id, cast(ts as date) as day, cast(null as date) as bad_day from events")
def compact_date(spark, d):
    return table(spark, d, "events").select(
        "event_id", dates.compact_date(F.concat(F.lit(" "), F.date_format("ts", "yyyyMMdd"))).alias("day"),
        dates.compact_date(F.date_format("ts", "yyyyMM")).alias("bad_day"),
    )


@query("ts_offset_to_date", """
select event_id, cast(ts + interval 9 hour as date) as local_day, cast(ts as date) as utc_day,
       cast(ts + interval 330 minute as date) as short_day, cast(null as date) as no_offset
from events
""")
def ts_offset_to_date(spark, d):
    # The same wall-clock text with two offsets: nine hours ahead of and equal to UTC.
    wall = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    return table(spark, d, "events").select(
        "event_id",
        dates.offset_text_to_date(F.concat(wall, F.lit("+00:00"))).alias("local_day"),
        dates.offset_text_to_date(F.concat(wall, F.lit("+09:00"))).alias("utc_day"),
        dates.offset_text_to_date(F.concat(wall, F.lit("+0330"))).alias("short_day"),
        dates.offset_text_to_date(wall).alias("no_offset"),
    )


@query("ts_utc", """
select event_id, date_trunc('second', ts) as published_at, date_trunc('second', ts) - interval 9 hour as from_seoul,
       cast(null as timestamp) as no_offset
from events
""")
def ts_utc(spark, d):
    wall = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return table(spark, d, "events").select(
        "event_id", dates.utc_text_to_timestamp(F.concat(wall, F.lit("Z"))).alias("published_at"),
        dates.utc_text_to_timestamp(F.concat(wall, F.lit("+09:00"))).alias("from_seoul"),
        dates.utc_text_to_timestamp(wall).alias("no_offset"),
    )


@query("kst_date", """
select event_id, cast(ts + interval 9 hour as date) as business_date,
       cast(cast(ts + interval 9 hour as date) - 7 as date) as week_before
from events
""")
def kst_date(spark, d):
    day = dates.business_date("ts")
    return table(spark, d, "events").select(
        "event_id", day.alias("business_date"), F.date_sub(day, 7).alias("week_before")
    )


@query("url_parts", """
select page_id, split_part(split_part(url, '://', 2), '/', 1) as host, string_split(url, '/')[-1] as last_part,
       string_split(url, 'example.')[2] as after_mark, replace(string_split(url, '/')[-1], '?page', '_page') as renamed
from pages
""")
def url_parts(spark, d):
    last = text.last_path_part("url")
    return texts(spark, d, "pages").select(
        "page_id", text.url_host("url").alias("host"), last.alias("last_part"),
        text.text_after("url", "example.").alias("after_mark"),
        F.replace(last, F.lit("?page"), F.lit("_page")).alias("renamed"),
    )


@query("array_to_text", "select doc_id, replace(text, ' ', ', ') as words from documents")
def array_to_text(spark, d):
    return texts(spark, d, "documents").select("doc_id", arrays.array_to_text(F.split("text", " ")).alias("words"))


@query("tags_to_text", "select doc_id, replace(text, ' ', ',') as tags from documents")
def tags_to_text(spark, d):
    tags = F.transform(F.split("text", " "), lambda w: F.struct(w.alias("name"), F.length(w).alias("n")))
    tagged = texts(spark, d, "documents").select("doc_id", tags.alias("tags"))
    return tagged.select("doc_id", arrays.field_to_text("tags", "name").alias("tags"))


@query("set_to_flag", """
select doc_id, case when list_contains(w, 'the') and list_contains(w, 'le') then 'M/W' when list_contains(w, 'the') then 'M'
                    when list_contains(w, 'le') then 'W' end as gender
from (select doc_id, string_split(text, ' ') as w from documents)
""")
def set_to_flag(spark, d):
    return texts(spark, d, "documents").select(
        "doc_id", arrays.membership_flag(F.split("text", " "), "the", "le", ("M/W", "M", "W")).alias("gender")
    )


@query("array_filter", """
select doc_id, array_to_string(list_sort([w for w in list_distinct(string_split(text, ' ')) if w <> '' and w not in ('the', 'de', 'of')]), '|') as names
from documents
""")
def array_filter(spark, d):
    names = arrays.distinct_names(F.split("text", " "), ["the", "de", "of"])
    return texts(spark, d, "documents").select("doc_id", F.array_join(names, "|").alias("names"))


@query("json_parse", "select event_id, cast(json_extract(props, '$.k') as int) as k, cast(null as int) as malformed from events")
def json_parse(spark, d):
    return table(spark, d, "events").select(
        "event_id", documents.json_parse("props", "k int")["k"].alias("k"),
        documents.json_parse(F.concat(F.lit("["), "props"), "k int")["k"].alias("malformed"),
    )


@query("json_path", "select event_id, json_extract_string(props, '$.k') as k, cast(null as varchar) as missing from events")
def json_path(spark, d):
    return table(spark, d, "events").select(
        "event_id", documents.json_path("props", "$.k").alias("k"), documents.json_path("props", "$.a.b").alias("missing")
    )


# The stored titles hold no entity but the ampersand's; texts with others are stated as expected.
TITLE_SQL = "replace(split_part(split_part(html, '<title>', 2), '</title>', 1), '&amp;', '&')"


@query("html_fields", f"select page_id, {TITLE_SQL}" + r""" || ' Café 가 — Levi''s <b>' as title,
       split_part(split_part(html, '<html lang="', 2), '"', 1) as lang,
       cast(len(string_split(html, '<a href="')) + 2 as int) as n_links,
       array_to_string(list_concat([split_part(x, '"', 1) for x in string_split(html, '<a href="')[2:]], ['/b/o''neill', '/plain', '/two words']), ' ') as links,
       'Levi''s "Men"' as brand, '100' as price, cast(null as varchar) as twin
from pages
""")
def html_fields(spark, d):
    # Forms that the stored pages lack: entities, the other quote inside a value, no quotes, look-alike names.
    html = F.replace("html", F.lit("</title>"), F.lit(" Caf&eacute; &#44032; &#x2014; Levi&apos;s &lt;b&gt;</title>"))
    extra = """<meta data-property="og:twin" content="no"><meta content='Levi&#39;s "Men"' property='product:brand'>
<meta property=product:price content=100><meta name="x" content="property='og:twin' content='no'">
<a data-href="/no" href="/b/o'neill">b</a><A HREF=/plain class=c>c</A><a title="href='/no'" href='/two words'>d</a>"""
    pages = texts(spark, d, "pages").select("page_id", F.concat(html, F.lit(extra)).alias("html"))
    links = documents.page_links("html")
    return pages.select(
        "page_id", documents.page_title("html").alias("title"), documents.page_lang("html").alias("lang"),
        F.size(links).alias("n_links"), F.array_join(links, " ").alias("links"),
        documents.page_meta("html", "product:brand").alias("brand"),
        documents.page_meta("html", "product:price").alias("price"), documents.page_meta("html", "og:twin").alias("twin"),
    )
