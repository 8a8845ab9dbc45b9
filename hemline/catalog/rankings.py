"""Top-n, newest, latest, last-wins, stable ids, lists per group."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from hemline.catalog.registry import query, table
from hemline.fixed_values import NEWEST_REVIEWS
from hemline.operators import lasting, ranking
from hemline.plans import collect, trend
from hemline.session import shared_dir


@query("top2_labels", """
with c as (select user_id, event_type, count(*) as n from events group by all),
r as (select *, row_number() over (partition by user_id order by n desc, event_type) as pos from c)
select user_id, max(event_type) filter (pos = 1) as labels_name_1, max(event_type) filter (pos = 2) as labels_name_2
from r where pos <= 2 group by user_id
""")
def top2_labels(spark, d):
    return ranking.top_items(table(spark, d, "events"), "user_id", "event_type", 2, ["labels_name_1", "labels_name_2"])


@query("top_n_per_group", """
select o_orderpriority, o_orderkey, o_totalprice, cast(rk as int) as ranking
from (select *, row_number() over (partition by o_orderpriority order by o_totalprice desc, o_orderkey) as rk from orders)
where rk <= 50
""")
def top_n_per_group(spark, d):
    orders = table(spark, d, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return ranking.top_n(orders, ["o_orderpriority"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 50, "ranking")


@query("top_n_large", """
select o_orderstatus, o_orderkey, o_totalprice, cast(rk as int) as ranking
from (select *, row_number() over (partition by o_orderstatus order by o_totalprice desc, o_orderkey) as rk from orders)
where rk <= 3000
""")
def top_n_large(spark, d):
    orders = table(spark, d, "orders").select("o_orderstatus", "o_orderkey", "o_totalprice")
    return ranking.top_n(orders, ["o_orderstatus"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3000, "ranking")


@query("top_n_overall", "select c_custkey, c_name, c_acctbal from customer order by c_acctbal desc, c_custkey limit 5")
def top_n_overall(spark, d):
    customer = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    return ranking.top_n_overall(customer, [F.desc("c_acctbal"), F.asc("c_custkey")], 5)


@query("reviews_newest_n", """
select user_id, event_id, ts, value
from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rk from events) where rk <= 20
""")
def reviews_newest_n(spark, d):
    events = table(spark, d, "events").select("user_id", "event_id", "ts", "value")
    return collect.newest_reviews(events, "user_id", "ts", "event_id", NEWEST_REVIEWS["ably"])


@query("latest_value", """
select user_id, event_type, case when value > 10 then value else 0.0 end as latest
from (select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as rk from events) where rk = 1
""")
def latest_value(spark, d):
    return ranking.latest_value(
        table(spark, d, "events").withColumn("v", F.when(F.col("value") > 10, F.col("value"))),
        ["user_id", "event_type"], "v", ["ts", "event_id"], 0.0,
    )


@query("merge_last_wins", """
select user_id, event_type, event_id, ts, value, props
from (select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as rk from events) where rk = 1
""")
def merge_last_wins(spark, d):
    return ranking.last_wins(table(spark, d, "events"), ["user_id", "event_type"], ["ts", "event_id"])


@query("top5_keywords", """
with p as (select event_type as gender, 'user ' || user_id as keyword_name, cast(ts as date) as period, value as ratio from events),
last_day as (select gender, keyword_name, max(period) as period from p
             where period between date '2024-01-15' - 7 and date '2024-01-15' group by all),
l as (select k.gender, k.keyword_name, coalesce(max(p.ratio), 0.0) as last_ratio
      from (select distinct gender, keyword_name from p) k
      left join last_day using (gender, keyword_name)
      left join p on p.gender = k.gender and p.keyword_name = k.keyword_name and p.period = last_day.period
      group by all)
select gender, keyword_name, last_ratio, cast(rk as int) as position
from (select *, row_number() over (partition by gender order by last_ratio desc, keyword_name) as rk from l) where rk <= 5
""")
def top5_keywords(spark, d):
    points = table(spark, d, "events").select(
        F.col("event_type").alias("gender"), F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("keyword_name"),
        F.col("ts").cast("date").alias("period"), F.col("value").alias("ratio"),
    )
    return trend.top_keywords(points, "2024-01-15")


@query("top5_keywords_rescaled", """
with v as (select event_type as gender, user_id % 24 as k, cast(ts as date) as period, sum(value) as value from events group by all),
s as (select gender, case when k < 12 then 'request 0' else 'request 3' end as "group", 'word ' || k as keyword_name, period, value,
        max(value) over (partition by gender, k < 12) as top from v where value > 0),
l as (select gender, "group", keyword_name, round(coalesce(arg_max(100 * value / top, period) filter (period between date '2024-01-15' - 7 and date '2024-01-15'), 0), 6) as last_ratio
      from s group by all)
select gender, "group", keyword_name, last_ratio, cast(rk as int) as position
from (select *, row_number() over (partition by gender, "group" order by last_ratio desc, keyword_name) as rk from l) where rk <= 5
""")
def top5_keywords_rescaled(spark, d):
    """Six requests, each scaled to its own maximum; neighbours share a keyword, except the third and the fourth."""
    true = table(spark, d, "events").groupBy(
        F.col("event_type").alias("gender"), (F.col("user_id") % 24).alias("k"), F.col("ts").cast("date").alias("period"),
    ).agg(F.sum("value").alias("value")).where("value > 0")
    own = F.floor(F.col("k") / 4).cast("int")
    before = F.when((F.col("k") % 4 == 0) & ~F.col("k").isin(0, 12), own - 1)
    held = true.select("*", F.explode(F.array_compact(F.array(own, before))).alias("r"))
    largest = held.groupBy("gender", "r").agg(F.max("value").alias("largest"))
    points = held.join(largest, ["gender", "r"]).select(
        F.concat(F.lit("request "), F.col("r").cast("string")).alias("request"), "gender",
        F.concat(F.lit("word "), F.col("k").cast("string")).alias("keyword_name"), "period", (100 * F.col("value") / F.col("largest")).alias("ratio"))
    return trend.top_keywords_rescaled(points, "2024-01-15")


@query("lasting_ids", """
with n as (select event_type, nullif(user_id, 7) as user_id, min(case when ts < timestamp '2024-01-10' then 1 else 2 end) as day from events group by all),
o as (select *, row_number() over (partition by day order by md5('{"event_type":"' || event_type || '","user_id":' || coalesce(cast(user_id as varchar), 'null') || '}')) as pos,
        count(*) filter (day = 1) over () as first_day from n)
select event_type, user_id, cast(pos + case when day = 2 then first_day else 0 end as bigint) as trend_id, cast(day as int) as batch_no from o
""")
def lasting_ids(spark, d):
    """Ids of two days and of the first one again: keys that come later number above, none changes."""
    events = table(spark, d, "events").select("event_type", F.nullif(F.col("user_id"), F.lit(7)).alias("user_id"), "ts")
    name, root = f"hemline_ids_{uuid.uuid4().hex}", shared_dir(spark, "lasting_ids")
    first = events.where(F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz"))
    for day in (first, events, first):
        lasting.register_keys(day, ["event_type", "user_id"], name, root, "trend_id")
    return spark.table(name)


@query("surrogate_id", """
select event_type, user_id, cast(dense_rank() over (order by md5('{"event_type":"' || event_type || '","user_id":' || user_id || '}')) as bigint) as trend_id
from (select distinct event_type, user_id from events)
""")
def surrogate_id(spark, d):
    return ranking.stable_ids(table(spark, d, "events"), ["event_type", "user_id"], "trend_id")


@query("surrogate_id_joined", """
select event_id, event_type, user_id, cast(dense_rank() over (order by md5('{"event_type":"' || event_type || '","user_id":' || coalesce(cast(user_id as varchar), 'null') || '}')) as bigint) as trend_id
from (select event_id, event_type, nullif(user_id, 7) as user_id from events)
""")
def surrogate_id_joined(spark, d):
    events = table(spark, d, "events").select("event_id", "event_type", F.nullif(F.col("user_id"), F.lit(7)).alias("user_id"))
    return ranking.with_stable_id(events, ["event_type", "user_id"], "trend_id")


@query("group_to_list", """
with i as (select distinct p_brand, p_partkey from part),
p as (select *, row_number() over (partition by p_brand order by p_partkey) as pos from i)
select p_brand, cast((pos - 1) // 40 as int) as batch, string_agg(p_partkey, ',' order by p_partkey) as items
from p group by all
""")
def group_to_list(spark, d):
    lists = ranking.item_batches(table(spark, d, "part"), ["p_brand"], "p_partkey", 40)
    return lists.withColumn("items", F.array_join(F.transform("items", lambda x: x.cast("string")), ","))


@query("full_rank", """
select o_orderstatus, o_orderkey, row_number() over (partition by o_orderstatus order by o_totalprice desc, o_orderkey) as ranking from orders
""")
def full_rank(spark, d):
    orders = table(spark, d, "orders").select("o_orderstatus", "o_orderkey", "o_totalprice")
    ranked = ranking.full_rank(orders, ["o_orderstatus"], [F.desc("o_totalprice"), F.asc("o_orderkey")], "ranking")
    return ranked.drop("o_totalprice")


@query("top_n_brands", """
with q as (select l_suppkey, cast(year(l_shipdate) as int) as yr, sum(l_quantity) as qty from lineitem group by all)
select * from (select yr, l_suppkey, qty, cast(row_number() over (partition by yr order by qty desc, l_suppkey) as int) as ranking from q)
where ranking <= 100
""")
def top_n_brands(spark, d):
    """The 100 best suppliers of every year: a report with a limit."""
    yearly = table(spark, d, "lineitem").groupBy(F.year("l_shipdate").alias("yr"), "l_suppkey").agg(F.sum("l_quantity").alias("qty"))
    return ranking.top_n(yearly, ["yr"], [F.desc("qty"), F.asc("l_suppkey")], 100, "ranking")
