"""The five marts over the star schema and the events."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from hemline.catalog.registry import query, table
from hemline.contracts import PRODUCT_DETAIL, RANKING
from hemline.functions.casts import null_to_zero
from hemline.operators.grouping import left_join_using
from hemline.operators.lookup import is_small
from hemline.operators.ranking import full_rank, top_items
from hemline.plans import marts
from hemline.plans.category import master_category


def listed_products(spark, d):
    """Sold products per platform (region) and category: flag, type and brand.

    The supplier side is broadcast only while suppliers are few. Lines are aggregated per
    region, part and flag before the part's attributes are joined, so that join handles
    one row per listed product. Keys are present, as both tables built from this require:
    with the same rows kept for both, their plans share the aggregate.
    """
    supplier = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    region = (
        supplier.join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", "r_name")
    )
    region = F.broadcast(region) if is_small(supplier) else region
    sold = (
        table(spark, d, "lineitem").join(region, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("r_name", "l_returnflag", "l_partkey")
        .agg(F.sum("l_quantity").alias("qty"), F.count(F.lit(1)).alias("n_lines"))
    )
    return sold.join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("r_name").alias("platform"),
        F.concat_ws("-", "l_returnflag", "p_type", "p_brand").alias("master_category_name"),
        F.col("p_partkey").alias("product_id"),
        "qty", "n_lines", "p_name", "p_brand", "p_size", "p_retailprice",
    ).where(F.col("platform").isNotNull() & F.col("product_id").isNotNull())


def ranking_and_detail(spark, d):
    """The sold products of every category ranked, and the details of products above size 5.

    Both need the same aggregate, so its shuffle is done once and reused.
    """
    listed = listed_products(spark, d)
    keys = ["platform", "master_category_name"]
    ranked = full_rank(listed, keys, [F.desc("qty"), F.desc("n_lines"), F.asc("product_id")], "ranking")
    ranking = RANKING.conform(ranked, {"created_at": F.lit("2025-01-02")})
    detail = PRODUCT_DETAIL.conform(listed.where("p_size > 5"), {
        "small_category_name": F.col("p_size").cast("string"),
        "img_url": F.concat(F.lit("/img/"), "p_name"), "product_name": "p_name", "brand_name_kr": "p_brand",
        "brand_name_en": F.lit(""), "original_price": "p_retailprice", "final_price": "qty", "discount_ratio": "p_size",
        "review_counting": "n_lines", "review_avg_rating": F.col("qty") / F.col("n_lines"),
        "like_counting": "n_lines", "created_at": F.lit("2025-01-02"),
    })
    return ranking, detail


_PRODUCT_SQL = """
with l as (select r_name as platform, concat_ws('-', l_returnflag, p_type, p_brand) as category, p_partkey, p_name, p_brand, p_size,
                  p_retailprice, sum(l_quantity) as qty, count(*) as n_lines
           from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
                join region on n_regionkey = r_regionkey join part on l_partkey = p_partkey group by all),
r as (select platform, category, p_partkey,
             row_number() over (partition by platform, category order by qty desc, n_lines desc, p_partkey) as rk from l),
p as (select * from l where p_size > 5)
select r.platform, split_part(p.category, '-', 1) as cat_depth_1, split_part(p.category, '-', 2) as cat_depth_2,
       split_part(p.category, '-', 3) as cat_depth_3, cast(p.p_size as varchar) as small_category_name,
       r.p_partkey as product_id, p.p_name as product_name, cast(r.rk as int) as ranking,
       '/img/' || p.p_name as img_url, p.p_brand as brand_name_kr, cast(trunc(p.p_retailprice) as int) as original_price,
       cast(p.qty as int) as final_price, p.p_size as discount_ratio, cast(p.n_lines as int) as review_counting,
       p.qty / p.n_lines as review_avg_rating, cast(p.n_lines as int) as like_counting, date '2025-01-02' as created_at
"""


@query("mart_product_left", _PRODUCT_SQL + """
from r left join p on r.p_partkey = p.p_partkey and r.platform = p.platform and r.category = p.category
""")
def mart_product_left(spark, d):
    ranking, detail = ranking_and_detail(spark, d)
    return marts.total_product(ranking, master_category([ranking]), detail)


@query("mart_product_inner", _PRODUCT_SQL + """
from r join p on r.p_partkey = p.p_partkey and r.platform = p.platform
""")
def mart_product_inner(spark, d):
    ranking, detail = ranking_and_detail(spark, d)
    return marts.product_ranking_detail(ranking, detail)


@query("mart_trend", """
select event_type as keyword_name, max(value) as ratio, strftime(cast(ts as date), '%m-%d') as period,
       date '2025-01-02' as created_at
from events group by event_type, cast(ts as date)
""")
def mart_trend(spark, d):
    trend = table(spark, d, "events").groupBy(
        F.col("event_type").alias("keyword_name"), F.col("ts").cast("date").alias("period")
    ).agg(F.max("value").alias("ratio"))
    return marts.keyword_trend(trend.withColumn("created_at", F.lit("2025-01-02").cast("date")))


@query("mart_brand", """
with q as (select l_suppkey, year(l_shipdate) as yr, sum(l_quantity) as qty, count(*) as n_lines from lineitem group by all),
r as (select *, row_number() over (partition by yr order by qty desc, l_suppkey) as rk from q),
t as (select l_suppkey, p_type, count(*) as n from lineitem join part on l_partkey = p_partkey group by all),
w as (select l_suppkey, string_agg(p_type, ', ' order by n desc, p_type) as labels
      from (select *, row_number() over (partition by l_suppkey order by n desc, p_type) as pos from t) where pos <= 2 group by all)
select s_name as brand_name, cast(c.rk as int) as curr_rank, cast(c.rk - coalesce(b.rk, 0) as int) as prev_diff_rank,
       cast(c.n_lines as int) as follower_count, w.labels, make_date(c.yr, 1, 1) as created_at, '/img/' || s_name as img_url
from r c join supplier on c.l_suppkey = s_suppkey left join r b on b.l_suppkey = c.l_suppkey and b.yr = c.yr - 1
     left join w on w.l_suppkey = c.l_suppkey
""")
def mart_brand(spark, d):
    """Suppliers as brands: their rank of every year, movement against the year before."""
    lineitem = table(spark, d, "lineitem")
    yearly = lineitem.groupBy("l_suppkey", F.year("l_shipdate").alias("yr")).agg(
        F.sum("l_quantity").alias("qty"), F.count(F.lit(1)).cast("int").alias("follower_count")
    )
    ranks = full_rank(yearly, ["yr"], [F.desc("qty"), F.asc("l_suppkey")], "rank").withColumn("rank", F.col("rank").cast("int"))
    # The year before is the row before, when there is one: no second pass over the lines.
    by_year = Window.partitionBy("l_suppkey").orderBy("yr")
    before = F.when(F.lag("yr").over(by_year) == F.col("yr") - 1, F.lag("rank").over(by_year))
    ranks = ranks.withColumn("previous_rank", null_to_zero(before))
    # counted per supplier and part before the part's type is joined
    parts = lineitem.groupBy("l_suppkey", "l_partkey").agg(F.count(F.lit(1)).alias("n"))
    kinds = parts.join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).select("l_suppkey", "p_type", "n")
    labels = top_items(kinds, "l_suppkey", "p_type", 2, ["labels_name_1", "labels_name_2"], times="n")
    names = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("brand_name"))
    brands = left_join_using(ranks, labels, "l_suppkey").join(names, "l_suppkey")
    return marts.snap_brand_ranking(brands.withColumns({
        "created_at": F.make_date("yr", F.lit(1), F.lit(1)),
        "img_url": F.concat(F.lit("/img/"), "brand_name"),
    }))


@query("mart_weather", """
select n_name as "지역명", cast(o_orderdate as date) as "측정시간",
       cast(round(cast(o_totalprice as decimal(18,2)), 1) as double) as "평균온도",
       cast(round(cast(c_acctbal as decimal(18,2)), 1) as double) as "최고온도",
       cast(round(cast(-c_acctbal as decimal(18,2)), 1) as double) as "최저온도",
       cast(c_custkey as double) as "일강수량"
from orders join customer on o_custkey = c_custkey join nation on n_nationkey = c_nationkey
""")
def mart_weather(spark, d):
    """Orders as observations of the customer's nation."""
    daily = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderdate").cast("date").alias("TM"), F.col("c_nationkey").alias("STN"),
        F.col("o_totalprice").alias("TA_AVG"), F.col("c_acctbal").alias("TA_MAX"),
        (-F.col("c_acctbal")).alias("TA_MIN"), F.col("c_custkey").alias("RN_DAY"),
    )
    stations = table(spark, d, "nation").select(F.col("n_nationkey").alias("STN_ID"), F.col("n_name").alias("STN_KO"))
    return marts.weather(daily, stations)
