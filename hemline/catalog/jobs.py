"""The bronze -> silver jobs on payloads that Spark derives row by row from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hemline.catalog.nested import line_words
from hemline.catalog.projections import TITLE_SQL
from hemline.catalog.registry import query, table, texts
from hemline.operators.nested import components_of_kind
from hemline.plans import category, collect, product, ranking, review, snap, trend, video, weather
from hemline.sources.readers import SOURCE_PATH

RUN_DATE = "2025-01-02"


def _text(c):
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _joined(*parts):
    return F.concat(*[F.lit(p[1:]) if p.startswith("'") else _text(p) for p in parts])


def _ably_listing(spark, d):
    raw = texts(spark, d, "part").select(
        F.struct(
            F.when(F.col("p_size") != 7, F.struct(F.col("p_partkey").alias("goods_sno"))).alias("like"),
            _joined("'img/", "p_partkey").alias("image"), F.col("p_size").alias("ranking"),
            F.struct((F.col("p_size") * 100).alias("original_price")).alias("first_page_rendering"),
        ).alias("item"),
        F.struct(F.struct(
            F.col("p_name").alias("GOODS_NAME"), F.col("p_brand").alias("MARKET_NAME"),
            F.col("p_retailprice").cast("int").alias("SALES_PRICE"), F.col("p_size").alias("DISCOUNT_RATE"),
            (F.col("p_size") + 1).alias("REVIEW_COUNT"), (F.col("p_size") / 4).alias("REVIEW_RATING"),
            (F.col("p_size") * 2).alias("LIKES_COUNT"),
        ).alias("analytics")).alias("logging"),
        _joined("'file:/zone/bronze/2025-01-02/ably/ranking_data/8/8_", "p_size", "'.json").alias(SOURCE_PATH),
    )
    dim = table(spark, d, "nation").select(
        _joined("'8_", "n_nationkey").alias("code"), _joined("'여성-상의-", "n_name").alias("master_category_name"),
        F.col("n_name").alias("small_category_name"),
    )
    return product.ably_listing(raw, dim)


@query("ably_product_detail", """
select 'ably' as platform, coalesce('여성-상의-' || n_name, 'Unknown') as master_category_name,
       coalesce(n_name, 'Unknown') as small_category_name,
       case when p_size <> 7 then cast(p_partkey as bigint) end as product_id, 'img/' || p_partkey as img_url,
       p_name as product_name, p_brand as brand_name_kr, '' as brand_name_en, p_size * 100 as original_price,
       cast(trunc(p_retailprice) as int) as final_price, p_size as discount_ratio, p_size + 1 as review_counting,
       p_size / 4 as review_avg_rating, p_size * 2 as like_counting, date '2025-01-02' as created_at
from part left join nation on n_nationkey = p_size
""")
def ably_product_detail(spark, d):
    return product.ably_product_detail(_ably_listing(spark, d), RUN_DATE)


@query("ably_ranking", """
select 'ably' as platform, coalesce('여성-상의-' || n_name, 'Unknown') as master_category_name,
       case when p_size <> 7 then cast(p_partkey as bigint) end as product_id, p_size as ranking, date '2025-01-02' as created_at
from part left join nation on n_nationkey = p_size
""")
def ably_ranking(spark, d):
    return ranking.ably_ranking(_ably_listing(spark, d), RUN_DATE)


def _cm29_listing(spark, d):
    folder = F.when(F.col("p_size") < 20, "Man").when(F.col("p_size") == 25, "Kids").otherwise("Woman")
    raw = texts(spark, d, "part").select(
        _text("p_size").alias("ranking"), _text("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("brand_name_kr"), F.upper("p_brand").alias("brand_name_en"),
        _text("p_retailprice").alias("original_price"), F.lit("n/a").alias("final_price"),
        _text("p_size").alias("discount_ratio"), _text("p_size").alias("review_counting"),
        _text(F.col("p_size") / 4).alias("review_avg_rating"), _text("p_size").alias("like_counting"),
        F.lit("29CM").alias("platform"), F.lit(RUN_DATE).alias("created_at"),
        _joined("'https://img/", "p_partkey").alias("img_url"),
        F.concat(F.lit("s3a://zone/29cm_product/"), folder, F.lit("/Top/k"), _text("p_size"), F.lit(".json")).alias(SOURCE_PATH),
    )
    dim = table(spark, d, "nation").select(
        _joined("'k", "n_nationkey").alias("file_key"), F.col("n_name").alias("depth2"),
        _joined("'r", "n_regionkey").alias("depth3"), _joined("n_name", "'/4").alias("depth4"),
    )
    return product.cm29_listing(raw, dim)


_CM29 = """
with l as (select *, case when p_size < 20 then '남성' when p_size = 25 then null else '여성' end as gender,
                  'k' || p_size as file_key, 'r' || n_regionkey as depth3, n_name || '/4' as depth4
           from part left join nation on n_nationkey = p_size),
m as (select *, concat_ws('-', gender, n_name, depth3) as category from l)
"""


@query("cm29_product_detail", _CM29 + """
select '29CM' as platform, category as master_category_name, depth4 as small_category_name, cast(p_partkey as bigint) as product_id,
       'https://img/' || p_partkey as img_url, p_name as product_name, p_brand as brand_name_kr, upper(p_brand) as brand_name_en,
       cast(trunc(p_retailprice) as int) as original_price, cast(null as int) as final_price, p_size as discount_ratio,
       p_size as review_counting, p_size / 4 as review_avg_rating, p_size as like_counting, date '2025-01-02' as created_at
from m
""")
def cm29_product_detail(spark, d):
    return product.cm29_product_detail(_cm29_listing(spark, d))


@query("cm29_ranking", _CM29 + """
select '29CM' as platform, category as master_category_name, cast(p_partkey as bigint) as product_id, p_size as ranking,
       date '2025-01-02' as created_at
from m
""")
def cm29_ranking(spark, d):
    return ranking.cm29_ranking(_cm29_listing(spark, d))


@query("cm29_master_category", _CM29 + """
select distinct category as master_category_name, gender as cat_depth_1, n_name as cat_depth_2, depth3 as cat_depth_3 from m
where category is not null
""")
def cm29_master_category(spark, d):
    return category.cm29_master_category(_cm29_listing(spark, d))


@query("cm29_sub_category", _CM29 + """
select distinct file_key as sub_category_id, '29CM' as platform, category as master_category_id, depth4 as cat_depth_4,
       date '2025-01-02' as created_at
from m
""")
def cm29_sub_category(spark, d):
    return category.cm29_sub_category(_cm29_listing(spark, d))


@query("master_category_all", _CM29 + """
, names as (select category as c from m union
            select coalesce('여성-상의-' || n_name, 'Unknown') from part left join nation on n_nationkey = p_size)
select c as master_category_name, split_part(c, '-', 1) as cat_depth_1, split_part(c, '-', 2) as cat_depth_2,
       split_part(c, '-', 3) as cat_depth_3
from names
""")
def master_category_all(spark, d):
    return category.master_category([
        ranking.cm29_ranking(_cm29_listing(spark, d)), ranking.ably_ranking(_ably_listing(spark, d), RUN_DATE)
    ])


@query("musinsa_product_detail", """
select case when ok then 'musinsa' end as platform, case when ok then 'a-b-' || p_type end as master_category_name,
       case when ok then p_type end as small_category_name, case when ok then cast(p_partkey as bigint) end as product_id,
       case when ok then '/img/' || p_partkey end as img_url, case when ok then p_name end as product_name,
       case when ok then p_brand end as brand_name_kr, cast(null as varchar) as brand_name_en,
       case when ok then cast(trunc(p_retailprice) as int) end as original_price, case when ok then p_size end as final_price,
       cast(null as int) as discount_ratio, case when ok then p_size end as review_counting,
       case when ok then p_size / 4 end as review_avg_rating, case when ok then p_size end as like_counting,
       case when ok then date '2025-01-02' end as created_at
from (select *, p_size <> 13 as ok from part)
""")
def musinsa_product_detail(spark, d):
    record = F.to_json(F.struct(
        F.lit("musinsa").alias("platform"), _joined("'a-b-", "p_type").alias("master_category_name"),
        F.col("p_type").alias("small_category_name"), _text("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"), F.col("p_brand").alias("brand_name_kr"),
        _text("p_retailprice").alias("original_price"), _text("p_size").alias("final_price"),
        F.lit("").alias("discount_rate"), _text("p_size").alias("review_count"),
        _text(F.col("p_size") / 4).alias("review_avg_rating"), F.col("p_size").alias("like_counting"),
        _joined("'/img/", "p_partkey").alias("image_src"), F.lit(RUN_DATE).alias("created_at"),
    ))
    broken = F.when(F.col("p_size") == 13, F.concat(F.lit("<html>"), record)).otherwise(record)
    return product.musinsa_product_detail(texts(spark, d, "part").select(broken.alias("value")))


@query("musinsa_ranking", """
select 'musinsa' as platform, '여성-상의-' || lang as master_category_name, cast(length(word) as bigint) as product_id,
       cast(pos as int) as ranking, date '2025-01-02' as created_at
from (select lang, unnest(string_split(line, ' ')) as word, generate_subscripts(string_split(line, ' '), 1) as pos
      from (select lang, unnest(string_split(text, chr(10))[2:18]) as line from documents) where contains(line, ','))
where not contains(word, '.')
""")
def musinsa_ranking(spark, d):
    return ranking.musinsa_ranking(_ranking_documents(spark, d), RUN_DATE)


@query("modules_outside", """
with m as (select unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as i from documents)
select cast(count(*) as bigint) as modules,
       cast(coalesce(sum(case when contains(line, ',') then len(string_split(line, ' ')) else 0 end), 0) as bigint) as items
from m where i not between 1 and 17
""")
def modules_outside(spark, d):
    """What the ranking leaves out by position."""
    return ranking.modules_outside(_ranking_documents(spark, d))


def _ranking_documents(spark, d):
    def item(word, i):
        index = F.when(~F.contains(word, F.lit(".")), _text(i + 1))
        payload = F.struct(F.struct(F.struct(F.struct(F.struct(index.alias("index")).alias("payload")).alias("ga4")).alias("eventLog")).alias("onClickBrandName"))
        return F.struct(_text(F.length(word)).alias("id"), payload.alias("info"))

    modules = F.transform(F.split("text", "\n"), lambda x: F.struct(
        F.when(F.contains(x, F.lit(",")), F.transform(F.split(x, " "), item)).alias("items")))
    return texts(spark, d, "documents").select(
        F.struct(modules.alias("modules")).alias("data"),
        F.concat(F.lit("s3a://zone/ranking_data/x/여성_상의_"), "lang", F.lit("_"), "source", F.lit(".json")).alias(SOURCE_PATH),
    )


@query("ably_reviews", """
select cast(user_id as bigint) as product_id, props as review_content, cast(trunc(value) as int) as review_rating,
       cast(ts as date) as review_date, cast(nullif(user_id, 7) as double) as reviewer_height, cast(null as double) as reviewer_weight,
       event_type || ', ' || user_id as selected_options, date '2025-01-02' as created_at
from events
""")
def ably_reviews(spark, d):
    raw = texts(spark, d, "events").select(
        _text("user_id").alias("goods_sno"), F.col("props").alias("contents"), _text("value").alias("eval"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
        F.nullif(_text("user_id"), F.lit("7")).alias("height"), F.lit("private").alias("weight"),
        F.array("event_type", F.lit(None).cast("string"), _text("user_id")).alias("goods_option"),
    )
    return review.ably_reviews(raw, RUN_DATE)


@query("cm29_reviews", """
select cast(user_id as bigint) as product_id, props as review_content, cast(trunc(value) as int) as review_rating,
       cast(ts as date) as review_date, cast(user_id as double) as reviewer_height,
       case when event_type = 'click' then value end as reviewer_weight, nullif(event_type, 'view') as selected_options,
       date '2025-01-02' as created_at
from events
""")
def cm29_reviews(spark, d):
    height, weight = _joined("user_id", "'cm"), _joined("value", "'kg")
    raw = texts(spark, d, "events").select(
        _text("user_id").alias("product_id"), F.col("props").alias("contents"), _text("value").alias("point"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("insertTimestamp"),
        F.when(F.col("event_type") == "click", F.array(height, weight)).otherwise(F.array(height)).alias("userSize"),
        F.when(F.col("event_type") != "view", F.array("event_type", F.lit("second"))).alias("optionValue"),
        F.lit(RUN_DATE).alias("created_at"),
    )
    return review.cm29_reviews(raw)


@query("musinsa_reviews", """
select distinct cast(user_id as bigint) as product_id, event_type as review_content, cast(trunc(value) as int) as review_rating,
       cast(ts + interval 9 hour as date) as review_date, cast(user_id as double) as reviewer_height,
       cast(case when event_type = 'click' then 60 end as double) as reviewer_weight, 'M' as selected_options,
       date '2025-01-02' as created_at
from events
""")
def musinsa_reviews(spark, d):
    one = F.struct(
        F.struct(F.col("user_id").alias("goodsNo")).alias("goods"), F.col("event_type").alias("content"),
        _text("value").alias("grade"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+00:00")).alias("createDate"),
        F.struct(F.col("user_id").alias("userHeight"), F.when(F.col("event_type") == "click", 60).alias("userWeight")).alias("userProfileInfo"),
        F.lit("M").alias("goodsOption"),
    )
    docs = texts(spark, d, "events").select(F.array(one, one).alias("list"))
    return review.musinsa_reviews(docs, RUN_DATE)


@query("snap_brand_ranking", """
with w as (select doc_id, unnest(string_split(line, ' ')) as word
           from (select doc_id, unnest(string_split(text, chr(10))) as line from documents)),
c as (select doc_id, word, count(*) as n from w group by all),
r as (select *, row_number() over (partition by doc_id order by n desc, word) as pos from c)
select cast(doc_id as varchar) as brand_id, lang as brand_name, '/img/' || doc_id as img_url, cast(n_chars as int) as rank,
       cast(coalesce(nullif(n_chars, 416), 0) as int) as previous_rank, cast(n_chars as int) as follower_count,
       max(word) filter (pos = 1) as labels_name_1, max(word) filter (pos = 2) as labels_name_2, date '2025-01-02' as created_at
from documents left join (select * from r where pos <= 2) using (doc_id) group by all
""")
def snap_brand_ranking(spark, d):
    brand = F.struct(
        _text("doc_id").alias("id"), F.col("lang").alias("nickname"), _joined("'/img/", "doc_id").alias("profileImageUrl"),
        F.struct(F.col("n_chars").alias("rank"), F.nullif(F.col("n_chars"), F.lit(416)).alias("previousRank")).alias("ranking"),
        F.col("n_chars").alias("followerCount"), line_words("labels").alias("snaps"),
    )
    pages = texts(spark, d, "documents").select(F.struct(F.array(brand).alias("list")).alias("data"))
    return snap.brand_ranking(pages, RUN_DATE)


@query("snap_story_ranking", """
select conv_id * 1000 + turn as story_id, role as content_type, cast(length(text) as int) as aggregation_like_count,
       replace(text, ' ', ',') as tags, date '2025-01-02' as created_at, '여성' as gender
from conversations
""")
def snap_story_ranking(spark, d):
    story = F.struct(
        _text(F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("role").alias("contentType"),
        F.struct(F.length("text").alias("likeCount")).alias("aggregations"),
        F.transform(F.split("text", " "), lambda w: F.struct(w.alias("name"))).alias("tags"),
    )
    pages = texts(spark, d, "conversations").select(F.struct(F.array(story).alias("list")).alias("data"))
    return snap.story_ranking(pages, "WOMEN", RUN_DATE)


@query("keyword_trend", """
select cast(dense_rank() over (order by md5('{"start_date":"' || cast(ts as date) || '","end_date":"' || cast(ts as date)
         || '","time_unit":"date","gender":"남성","keyword_name":"' || event_type || '"}')) as bigint) as trend_id,
       cast(ts as date) as start_date, cast(ts as date) as end_date, 'date' as time_unit, '패션의류' as category_name,
       50000000 as category_code, event_type as keyword_name, '남성' as gender, cast(ts as date) + cast(k as int) as period,
       value as ratio, date '2025-01-02' as created_at
from events, range(2) t(k)
""")
def keyword_trend(spark, d):
    day = F.col("ts").cast("date")
    point = [F.struct(F.date_add(day, k).alias("period"), F.col("value").alias("ratio")) for k in (0, 1)]
    result = F.struct(F.concat("event_type", F.lit("_trend")).alias("title"), F.array("event_type").alias("keyword"), F.array(*point).alias("data"))
    docs = texts(spark, d, "events").select(
        day.alias("startDate"), day.alias("endDate"), F.lit("date").alias("timeUnit"), F.array(result).alias("results")
    )
    return trend.keyword_trend(docs, "male", RUN_DATE)


@query("weather_daily", """
select case when l_linenumber <> 4 then cast(l_shipdate as date) end as "TM", cast(l_suppkey as int) as "STN", l_quantity as "WS_AVG",
       l_tax as "WS_MAX", l_extendedprice as "TA_AVG", 0.0::double as "TA_MAX", -l_quantity as "TA_MIN", 0.0::double as "HM_AVG",
       0.0::double as "HM_MIN", 0.0::double as "FG_DUR", 0.0::double as "CA_TOT", l_discount as "RN_DAY", 0.0::double as "RN_DUR",
       0.0::double as "RN_60M_MAX", case when l_linenumber = 3 then 0.0 else l_quantity end as "RN_POW_MAX"
from lineitem
""")
def weather_daily(spark, d):
    filled = {
        0: F.when(F.col("l_linenumber") == 4, "2024").otherwise(F.date_format("l_shipdate", "yyyyMMdd")), 1: _text("l_suppkey"),
        2: _text("l_quantity"), 5: _text("l_tax"), 10: _text("l_extendedprice"), 11: F.lit("bad"),
        13: _text(-F.col("l_quantity")), 18: F.lit("  "), 38: _text("l_discount"), 46: _text("l_quantity"),
    }
    full = F.array(*[filled.get(i, F.lit("")) for i in range(47)])
    # Records of line 3 are too short to hold the last field.
    record = F.array_join(F.when(F.col("l_linenumber") == 3, F.slice(full, 1, 40)).otherwise(full), ",")
    lines = texts(spark, d, "lineitem").select(
        F.explode(F.when(F.col("l_linenumber") == 1, F.array(F.lit("#START7777"), F.lit(""), record)).otherwise(F.array(record))).alias("value")
    )
    return weather.weather_daily(lines)


@query("weather_stations", """
select cast(c_custkey as int) as "STN_ID", case when c_nationkey <> 5 then string_split(c_name, '#')[2] end as "STN_KO" from customer
""")
def weather_stations(spark, d):
    name = F.when(F.col("c_nationkey") != 5, F.element_at(F.split("c_name", "#"), 2)).otherwise("")
    record = F.concat(F.lit("  "), _text("c_custkey"), F.lit("  1 2.5 3 4 5 6 7 8   9 "), name)
    lines = table(spark, d, "customer").select(F.explode(F.array(F.lit("# STN LON"), record, F.lit("#7777END"))).alias("value"))
    return weather.weather_stations(lines)


@query("videos", """
select 'v' || event_id as video_id, cast(null as varchar) as gender, event_type as category_name, 'channel ' || user_id as channel_title,
       props as title, '/img/' || event_id as img_url, cast(user_id as int) as duration_seconds,
       date_trunc('second', ts) as published_at, cast(trunc(value) as int) as view_count, cast(null as int) as like_count,
       date '2025-01-02' as created_at
from events
""")
def videos(spark, d):
    raw = texts(spark, d, "events").select(
        _joined("'v", "event_id").alias("videoId"), F.col("event_type").alias("category_name"), F.col("props").alias("title"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"), _joined("'channel ", "user_id").alias("channelName"),
        _joined("'/img/", "event_id").alias("thumbnailUrl"), _text("user_id").alias("duration"),
        _text("value").alias("viewCount"), F.lit("hidden").alias("likeCount"),
    )
    return video.videos(raw, None, RUN_DATE)


@query("video_select", """
with s as (select o_orderkey, cast(k as int) as k, cast((o_orderkey * 37 + k * 611) % 2400 as int) as duration
           from orders, range(6) t(k)),
f as (select *, row_number() over (partition by o_orderkey order by k) as pos from s where duration between 120 and 1800)
select 'order ' || o_orderkey as category_name, o_orderkey || '-' || k as "videoId", duration,
       case when k in (0, 2, 4) then '0' else cast(k as varchar) end as "viewCount"
from f where pos <= 3
""")
def video_select(spark, d):
    def found(k):
        seconds = F.pmod(F.col("o_orderkey") * 37 + k * 611, F.lit(2400))
        length = F.concat(F.lit("PT"), _text(F.floor(seconds / 60)), F.lit("M"), _text(seconds % 60), F.lit("S"))
        none = F.lit(None).cast("string")
        return F.struct(
            F.concat(_text("o_orderkey"), F.lit("-"), _text(k)).alias("id"),
            F.struct(
                none.alias("title"), none.alias("publishedAt"), none.alias("description"), none.alias("channelTitle"),
                F.struct(F.struct(none.alias("url")).alias("high")).alias("thumbnails"),
                F.lit(None).cast("array<string>").alias("tags"), none.alias("categoryId"),
            ).alias("snippet"),
            F.struct(length.alias("duration"), none.alias("dimension"), none.alias("definition")).alias("contentDetails"),
            F.struct(F.when(~k.isin(0, 2, 4), _text(k)).alias("viewCount"), none.alias("likeCount"), none.alias("commentCount")).alias("statistics"),
        )

    searches = texts(spark, d, "orders").select(
        _joined("'order ", "o_orderkey").alias("category_name"), F.transform(F.sequence(F.lit(0), F.lit(5)), found).alias("items")
    )
    return video.select_videos(searches).select("category_name", "videoId", "duration", "viewCount")


@query("listing_products", """
select p_partkey as listing, cast(k + 1 as int) as ranking, p_partkey * 10 + k as product_id, p_name as product_name,
       p_size as original_price, case when k = 0 then 'M/W' when k = 1 then 'W' end as gender,
       case when k = 0 then p_brand || '|' || p_type when k = 1 then p_type else '' end as medium_names,
       case when k = 2 then '' else p_name end as small_names, '29CM' as platform, '2025-01-02' as created_at,
       case when k = 1 then null else 'https://img.29cm.co.kr/' || p_partkey end as img_url, k = 0 as soldout_status
from part, range(3) t(k) where p_size <> 9
""")
def listing_products(spark, d):
    def category_info(large, medium, small):
        return F.struct(large.alias("categoryLargeName"), medium.alias("categoryMediumName"), small.alias("categorySmallName"))

    man, woman, name = F.lit("남성의류"), F.lit("여성의류"), F.col("p_name")
    infos = [
        F.array(category_info(man, F.col("p_type"), name), category_info(woman, F.col("p_brand"), F.lit("상의")),
                category_info(woman, F.col("p_brand"), name)),
        F.array(category_info(woman, F.lit("EXCLUSIVE"), name), category_info(woman, F.col("p_type"), F.lit(""))),
        F.lit(None).cast("array<struct<categoryLargeName:string,categoryMediumName:string,categorySmallName:string>>"),
    ]
    products = [F.struct(
        infos[k].alias("frontCategoryInfo"),
        (F.lit(None).cast("string") if k == 1 else _joined("'/", "p_partkey")).alias("imageUrl"),
        (F.col("p_partkey") * 10 + k).alias("itemNo"), name.alias("itemName"), F.lit(1).alias("frontBrandNo"),
        F.col("p_brand").alias("frontBrandNameKor"), F.col("p_brand").alias("frontBrandNameEng"),
        F.col("p_size").alias("consumerPrice"), F.lit(0).alias("lastSalePrice"), F.lit(0).alias("lastSalePercent"),
        F.lit(0).alias("reviewCount"), F.lit(0.0).alias("reviewAveragePoint"), F.lit(0).alias("heartCount"),
        F.lit(k == 0).alias("isSoldOut"), F.lit(False).alias("isNew"),
    ) for k in range(3)]
    listings = texts(spark, d, "part").select(
        F.col("p_partkey").alias("listing"),
        F.struct(F.when(F.col("p_size") != 9, F.array(*products)).otherwise(F.slice(F.array(*products), 1, 0)).alias("products")).alias("data"),
    )
    return collect.listing_products(listings, RUN_DATE, ["listing"]).select(
        "listing", "ranking", "product_id", "product_name", "original_price", "gender",
        F.array_join("categoryMediumNames", "|").alias("medium_names"), F.array_join("categorySmallNames", "|").alias("small_names"),
        "platform", "created_at", "img_url", "soldout_status",
    )


@query("page_products", f"select page_id, {TITLE_SQL} as product_name," + r"""
       case when starts_with(url, 'https') then 'slug' || page_id end as brand_name_en, 'brand''s 가 ' || page_id as brand_name_kr,
       cast(page_id * 100 as varchar) as original_price, case when contains(url, '.com') then cast(page_id as varchar) end as final_price,
       cast(null as varchar) as discount_rate, url as image_src, cast(page_id as varchar) as review_count,
       case when contains(url, '?') then cast(page_id as varchar) end as review_avg_rating
from pages
""")
def page_products(spark, d):
    # The product tags are added to the stored pages, attributes in either order.
    score = F.when(F.col("url").contains("?"), F.concat(F.lit(', "satisfactionScore": '), _text("page_id"))).otherwise("")
    head = F.concat(
        F.lit('<meta property="product:brand" content="brand\'s &#44032; '), _text("page_id"),
        F.lit('"/><meta content="'), _text(F.col("page_id") * 100), F.lit('" property="product:price:normal_price">'),
        F.when(F.col("url").contains(".com"), F.concat(F.lit('<meta property="product:price:amount" content="'), _text("page_id"), F.lit('">'))).otherwise(""),
        F.lit('<meta property="og:image" content="'), F.col("url"), F.lit('">'),
        F.lit('<script id="__NEXT_DATA__" type="application/json">{"props": {"pageProps": {"meta": {"data": {"goodsReview": {"totalCount": '),
        _text("page_id"), score, F.lit("}}}}}}</script></head>"),
    )
    link = F.when(F.col("url").startswith("https"), F.concat(F.lit('<body><a href="/brand/slug'), _text("page_id"), F.lit('">b</a>'))).otherwise("<body>")
    html = F.replace(F.replace("html", F.lit("</head>"), head), F.lit("<body>"), link)
    html = F.replace(html, F.lit("</title>"), F.lit(" - 사이즈 &amp; 후기 | shop</title>"))
    return collect.page_products(texts(spark, d, "pages").select("page_id", html.alias("html")), keep=["page_id"])


def _component_pages(spark, d):
    """Every document is a page of its source's listing; items carry a product id or lack it."""
    def line_items(x):
        items = F.transform(F.split(x, " "), lambda w: F.struct(F.struct(
            F.when(F.length(w) != 3, F.struct(F.nullif(F.length(w), F.lit(4)).cast("bigint").alias("goods_sno"))).alias("like"),
            w.alias("image"),
        ).alias("item")))
        return F.struct(
            F.when(F.contains(x, F.lit(",")), 9).otherwise(7).alias("component_id"), F.struct(items.alias("item_list")).alias("entity")
        )

    return texts(spark, d, "documents").select(
        "source", "doc_id", F.transform(F.split("text", "\n"), line_items).alias("components")
    )


_COMPONENT_ITEMS = """
with c as (select source, doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as cpos from documents),
i as (select source, doc_id, cpos, unnest(string_split(line, ' ')) as word, generate_subscripts(string_split(line, ' '), 1) as ipos
      from c where contains(line, ',')),
r as (select *, row_number() over (partition by source order by doc_id, cpos, ipos) as rk from i)
"""


def _category_trees(spark, d):
    """Every document is a tree: language, source, line number, words of the line."""
    lines = F.split("text", "\n")
    by_line = F.map_from_arrays(
        F.transform(lines, lambda x, i: _text(i)), F.transform(lines, lambda x: F.split(x, " "))
    )
    return texts(spark, d, "documents").select("doc_id", F.create_map("lang", F.create_map("source", by_line)).alias("tree"))


_CATEGORY_TREES = """
with w as (select *, row_number() over (partition by lang, source order by doc_id desc) as rk from documents),
l as (select lang, source, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as i
      from w where rk = 1),
t as (select lang as depth_1, source as depth_2, cast(i as varchar) as depth_3, unnest(string_split(line, ' ')) as depth_4 from l)
"""


@query("category_tuples", _CATEGORY_TREES + "select * from t")
def category_tuples(spark, d):
    return collect.category_tuples(_category_trees(spark, d), "tree", "doc_id")


@query("category_groups", _CATEGORY_TREES + """
, k as (select distinct * from t),
p as (select *, row_number() over (partition by depth_1, depth_2, depth_3 order by depth_4) as pos from k)
select depth_1, depth_2, depth_3, cast((pos - 1) // 8 as int) as batch, string_agg(depth_4, ' ' order by depth_4) as categories
from p group by all
""")
def category_groups(spark, d):
    groups = collect.category_groups(collect.category_tuples(_category_trees(spark, d), "tree", "doc_id"), 8)
    return groups.withColumn("categories", F.array_join("categories", " "))


@query("listing_items", _COMPONENT_ITEMS + "select source, cast(rk as int) as ranking, word from r where rk <= 50")
def listing_items(spark, d):
    items = collect.listing_items(_component_pages(spark, d), "source", "doc_id")
    return items.select("source", "ranking", F.col("item.item.image").alias("word"))


@query("product_work_list", _COMPONENT_ITEMS + """
, k as (select distinct source, cast(length(word) as bigint) as product_id from r
        where length(word) not in (0, 3, 4)),
p as (select *, row_number() over (partition by source order by product_id) as pos from k)
select source, cast((pos - 1) // 5 as int) as batch, string_agg(product_id, ',' order by product_id) as product_ids
from p group by all
""")
def product_work_list(spark, d):
    pages = _component_pages(spark, d)
    items = components_of_kind(pages, "components", 9, keep=["source"])
    lists = collect.product_work_list(items, "source", batch_size=5)
    return lists.withColumn("product_ids", F.array_join(F.transform("product_ids", lambda x: x.cast("string")), ","))
