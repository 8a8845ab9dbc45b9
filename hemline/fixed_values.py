# -*- coding: utf-8 -*-
"""Values that must equal those of the data sources for results to be right.

Everything below is a fixed value: tags, field positions, limits, patterns and
names found in the payloads. Category dimensions are not here, they are inputs.
"""

# Platform tags as they appear in the data.
PLATFORM_ABLY = "ably"
PLATFORM_MUSINSA = "musinsa"
PLATFORM_29CM = "29CM"

# Storage zones of a dated path.
ZONE_BRONZE = "bronze"
ZONE_SILVER = "silver"

# Database names of the loaded tables and of the marts.
SILVER_SCHEMA = "retail_silver_layer"
GOLD_SCHEMA = "retail_gold_layer"

# Gender words and codes.
GENDER_MALE = "남성"
GENDER_FEMALE = "여성"
GENDER_FOLDERS = {"Man": "남성", "Woman": "여성"}
GENDER_SYNONYMS = {
    "female": "여성",
    "male": "남성",
    "WOMEN": "여성",
    "MEN": "남성",
    "여성": "여성",
    "남성": "남성",
}

# Category naming.
CATEGORY_SEPARATOR = "-"
UNMAPPED_CATEGORY = "Unknown"
DEPTH2_NAMES = {"shoes": "신발", "outer": "아우터", "top": "상의", "bottom": "하의"}
DEPTH3_KEYS = {
    "전체": "shoes",
    "재킷": "jacket",
    "폴리스": "police",
    "코트": "coat",
    "패딩": "padding",
    "기타": "etcouter",
    "티셔츠": "tshirt",
    "셔츠": "shirt",
    "니트": "knit",
    "팬츠": "pants",
    "원피스": "onepiece",
    "스커트": "skirt",
}

# Listing payloads.
RANKED_MODULES_FROM = 1
RANKED_MODULES_TO = 17
ITEM_COMPONENT_ID = 9
LISTING_SIZE = 50
LARGE_CATEGORY_MALE = "남성의류"
LARGE_CATEGORY_FEMALE = "여성의류"
EXCLUDED_MEDIUM_CATEGORIES = ["EXCLUSIVE"]
EXCLUDED_SMALL_CATEGORIES = ["상의", "하의", "아우터"]
IMAGE_HOST_29CM = "https://img.29cm.co.kr"

# Reviews kept per product, by platform, and the size of a product-id batch.
NEWEST_REVIEWS = {"musinsa": 30, "ably": 20, "29CM": 10}
PRODUCT_BATCH_SIZE = 40

# Product pages.
PAGE_TITLE_SUFFIX = r" - 사이즈 & 후기.*"
BRAND_LINK_MARK = "brand/"
PAGE_META = {
    "brand_name_kr": "product:brand",
    "original_price": "product:price:normal_price",
    "final_price": "product:price:amount",
    "discount_rate": "product:price:sale_rate",
    "image_src": "og:image",
}

PAGE_JSON_ID = "__NEXT_DATA__"
PAGE_REVIEW_PATH = "$.props.pageProps.meta.data.goodsReview"

# Keyword trend.
TREND_CATEGORY_NAME = "패션의류"
TREND_CATEGORY_CODE = 50000000
TREND_TOP = 5
TREND_LOOKBACK_DAYS = 7

# Videos.
VIDEO_MIN_SECONDS = 120
VIDEO_MAX_SECONDS = 1800
VIDEOS_PER_CATEGORY = 3

# Weather text records: comment sign, block markers, field positions.
WEATHER_COMMENT = "#"
WEATHER_MARKERS = ["START7777", "7777END", "END7777"]
WEATHER_FIELDS = {
    "WS_AVG": 2,
    "WS_MAX": 5,
    "TA_AVG": 10,
    "TA_MAX": 11,
    "TA_MIN": 13,
    "HM_AVG": 18,
    "HM_MIN": 19,
    "FG_DUR": 24,
    "CA_TOT": 31,
    "RN_DAY": 38,
    "RN_DUR": 40,
    "RN_60M_MAX": 42,
    "RN_POW_MAX": 46,
}
STATION_ID_FIELD = 0
STATION_NAME_FIELD = 10

# Korean column names of the weather mart.
WEATHER_MART_COLUMNS = {
    "STN_KO": "지역명",
    "TM": "측정시간",
    "TA_AVG": "평균온도",
    "TA_MAX": "최고온도",
    "TA_MIN": "최저온도",
    "RN_DAY": "일강수량",
}

# Business time.
BUSINESS_ZONE = "Asia/Seoul"
BUSINESS_OFFSET_HOURS = 9

# Topics (last parts) of the dated zone paths.
TOPICS = {
    "ably_listing": "ably/ranking_data",
    "ably_reviews": "ably/review_data",
    "cm29_listing": "29cm/29cm_product",
    "cm29_reviews": "29cm/29cm_reviews",
    "musinsa_ranking": "musinsa/ranking_data",
    "musinsa_detail": "musinsa/product_detail_data",
    "musinsa_reviews": "musinsa/product_review_data",
    "snap_brand": "otherapis/musinsa_snap_brand_ranking_raw_data",
    "snap_story_women": "otherapis/musinsa_WOMEN_ranking_story_group_raw_data",
    "snap_story_men": "otherapis/musinsa_MEN_ranking_story_group_raw_data",
    "trend_women": "otherapis/여성_keyword_trends",
    "trend_men": "otherapis/남성_keyword_trends",
    "video_women": "otherapis/여성_youtoube_videos_by_categories_raw_data",
    "video_men": "otherapis/남성_youtoube_videos_by_categories_raw_data",
    "weather_daily": "otherapis/weekly_weather_data_raw_data",
    "weather_stations": "otherapis/weather_station_data_raw_data",
}
