"""Schemas of the bronze payloads (fixed values).

Payloads are read with ``as_text`` of a schema: every value as the text it is, for the contract to
cast, so that a value that can't be read is known and counted. The types stated here are those of
readable payloads.
"""

import re


def as_text(schema: str) -> str:
    """The schema with all its values as text."""
    return re.sub(r"\b(bigint|int|double|date|boolean)\b(?=\s*(?:[,>]|$))", "string", schema)


ABLY_ITEM = """
    item struct<
        like: struct<goods_sno: bigint>,
        image: string,
        ranking: int,
        first_page_rendering: struct<original_price: int>>,
    logging struct<analytics: struct<
        GOODS_NAME: string, MARKET_NAME: string, SALES_PRICE: int, DISCOUNT_RATE: int,
        REVIEW_COUNT: int, REVIEW_RATING: double, LIKES_COUNT: int>>
"""

ABLY_COMPONENTS = """
    components array<struct<
        component_id: int,
        entity: struct<item_list: array<struct<
            item: struct<
                like: struct<goods_sno: bigint>,
                image: string,
                ranking: int,
                first_page_rendering: struct<original_price: int>>,
            logging: struct<analytics: struct<
                GOODS_NAME: string, MARKET_NAME: string, SALES_PRICE: int, DISCOUNT_RATE: int,
                REVIEW_COUNT: int, REVIEW_RATING: double, LIKES_COUNT: int>>>>>>>,
    next_token string
"""

ABLY_REVIEW = """
    goods_sno string, contents string, eval string, created_at string,
    height string, weight string, goods_option array<string>
"""

CM29_PRODUCT = """
    ranking string, product_id string, product_name string,
    brand_name_kr string, brand_name_en string, original_price string, final_price string,
    discount_ratio string, review_counting string, review_avg_rating string,
    like_counting string, platform string, created_at string, img_url string
"""

CM29_LISTING = """
    data struct<products: array<struct<
        frontCategoryInfo: array<struct<
            categoryLargeName: string, categoryMediumName: string, categorySmallName: string>>,
        imageUrl: string, itemNo: bigint, itemName: string, frontBrandNo: bigint,
        frontBrandNameKor: string, frontBrandNameEng: string,
        consumerPrice: int, lastSalePrice: int, lastSalePercent: int,
        reviewCount: int, reviewAveragePoint: double, heartCount: int,
        isSoldOut: boolean, isNew: boolean>>>
"""

CM29_REVIEW = """
    product_id string, contents string, point string, insertTimestamp string,
    userSize array<string>, optionValue array<string>, created_at string
"""

MUSINSA_RANKING = """
    data struct<modules: array<struct<items: array<struct<
        id: string,
        info: struct<onClickBrandName: struct<eventLog: struct<ga4: struct<payload: struct<
            index: string>>>>>>>>>>
"""

MUSINSA_DETAIL = """
    platform string, master_category_name string, small_category_name string,
    product_id string, product_name string, brand_name_kr string, brand_name_en string,
    original_price string, final_price string, discount_rate string, review_count string,
    review_avg_rating string, like_counting int, image_src string, created_at date
"""

MUSINSA_REVIEW = """
    list array<struct<
        goods: struct<goodsNo: int>,
        content: string, grade: string, createDate: string,
        userProfileInfo: struct<userHeight: int, userWeight: int>,
        goodsOption: string>>,
    total int
"""

SNAP_BRAND = """
    data struct<list: array<struct<
        id: string, nickname: string, profileImageUrl: string,
        ranking: struct<rank: int, previousRank: int>,
        followerCount: int,
        snaps: array<struct<labels: array<struct<name: string>>>>>>>
"""

SNAP_STORY = """
    data struct<list: array<struct<
        id: string, contentType: string,
        aggregations: struct<likeCount: int>,
        tags: array<struct<name: string>>>>>
"""

KEYWORD_TREND = """
    startDate date, endDate date, timeUnit string,
    results array<struct<
        title: string, keyword: array<string>,
        data: array<struct<period: date, ratio: double>>>>
"""

VIDEO = """
    search_category string, videoId string, category_name string, title string,
    publishedAt string, channelName string, thumbnailUrl string,
    duration string, viewCount string, likeCount string, commentCount string
"""

VIDEO_SEARCH = """
    items array<struct<
        id: string,
        snippet: struct<
            title: string, publishedAt: string, description: string, channelTitle: string,
            thumbnails: struct<high: struct<url: string>>, tags: array<string>, categoryId: string>,
        contentDetails: struct<duration: string, dimension: string, definition: string>,
        statistics: struct<viewCount: string, likeCount: string, commentCount: string>>>
"""
