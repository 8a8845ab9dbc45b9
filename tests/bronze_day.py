"""A small invented bronze day, written as files the way the collectors store them."""

import json
import os

RUN_DATE = "2025-01-02"


def put(base, topic, name, content):
    path = os.path.join(base, "bronze", RUN_DATE, topic, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(content)


def pretty(value):
    return json.dumps(value, ensure_ascii=False, indent=4)


def line(value):
    return json.dumps(value, ensure_ascii=False)


def ably_item(sno, rank, name, price=10000):
    return {
        "item": {"like": {"goods_sno": sno}, "image": f"https://a/{sno}.jpg", "ranking": rank,
                 "first_page_rendering": {"original_price": price + 5000}},
        "logging": {"analytics": {"GOODS_NAME": name, "MARKET_NAME": "상점", "SALES_PRICE": price, "DISCOUNT_RATE": 10,
                                  "REVIEW_COUNT": 3, "REVIEW_RATING": 4.5, "LIKES_COUNT": 7}},
    }


def cm29_product(pid, rank, name="코트"):
    return {"ranking": rank, "product_id": pid, "product_name": name, "brand_name_kr": "브랜드", "brand_name_en": "BRAND",
            "original_price": 20000, "final_price": 15000, "discount_ratio": 25, "review_counting": 12,
            "review_avg_rating": 4.25, "like_counting": 99, "gender": "M/W", "categoryMediumNames": ["a"],
            "categorySmallNames": [], "platform": "29CM", "created_at": RUN_DATE, "img_url": "https://c/1.jpg",
            "soldout_status": False, "isNew": True}


def module_item(pid, index):
    return {"id": pid, "info": {"onClickBrandName": {"eventLog": {"ga4": {"payload": {"index": index}}}}}}


def detail(pid, category, **changes):
    record = {"platform": "musinsa", "master_category_name": category, "small_category_name": "셔츠&블라우스",
              "product_id": str(pid), "product_name": "셔츠", "brand_name_kr": "무", "brand_name_en": "mu",
              "original_price": "30000", "final_price": "24000", "discount_rate": "20", "review_count": "5",
              "review_avg_rating": "4.8", "like_counting": 11, "image_src": "https://m/1.jpg", "created_at": RUN_DATE}
    return {**record, **changes}


def musinsa_review(pid, content, created, height=None):
    return {"goods": {"goodsNo": pid}, "content": content, "grade": "5", "createDate": created,
            "userProfileInfo": {"userHeight": height, "userWeight": 60}, "goodsOption": "M"}


def weather_line(day, station, **fields):
    values = ["0"] * 47
    values[0], values[1] = day, str(station)
    for position, value in fields.items():
        values[int(position[1:])] = value
    return ",".join(values)


def write_day(base):
    put(base, "ably/ranking_data", "8_18/8_18.json", pretty([ably_item(1, 1, "티셔츠"), ably_item(2, 2, "반팔", 12000)]))
    put(base, "ably/ranking_data", "9_99/9_99.json", pretty([ably_item(1, 5, "티셔츠"), ably_item(None, 6, "번호 없음")]))
    put(base, "ably/review_data", "8_18/reviews_8_18_1.json", pretty([
        {"goods_sno": 1, "contents": "좋아요", "eval": 5, "created_at": "2025-01-01 03:04:05", "height": 160, "weight": None,
         "goods_option": ["블랙", "M"]},
        {"goods_sno": 1, "contents": None, "eval": "bad", "created_at": "not a date", "height": "x", "weight": 50, "goods_option": []},
    ]))

    put(base, "29cm/29cm_product", "Man/Outer/Blazers.json", pretty([cm29_product(10, 1), cm29_product(11, 2, None)]))
    put(base, "29cm/29cm_product", "Woman/Outer/Blazers.json", pretty([cm29_product(10, 3)]))
    put(base, "29cm/29cm_product", "Woman/Etc/Unlisted.json", pretty([cm29_product(12, 1)]))
    put(base, "29cm/29cm_reviews", "Man/Outer/Blazers_reviews.json", pretty([
        {"product_id": 10, "contents": "굿", "point": 4, "insertTimestamp": "2024-12-31T23:59:59", "userSize": ["170cm", "60kg"],
         "optionValue": ["네이비", "L"], "created_at": RUN_DATE},
        {"product_id": 10, "contents": "음", "point": 2, "insertTimestamp": "2024-12-30", "userSize": [], "optionValue": None,
         "created_at": RUN_DATE},
    ]))

    modules = [{"items": [module_item("100", 1)]}] + [{"items": [module_item(str(100 + i), i)]} for i in range(1, 18)]
    modules[3] = {}
    modules[4] = {"items": None}
    modules[5] = {"items": []}
    modules[6] = {"items": [module_item("x106", 6), module_item("206", 7)]}
    modules.append({"items": [module_item("999", 99)]})
    put(base, "musinsa/ranking_data", "셔츠/여성_상의_셔츠_셔츠&블라우스 + 기타.json", line({"data": {"modules": modules}}))
    put(base, "musinsa/ranking_data", "셔츠/남성_상의_셔츠_셔츠.json", line({"data": {"modules": modules[:3]}}))
    put(base, "musinsa/product_detail_data", "셔츠/셔츠&블라우스/101.json", line(detail(101, "여성-상의-셔츠")))
    put(base, "musinsa/product_detail_data", "셔츠/셔츠&블라우스/102.json",
        line(detail(102, "여성-상의-셔츠", product_name="가" * 200, discount_rate="", review_count=None)))
    put(base, "musinsa/product_detail_data", "셔츠/셔츠&블라우스/103.json", "<html>denied</html>")
    put(base, "musinsa/product_review_data", "셔츠/셔츠&블라우스/101.json", line({"total": 3, "list": [
        musinsa_review(101, "첫", "2025-01-02T00:30:00.000+09:00", 175),
        musinsa_review(101, "첫", "2025-01-02T00:30:00.000+09:00", 175),
        musinsa_review(101, "둘", "2025-01-01T16:00:00.000+00:00"),
    ]}))

    def brand(bid, rank, previous, labels):
        ranking = {"rank": rank} if previous is None else {"rank": rank, "previousRank": previous}
        return {"id": bid, "nickname": bid.upper(), "profileImageUrl": f"https://b/{bid}", "ranking": ranking, "followerCount": 5,
                "snaps": [{"labels": [{"name": n} for n in snap]} for snap in labels]}

    put(base, "otherapis/musinsa_snap_brand_ranking_raw_data", "page_1.json", line({"data": {"list": [
        brand("a", 1, 3, [["캐주얼", "미니멀"], ["미니멀", "스포티"], ["스포티"]]),
        brand("b", 2, None, [["걸리시"]]),
    ]}}))
    put(base, "otherapis/musinsa_snap_brand_ranking_raw_data", "page_2.json", line({"data": {"list": [brand("c", 3, 1, [])]}}))
    for gender, sid in (("WOMEN", 1), ("MEN", 2)):
        put(base, f"otherapis/musinsa_{gender}_ranking_story_group_raw_data", "page_1.json", line({"data": {"list": [
            {"id": str(sid), "contentType": "SNAP", "aggregations": {"likeCount": 9}, "tags": [{"name": "겨울"}, {"name": None}, {"name": "코디"}]},
            {"id": str(sid + 10), "contentType": "SNAP", "aggregations": None, "tags": None},
        ]}}))
    for gender, words in (("여성", ["니트", "코트"]), ("남성", ["슬랙스"])):
        put(base, f"otherapis/{gender}_keyword_trends", "final_top_5_keywords_data.json", line({
            "startDate": "2024-12-26", "endDate": "2025-01-02", "timeUnit": "date",
            "results": [{"title": f"{w}_trend", "keyword": [w], "data": [
                {"period": "2025-01-01", "ratio": 50.5}, {"period": "2025-01-02", "ratio": 100}]} for w in words]
            + [{"title": "없음_trend", "keyword": ["없음"], "data": []}],
        }))
        put(base, f"otherapis/{gender}_youtoube_videos_by_categories_raw_data", f"{gender}_a_b_c/d_data.json", line([
            {"videoId": f"v-{words[0]}"[:4] + gender[:1], "category_name": f"{gender}_아우터_자켓_점퍼", "title": "제목", "channelName": "채널",
             "thumbnailUrl": "https://y", "publishedAt": "2025-01-01T10:00:00Z", "duration": 300, "viewCount": "1234", "likeCount": "0",
             "commentCount": "0", "tags": []},
        ]))
        put(base, f"otherapis/{gender}_youtoube_videos_by_categories_raw_data", f"{gender}_flat_data.json", line([]))
    put(base, "otherapis/weekly_weather_data_raw_data", "weather_daily_0.txt", "\n".join([
        "#START7777", "# YYMMDDHHMI,STN", weather_line("20250101", 90, f2="1.5", f10="2.25", f11="7.05", f13="-3.44", f38="12.25"),
        "", "  ", weather_line("20250101", 108, f2="", f10="bad"), "20250101,105,1.0", weather_line("2025", 90), "#7777END",
    ]))
    put(base, "otherapis/weather_station_data_raw_data", "weather_station.txt", "\n".join([
        "#START7777", "#  STN LON", "  90 128.56 38.25 1 2 3 4 5 6 7 속초 SOKCHO", " 108 126.9 37.5 1 2 3 4 5 6 7 서울", "105 1 2", "#7777END",
    ]))


ABLY_CATEGORIES = [("8_18", "여성-상의-티셔츠", "반소매"), ("8_20", "여성-상의-니트", "니트")]
CM29_CATEGORIES = [("Blazers", "아우터", "자켓", "블레이저"), ("Leggings", "하의", "팬츠", "레깅스")]
