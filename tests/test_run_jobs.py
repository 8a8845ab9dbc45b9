"""The jobs over raw payloads and silver tables, from the command line."""

import json

from conftest import rows

from hemline import run


def job(spark, tmp_path, name, source, *options):
    target = str(tmp_path / f"out_{name}")
    run.main(["job", name, str(source), target, "--run-date", "2025-01-02", *options], spark)
    return spark.read.parquet(target)


def write(tmp_path, name, value):
    (tmp_path / name).write_text(value if isinstance(value, str) else json.dumps(value))
    return tmp_path / name


def test_listing_products(spark, tmp_path):
    info = {"categoryLargeName": "여성의류", "categoryMediumName": "상의", "categorySmallName": "니트"}
    product = {
        "frontCategoryInfo": [info], "imageUrl": "/a.jpg", "itemNo": 5, "itemName": "knit", "frontBrandNo": 1, "frontBrandNameKor": "k",
        "frontBrandNameEng": "e", "consumerPrice": 10, "lastSalePrice": 9, "lastSalePercent": 10, "reviewCount": 1,
        "reviewAveragePoint": 4.5, "heartCount": 2, "isSoldOut": False, "isNew": True}
    got = job(spark, tmp_path, "listing_products", write(tmp_path, "l.json", {"data": {"products": [product, product | {"itemNo": 6}]}}))
    assert rows(got.select("ranking", "product_id", "gender")) == [(1, 5, "W"), (2, 6, "W")]


def test_page_products(spark, tmp_path):
    html = """<html><title>Shirt</title><meta property='product:brand' content="Levi's &amp; Co"><a href="/brand/levis">b</a></html>"""
    got = job(spark, tmp_path, "page_products", write(tmp_path, "page.html", html))
    assert rows(got.select("product_name", "brand_name_kr", "brand_name_en")) == [("Shirt", "Levi's & Co", "levis")]


def test_items_and_work_list_of_component_pages(spark, tmp_path):
    def item(number):
        return {"item": {"like": {"goods_sno": number}}}

    page = {"components": [{"component_id": 9, "entity": {"item_list": [item(3), item(1), item(3)]}}, {"component_id": 7, "entity": {"item_list": [item(8)]}}]}
    source = write(tmp_path, "top.json", page)
    assert [r["category"] for r in job(spark, tmp_path, "listing_items", source).orderBy("ranking").collect()] == ["top"] * 3
    assert rows(job(spark, tmp_path, "product_work_list", source)) == [("top", 0, [1, 3])]


def test_select_videos(spark, tmp_path):
    def video(name, duration):
        return {
            "id": name, "snippet": {"title": name, "publishedAt": "2025-01-01T00:00:00Z", "description": "d", "channelTitle": "c",
                                    "thumbnails": {"high": {"url": "u"}}, "tags": ["t"], "categoryId": "1"},
            "contentDetails": {"duration": duration, "dimension": "2d", "definition": "hd"},
            "statistics": {"viewCount": "5", "likeCount": "1", "commentCount": "0"}}

    got = job(spark, tmp_path, "select_videos", write(tmp_path, "coats.json", {"items": [video("long", "PT3H"), video("fits", "PT5M")]}))
    assert rows(got.select("category_name", "videoId", "duration")) == [("coats", "fits", 300)]


def test_category_groups(spark, tmp_path):
    got = job(spark, tmp_path, "category_groups", write(tmp_path, "tree.json", {"tree": {"여성": {"상의": {"니트": ["b", "a"]}}}}))
    assert rows(got) == [("여성", "상의", "니트", 0, ["a", "b"])]


def test_newest_reviews_and_top_keywords(spark, tmp_path):
    spark.sql("select * from values (1, date '2025-01-01', 'old'), (1, date '2025-01-02', 'new') t(product_id, review_date, review_content)").write.parquet(str(tmp_path / "reviews"))
    assert rows(job(spark, tmp_path, "newest_reviews", tmp_path / "reviews", "--limit", "1").select("review_content")) == [("new",)]
    spark.sql("select * from values ('W', 'coat', date '2025-01-01', 5.0D), ('W', 'knit', date '2025-01-01', 7.0D) t(gender, keyword_name, period, ratio)").write.parquet(str(tmp_path / "trend"))
    got = job(spark, tmp_path, "top_keywords", tmp_path / "trend")
    assert rows(got.select("keyword_name", "position")) == [("coat", 2), ("knit", 1)]
