"""Column functions on literal rows, NULL and bad values included."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hemline.fixed_values import PAGE_TITLE_SUFFIX
from hemline.functions import arrays, casts, dates, documents, text


def column(spark, values, type_, function):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


@pytest.mark.parametrize("values, type_, function, wanted", [
    (["12", "12.7", "-3.9", " 7 ", "x", "", None, "99999999999"], "string", casts.to_int, [12, 12, -3, 7, None, None, None, None]),
    (["12", "9007199254740993", "1.5", "x", None], "string", casts.to_long, [12, 9007199254740993, 1, None, None]),
    (["1.5", "x", None], "string", casts.to_double, [1.5, None, None]),
    (["2025-01-02", "2025-13-02", None], "string", casts.to_date, [dt.date(2025, 1, 2), None, None]),
    ([1, None], "int", casts.null_to_zero, [1, 0]),
    (["170cm", "60.5cm", "cm", "?", None], "string", lambda c: text.strip_unit(c, "cm"), [170.0, 60.5, None, None, None]),
    (["file:/a/b/8_18.json", "s3a://z/한글 1.json", "/a/b.txt", "x.json"], "string", text.file_stem, ["8_18", "한글 1", "", ""]),
    (["a-b-c", "a", "", None], "string", lambda c: text.category_level(c, 2), ["b", "", "", None]),
    (["/brand/slug/x", "/none", None], "string", lambda c: text.text_after(c, "brand/"), ["slug/x", None, None]),
    (["http://h.x/p/q", "nothing", None], "string", text.url_host, ["h.x", "", None]),
    (["PT4M30S", "PT1H", "PT2H3S", "PT", "P1DT2H", "x", None, "PT90M"], "string", text.duration_seconds,
     [270, 3600, 7203, 0, None, None, None, 5400]),
    (["2025-01-02T23:30:00", "2025-01-02", "x", None], "string", dates.text_to_date, [dt.date(2025, 1, 2)] * 2 + [None] * 2),
    (["20250102", "20251302", "2025010", "2025-1-2", None], "string", dates.compact_date, [dt.date(2025, 1, 2)] + [None] * 4),
    (["2025-01-02T23:30:00.000+09:00", "2025-01-03T05:30:00.000+09:00", "2025-01-02T15:00:00.000+00:00", "x", None], "string",
     dates.offset_text_to_date, [dt.date(2025, 1, 2), dt.date(2025, 1, 3), dt.date(2025, 1, 3), None, None]),
    (["2025-01-02T03:04:05Z", "x", None], "string", dates.utc_text_to_timestamp, [dt.datetime(2025, 1, 2, 3, 4, 5), None, None]),
    ([["a", "b", "c"], ["a"], [], None], "array<string>", arrays.label_pair, ["a, b", "a", None, None]),
    ([["a", "b"], ["a"], [], None], "array<string>", lambda c: arrays.element(c, 1), ["b", None, None, None]),
    ([["a", None, "b"], [], None], "array<string>", arrays.array_to_text, ["a, b", "", None]),
    ([["b", "a", "", None, "b", "x"], [], None], "array<string>", lambda c: arrays.distinct_names(c, ["x"]), [["a", "b"], [], None]),
    ([["m", "w"], ["m"], ["w", None], ["z"], [], None], "array<string>",
     lambda c: arrays.membership_flag(c, "m", "w", ("M/W", "M", "W")), ["M/W", "M", "W", None, None, None]),
    ([[("a",), (None,), ("b",)], [], None], "array<struct<name: string>>", lambda c: arrays.field_to_text(c, "name"), ["a,b", "", ""]),
])
def test_function(spark, values, type_, function, wanted):
    assert column(spark, values, type_, function) == wanted


def test_dates_do_not_depend_on_the_session_zone(spark):
    values = ["2025-01-03T05:30:00.000+09:00"]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Seoul", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert column(spark, values, "string", dates.offset_text_to_date) == [dt.date(2025, 1, 3)]
            assert column(spark, ["2025-01-02T03:04:05Z"], "string", lambda c: dates.utc_text_to_timestamp(c).cast("string")) == [
                "2025-01-02 03:04:05"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_business_date(spark):
    got = column(spark, ["2025-01-01 14:59:59", "2025-01-01 15:00:00"], "string",
                 lambda c: dates.business_date(c.cast("timestamp_ntz")))
    assert got == [dt.date(2025, 1, 1), dt.date(2025, 1, 2)]


def test_compose_skips_missing_levels(spark):
    df = spark.createDataFrame([("여성", "상의", None), (None, None, None)], "a string, b string, c string")
    assert [r[0] for r in df.select(text.compose_category("a", "b", "c")).collect()] == ["여성-상의", ""]


PAGE = """<html lang="ko"><head><title>셔츠 - 사이즈 &amp; 후기 | 샵</title>
<meta property='product:brand' content='브랜드'><META content="100" property="product:price:amount">
<script id="__NEXT_DATA__" type="application/json">{"a": {"b": 3}}</script></head>
<body><a class=x href="/brand/slug">b</a><a href='/x'>x</a></body></html>"""


@pytest.mark.parametrize("function, wanted", [
    (lambda c: documents.page_title(c, PAGE_TITLE_SUFFIX), ["셔츠", None, None, None]),
    (documents.page_title, ["셔츠 - 사이즈 & 후기 | 샵", None, None, None]),
    (documents.page_lang, ["ko", None, None, None]),
    (lambda c: documents.page_meta(c, "product:brand"), ["브랜드", None, None, None]),
    (lambda c: documents.page_meta(c, "product:price:amount"), ["100", None, None, None]),
    (lambda c: documents.page_meta(c, "og:image"), [None] * 4),
    (documents.page_links, [["/brand/slug", "/x"], [], [], None]),
    (lambda c: documents.json_path(documents.page_script(c, "__NEXT_DATA__"), "$.a.b"), ["3", None, None, None]),
])
def test_page(spark, function, wanted):
    assert column(spark, [PAGE, "<title></title>", "plain", None], "string", function) == wanted


def test_malformed_json_gives_nulls(spark):
    got = column(spark, ['{"k": 1}', "{bad", None], "string", lambda c: documents.json_parse(c, "k int")["k"])
    assert got == [1, None, None]
