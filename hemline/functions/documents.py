"""JSON and HTML text columns."""

from __future__ import annotations

import json
from html import unescape as unescape_reference
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemline.functions.casts import as_column


def json_parse(c: Column | str, schema) -> Column:
    """Struct of the JSON text; all fields NULL when the text is malformed."""
    return F.from_json(as_column(c), schema)


def json_path(c: Column | str, path: str) -> Column:
    return F.get_json_object(as_column(c), path)


def _found(c: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))


# Attributes of a tag: everything up to the ">" outside quotes; then names with their values, whose
# quotes may hold the other kind of quote. A value is never searched for names.
_INSIDE_TAG = r"""((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
_ATTRIBUTE = r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'=<>`]+))?"""

_REFERENCE = r"&(#[0-9]{1,9}|#[xX][0-9a-fA-F]{1,8}|[A-Za-z][A-Za-z0-9]{1,31});"
#: Numbers 128 to 159 stand for the characters of the Windows code page.
_C1 = {n: unescape_reference(f"&#{n};") for n in range(128, 160)}


def _named_references() -> Column:
    names = {n[:-1]: text for n, text in html5.items() if n.endswith(";")}
    return F.from_json(F.lit(json.dumps(names)), "map<string,string>")


def _character(number: Column) -> Column:
    """Text of a code point; the replacement character for what is none."""
    hexadecimal = F.lpad(F.hex(number), 8, "0")
    valid = (number > 0) & (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    c1 = F.map_from_arrays(F.array(*map(F.lit, _C1)), F.array(*map(F.lit, _C1.values())))
    return F.when(number.between(128, 159), c1[number.cast("int")]).when(
        valid, F.decode(F.unhex(hexadecimal), "UTF-32")).otherwise("\ufffd")


def unescape(c: Column) -> Column:
    """Replace all character references that end in a semicolon; unknown names stay as they are."""
    def resolved(reference: Column) -> Column:
        body = F.substring(reference, 2, 100)
        name = F.regexp_replace(body, ";$", "")
        number = F.when(name.rlike("^#[xX]"), F.conv(F.substring(name, 3, 10), 16, 10)).otherwise(F.substring(name, 2, 10))
        return F.when(name == "amp", "&").when(name.startswith("#"), _character(number.try_cast("bigint"))).otherwise(
            F.coalesce(F.try_element_at(_named_references(), name), reference))

    between = F.split(c, _REFERENCE, -1)
    references = F.transform(F.regexp_extract_all(c, F.lit(_REFERENCE), F.lit(0)), resolved)
    joined = F.array_join(F.flatten(F.zip_with(between, references, lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")
    return F.when(F.contains(c, F.lit("&")), joined).otherwise(c)


def _attribute(tag: Column, name: str) -> Column:
    """Value of the first attribute of this name, without quotes; NULL when absent or empty."""
    names = F.transform(F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), F.lit(1)), F.lower)
    values = F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), F.lit(2))
    value = F.get(values, F.array_position(names, name).cast("int") - 1)
    quoted = value.startswith('"') | value.startswith("'")
    return F.nullif(F.when(quoted, F.substring(value, 2, F.length(value) - 2)).otherwise(value), F.lit(""))


_COMMENT = r"<!--.*?(?:-->|\z)"


def visible(html: Column) -> Column:
    """The page without comments and without what scripts and styles hold, in which no tag is one."""
    return F.regexp_replace(html, rf"(?is){_COMMENT}|(<(script|style)(?=[\s/>]){_INSIDE_TAG}).*?(?=</\2|\z)", "$1")


def _tags(visible_html: Column, name: str) -> Column:
    return F.regexp_extract_all(visible_html, F.lit(rf"(?is)<{name}(?=[\s/>]){_INSIDE_TAG}"), F.lit(1))


def _raw_title(visible_html: Column) -> Column:
    return _found(visible_html, r"(?is)<title[^>]*>(.*?)</title>")


def _raw_links(visible_html: Column) -> Column:
    return F.filter(F.transform(_tags(visible_html, "a"), lambda tag: _attribute(tag, "href")), lambda link: link.isNotNull())


def page_title(html: Column | str, suffix: str | None = None) -> Column:
    """Text of <title> without the site's suffix; NULL when there is no title."""
    title = unescape(_raw_title(visible(as_column(html))))
    return F.regexp_replace(title, suffix, "") if suffix else title


def page_lang(html: Column | str) -> Column:
    return _attribute(F.get(_tags(visible(as_column(html)), "html"), 0), "lang")


def page_meta(html: Column | str, prop: str) -> Column:
    """Content of the first <meta property=prop>, whichever attribute comes first."""
    named = F.filter(_tags(visible(as_column(html)), "meta"), lambda tag: _attribute(tag, "property") == prop)
    return unescape(_attribute(F.get(named, 0), "content"))


def page_links(html: Column | str) -> Column:
    """Array of link targets in page order; links without a target are left out."""
    return F.transform(_raw_links(visible(as_column(html))), unescape)


def page_script(html: Column | str, script_id: str) -> Column:
    """Text of the first <script> with this id, NULL when absent; none inside a comment counts."""
    pieces = F.regexp_extract_all(as_column(html), F.lit(rf"(?is){_COMMENT}|<script(?=[\s/>]){_INSIDE_TAG}.*?</script"), F.lit(0))
    named = F.filter(pieces, lambda s: ~s.startswith("<!--") & (
        _attribute(F.regexp_extract(s, rf"(?is)^<script{_INSIDE_TAG}", 1), "id") == script_id))
    return F.nullif(F.regexp_extract(F.get(named, 0), rf"(?is)^<script{_INSIDE_TAG}(.*)</script$", 2), F.lit(""))


def page_fields(pages: DataFrame, html: str, metas: list[str], script_id: str, keep: list[str] | None = None) -> DataFrame:
    """(title, meta, links, script) of every page, each part of it scanned once.

    ``meta`` is the array of the contents of ``metas``, in their order. All values of a page, links
    included, are resolved together, so the table of references stands in the plan once.
    """
    seen = pages.select(*(keep or []), F.col(html).alias("_html"), visible(F.col(html)).alias("_visible"))
    tags = seen.select(
        *(keep or []), _raw_title(F.col("_visible")).alias("_title"), _raw_links(F.col("_visible")).alias("_links"),
        F.transform(_tags(F.col("_visible"), "meta"), lambda t: F.struct(
            _attribute(t, "property").alias("property"), _attribute(t, "content").alias("content"))).alias("_metas"),
        page_script("_html", script_id).alias("script"))

    def content(prop: str) -> Column:
        return F.get(F.filter("_metas", lambda m: m["property"] == prop), 0)["content"]

    raw = tags.select(*(keep or []), "script", F.concat(F.array("_title", *map(content, metas)), "_links").alias("_raw"))
    values = raw.select(*(keep or []), "script", F.transform("_raw", unescape).alias("_values"))
    return values.select(
        *(keep or []), F.get("_values", 0).alias("title"), F.slice("_values", 2, len(metas)).alias("meta"),
        F.slice("_values", len(metas) + 2, F.size("_values")).alias("links"), "script")
