"""Text columns: fields of records, category names, paths and URLs, durations."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from hemline.fixed_values import CATEGORY_SEPARATOR
from hemline.functions.casts import as_column, to_double, to_int


def strip_unit(c: Column | str, unit: str) -> Column:
    """'170cm' -> 170.0; text that is not a number after removal gives NULL."""
    return to_double(F.replace(as_column(c), F.lit(unit), F.lit("")))


def file_stem(path: Column | str, extension: str = "json") -> Column:
    """Last path part without its extension; '' when the extension differs."""
    return F.regexp_extract(as_column(path), rf"/([^/]+)\.{re.escape(extension)}$", 1)


def last_path_part(c: Column | str) -> Column:
    return F.element_at(F.split(as_column(c), "/"), -1)


def url_host(url: Column | str) -> Column:
    return F.split_part(F.split_part(as_column(url), F.lit("://"), F.lit(2)), F.lit("/"), F.lit(1))


def text_after(c: Column | str, mark: str) -> Column:
    """What follows the first ``mark``, up to the next one; NULL when there is no mark."""
    return F.get(F.split(as_column(c), re.escape(mark)), 1)


def compose_category(*levels: Column | str) -> Column:
    """'a-b-c'; missing levels are skipped."""
    return F.concat_ws(CATEGORY_SEPARATOR, *[as_column(c) for c in levels])


def category_level(c: Column | str, level: int) -> Column:
    """n-th level of a composed name; '' past the end, NULL for NULL."""
    return F.split_part(as_column(c), F.lit(CATEGORY_SEPARATOR), F.lit(level))


def translate_name(c: Column | str, names: dict[str, str], default: Column | None = None) -> Column:
    """The name a short fixed list gives to a key; ``default`` (NULL) for a key not in it."""
    known = F.create_map(*[F.lit(text) for pair in names.items() for text in pair])
    found = F.try_element_at(known, as_column(c))
    return found if default is None else F.coalesce(found, default)


def is_text_record(line: Column | str, comment: str, markers: list[str]) -> Column:
    """True for lines that carry data: not blank, not a comment, no block marker."""
    line = F.trim(as_column(line))
    unwanted = reduce(lambda a, b: a | b, [line.contains(m) for m in markers], line.startswith(comment))
    return (line != "") & ~unwanted


def record_fields(line: Column | str, separator: str) -> Column:
    """Array of the fields of one record; ``separator`` is a regular expression."""
    return F.split(F.trim(as_column(line)), separator)


def record_field(fields: Column | str, position: int) -> Column:
    """Field by position, NULL when the record is too short or the field blank."""
    return F.nullif(F.trim(F.get(as_column(fields), position)), F.lit(""))


def duration_seconds(c: Column | str) -> Column:
    """ISO 8601 'PT#H#M#S' in seconds; a missing part is 0, text of another form NULL."""
    c = as_column(c)

    def part(unit: str, larger: str) -> Column:
        # The digits before the unit and after the larger units.
        digits = F.substring_index(c, unit, 1)
        for mark in larger:
            digits = F.substring_index(digits, mark, -1)
        return F.when(c.contains(unit), F.coalesce(to_int(digits), F.lit(0))).otherwise(0)

    seconds = part("H", "T") * 3600 + part("M", "TH") * 60 + part("S", "THM")
    return F.when(c.startswith("PT"), seconds)
