"""Bronze -> silver casts. A value that does not fit becomes NULL, never an error.

A failing ``try_cast`` of text to a number raises and catches an exception inside the
task, some thirty times the cost of a successful one. Text is therefore tested by
pattern first and only cast when it is a number.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WHOLE = r"^\s*[+-]?[0-9]+\s*$"
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_DOUBLE = r"^\s*([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|[+-]?(?i:inf|infinity)|(?i:nan))\s*$"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int(c: Column | str) -> Column:
    """Integer; decimal text is truncated ('12.7' -> 12)."""
    c = as_column(c).cast("string")
    return F.when(c.rlike(_WHOLE), c.try_cast("int")).when(c.rlike(_NUMBER), c.try_cast("double").try_cast("int"))


def to_long(c: Column | str) -> Column:
    c = as_column(c).cast("string")
    return F.when(c.rlike(_WHOLE), c.try_cast("bigint")).when(
        c.rlike(_NUMBER), c.try_cast("decimal(38,6)").try_cast("bigint")
    )


def to_double(c: Column | str) -> Column:
    c = as_column(c).cast("string")
    return F.when(c.rlike(_DOUBLE), c.try_cast("double"))


def to_date(c: Column | str) -> Column:
    return as_column(c).try_cast("date")


def null_to_zero(c: Column | str) -> Column:
    """A missing number is zero."""
    return F.coalesce(as_column(c), F.lit(0))
