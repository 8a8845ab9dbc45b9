"""Array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hemline.functions.casts import as_column


def element(c: Column | str, position: int) -> Column:
    """Element counted from 0, NULL when there is none."""
    return F.get(as_column(c), position)


def first_elements(c: Column | str, n: int) -> Column:
    return F.slice(as_column(c), 1, n)


def label_pair(labels: Column | str) -> Column:
    """'a, b' for two labels or more, 'a' for one, NULL for none."""
    labels = as_column(labels)
    return F.when(F.size(labels) >= 1, F.array_join(F.slice(labels, 1, 2), ", "))


def array_to_text(c: Column | str, separator: str = ", ") -> Column:
    return F.array_join(as_column(c), separator)


def field_to_text(c: Column | str, field: str, separator: str = ",") -> Column:
    """One field of every struct in the array, joined; '' for an array without values."""
    names = F.transform(as_column(c), lambda item: item[field])
    return F.coalesce(F.array_join(names, separator), F.lit(""))


def distinct_names(c: Column | str, excluded: list[str] | None = None) -> Column:
    """Sorted distinct non-empty names that are not excluded."""
    excluded = excluded or []

    def wanted(name: Column) -> Column:
        keep = name.isNotNull() & (name != "")
        return keep & ~name.isin(excluded) if excluded else keep

    return F.array_sort(F.array_distinct(F.filter(as_column(c), wanted)))


def membership_flag(c: Column | str, first: str, second: str, flags: tuple[str, str, str]) -> Column:
    """``flags`` are the answers for: both members present, only first, only second. Else NULL."""
    c = as_column(c)
    has_first, has_second = F.array_contains(c, first), F.array_contains(c, second)
    return (
        F.when(has_first & has_second, flags[0]).when(has_first, flags[1]).when(has_second, flags[2])
    )
