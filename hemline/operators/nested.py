"""Nested documents to rows. All of them work row by row, without a shuffle.

A plain explode makes the optimizer add a filter "the array is not empty" below it; when
the array is computed (parsed JSON, split text) it is then computed twice. The outer
form has no such filter, and the position tells an element from an absent array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemline.fixed_values import RANKED_MODULES_FROM, RANKED_MODULES_TO
from hemline.functions.casts import as_column


def _elements(df: DataFrame, array: Column | str, keep: list[str], name: str, position: str = "_position") -> DataFrame:
    """``keep``, the position from 0, and the element; no row for a NULL or empty array."""
    exploded = df.select(*keep, F.posexplode_outer(as_column(array)).alias(position, name))
    return exploded.where(F.col(position).isNotNull())


def explode_items(df: DataFrame, path: Column | str, name: str = "item", keep: list[str] | None = None) -> DataFrame:
    """One row per array element; a NULL or empty array gives no row."""
    return _elements(df, path, keep or [], name).drop("_position")


def explode_two_levels(
    df: DataFrame, outer: str, inner: str, keep: list[str] | None = None,
    outer_name: str = "outer_item", inner_name: str = "inner_item",
) -> DataFrame:
    """Explode ``outer``, then the array ``inner`` inside each of its elements."""
    keep = keep or []
    first = explode_items(df, outer, outer_name, keep)
    return explode_items(first, f"{outer_name}.{inner}", inner_name, [*keep, outer_name])


def enumerate_items(
    df: DataFrame, path: str, keep: list[str] | None = None, name: str = "item", rank: str = "ranking"
) -> DataFrame:
    """One row per array element with its position counted from 1."""
    keep = keep or []
    return _elements(df, path, keep, name).select(*keep, name, (F.col("_position") + 1).alias(rank))


def module_items(
    df: DataFrame, modules: str, items: str, keep: list[str] | None = None, name: str = "item",
    first: int = RANKED_MODULES_FROM, last: int = RANKED_MODULES_TO,
) -> DataFrame:
    """Items of the modules at positions ``first``..``last`` (from 0), in one pass over the documents.

    The item lists are exploded level by level: flattening them first would lose a
    whole document when one module has no list.
    """
    keep = keep or []
    wanted = F.slice(F.col(modules), first + 1, last - first + 1)
    lists = explode_items(df, F.transform(wanted, lambda m: m[items]), "_list", keep)
    return explode_items(lists, "_list", name, keep)


def components_of_kind(
    df: DataFrame, components: str, kind: int, items: str = "entity.item_list",
    kind_field: str = "component_id", keep: list[str] | None = None, name: str = "item",
) -> DataFrame:
    """Items of the listing components of one kind, with ``component_pos`` and ``item_pos``."""
    keep = keep or []
    found = _elements(df, components, keep, "_component", "component_pos")
    found = found.where(F.col(f"_component.{kind_field}") == kind)
    return _elements(found, f"_component.{items}", [*keep, "component_pos"], name, "item_pos")


def tree_leaves(df: DataFrame, tree: str, names: list[str], keep: list[str] | None = None) -> DataFrame:
    """Rows (depth1, depth2, ..., leaf) of a tree of nested maps ending in arrays."""
    keep = list(keep or [])
    current, rows = tree, df
    for name in names[:-1]:
        rows = rows.select(*keep, F.explode(current).alias(name, "_subtree"))
        keep.append(name)
        current = "_subtree"
    return explode_items(rows, current, names[-1], keep)
