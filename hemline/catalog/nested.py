"""Nested documents. Every document row is a two-level structure of its text: lines of words."""

from __future__ import annotations

from pyspark.sql import functions as F

from hemline.catalog.registry import query, texts
from hemline.functions.arrays import first_elements
from hemline.operators import grouping, nested


def line_words(items: str = "items", **extra):
    """Array of lines; each a struct of its words (``items``) and further fields made from the line."""
    def line(x):
        fields = [make(x).alias(name) for name, make in extra.items()]
        words = F.transform(F.split(x, " "), lambda w: F.struct(w.alias("name")))
        return F.struct(*fields, words.alias(items))

    return F.transform(F.split("text", "\n"), line)


@query("explode_list", "select doc_id, unnest(string_split(text, chr(10))) as line from documents")
def explode_list(spark, d):
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("line")))
    docs = texts(spark, d, "documents").select("doc_id", F.struct(lines.alias("list")).alias("data"))
    return nested.explode_items(docs, "data.list", "item", ["doc_id"]).select("doc_id", "item.line")


@query("explode_nested", """
select doc_id, cast(length(line) as int) as line_length, unnest(string_split(line, ' ')) as word
from (select doc_id, unnest(string_split(text, chr(10))) as line from documents)
""")
def explode_nested(spark, d):
    docs = texts(spark, d, "documents").select("doc_id", line_words("data", line_length=F.length).alias("results"))
    points = nested.explode_two_levels(docs, "results", "data", ["doc_id"], "result", "point")
    return points.select("doc_id", "result.line_length", F.col("point.name").alias("word"))


@query("indexed_modules", """
select doc_id, unnest(string_split(line, ' ')) as word
from (select doc_id, unnest(string_split(text, chr(10))[2:18]) as line from documents)
where contains(line, ',')
""")
def indexed_modules(spark, d):
    # Modules without an item list (NULL) occur among the others.
    modules = F.transform(line_words(listed=lambda x: F.contains(x, F.lit(","))), lambda m: F.struct(
        F.when(m["listed"], m["items"]).alias("items")))
    docs = texts(spark, d, "documents").select("doc_id", F.struct(modules.alias("modules")).alias("data"))
    return nested.module_items(docs, "data.modules", "items", ["doc_id"]).select("doc_id", F.col("item.name").alias("word"))


@query("components_of_kind", """
select doc_id, cast(pos - 1 as int) as component_pos,
       cast(generate_subscripts(string_split(line, ' '), 1) - 1 as int) as item_pos, unnest(string_split(line, ' ')) as word
from (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos from documents)
where contains(line, ',')
""")
def components_of_kind(spark, d):
    kinds = F.transform(line_words(component_id=lambda x: F.when(F.contains(x, F.lit(",")), 9).otherwise(7)), lambda c: F.struct(
        c["component_id"].alias("component_id"), F.struct(c["items"].alias("item_list")).alias("entity")))
    docs = texts(spark, d, "documents").select("doc_id", kinds.alias("components"))
    found = nested.components_of_kind(docs, "components", 9, keep=["doc_id"])
    return found.select("doc_id", "component_pos", "item_pos", F.col("item.name").alias("word"))


@query("posexplode_rank", """
select doc_id, unnest(string_split(text, ' ')) as word, cast(generate_subscripts(string_split(text, ' '), 1) as int) as ranking
from documents
""")
def posexplode_rank(spark, d):
    docs = texts(spark, d, "documents").select("doc_id", F.split("text", " ").alias("words"))
    return nested.enumerate_items(docs, "words", ["doc_id"], "word")


@query("array_head", "select doc_id, unnest(string_split(text, ' ')[1:50]) as word from documents")
def array_head(spark, d):
    docs = texts(spark, d, "documents").select("doc_id", first_elements(F.split("text", " "), 50).alias("words"))
    return nested.explode_items(docs, "words", "word", ["doc_id"])


@query("flatten_tree", """
select doc_id, lang as depth_1, source as depth_2, unnest(string_split(text, chr(10))) as depth_3 from documents
""")
def flatten_tree(spark, d):
    tree = F.create_map("lang", F.create_map("source", F.split("text", "\n")))
    docs = texts(spark, d, "documents").select("doc_id", tree.alias("tree"))
    return nested.tree_leaves(docs, "tree", ["depth_1", "depth_2", "depth_3"], ["doc_id"])


@query("label_counts", """
select source, word as label_name, cast(count(*) as bigint) as label_count from (
  select source, unnest(string_split(line, ' ')) as word
  from (select source, unnest(string_split(text, chr(10))) as line from documents))
group by source, word
""")
def label_counts(spark, d):
    docs = texts(spark, d, "documents").select("source", line_words("labels").alias("snaps"))
    labels = nested.explode_two_levels(docs, "snaps", "labels", ["source"], inner_name="label")
    return grouping.label_counts(labels.select("source", F.col("label.name").alias("label_name")), "source", "label_name")
