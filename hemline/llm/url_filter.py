"""URL filter by a tree of path templates per host.

Explicit rules come first: a rule fits its host and all subdomains when the path starts with the
rule's path, the longest rule wins. Urls under a rule are also the labelled urls of the method
(or the ``labels`` that the caller gives):

1. Paths become segments; runs of digits and long hexadecimal runs become ``#``. Urls are counted by
   host and segments, so later steps see one row per different template, however hot a host is.
2. Level by level, the segments below a node are generalised to ``*`` when there are many of them
   and urls spread over many: the effective number of segments, ``(sum n)^2 / sum n^2`` over their
   different paths n, reaches ``min_children``. Repeated urls and the corpus size don't matter. The tree
   goes as deep as paths do; a node with fewer paths than ``min_children`` can't branch so far
   further down, and its paths end as they are, so one very long url adds no levels.
3. Sibling branches whose shares of bad labels don't differ significantly are merged: siblings in
   order of their share are chained while the two-proportion statistic of neighbours stays below
   ``max_z``.
4. A template is rejected when its smoothed share of bad labels reaches ``reject_at``. The prior is
   neutral: a template without labels is allowed.

NULL urls and urls without ``://`` have an empty host and path. Equal urls get equal verdicts, each
row its own. An empty table gives an empty table. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from hemline.llm.common import LOWER, UPPER, keep


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    rule: str

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.partition("/")[2]


RULES = (
    UrlRule("block", "net/"), UrlRule("allow", "example.net/en/"),
    UrlRule("block", "example.com/de/"), UrlRule("allow", "org/fr/"),
)
MIN_CHILDREN = 8
#: Levels between two written stages.
STAGE_LEVELS = 4
MAX_Z = 1.96
PRIOR_WEIGHT = 2.0
REJECT_AT = 0.75


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(text, parts, 1), UPPER, LOWER), F.regexp_extract(text, parts, 2)


def longest_rule(host: Column, path: Column, rules: tuple[UrlRule, ...], value) -> Column:
    """``value(rule)`` of the longest rule that fits, else NULL."""
    chosen = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.rule)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        chosen = F.when(fits, F.lit(value(r))).otherwise(chosen)
    return chosen


def segments(path: Column) -> Column:
    return F.transform(
        F.array_remove(F.split(path, "/"), ""),
        lambda s: F.regexp_replace(F.regexp_replace(s, r"\b[0-9a-fA-F]{8,}\b", "#"), "[0-9]+", "#"))


def templates(counted: DataFrame, min_children: int = MIN_CHILDREN) -> DataFrame:
    """Adds ``template`` (array) to (host, segs, urls, bad, good) rows, one row per host and path.

    One shuffle a level, of the paths that may still branch; the others leave the loop.
    """
    columns = [*counted.columns, "template"]
    tree, done, depth = counted.withColumn("template", F.array().cast("array<string>")), [], 0
    while True:
        node = tree.withColumn("child", F.get("segs", F.lit(depth)))
        children = node.where(F.col("child").isNotNull()).groupBy("host", "template", "child").agg(F.count("*").alias("paths"))
        nodes = children.groupBy("host", "template").agg(
            F.sum("paths").alias("below"), F.count("*").alias("n_children"), F.sum(F.col("paths").cast("double") * F.col("paths")).alias("squares"))
        spread = F.col("below").cast("double") * F.col("below") / F.col("squares")
        nodes = nodes.select(
            "host", "template", "below",
            ((F.col("n_children") >= min_children) & (spread >= min_children)).alias("variable"))
        step = F.when(F.col("variable"), F.lit("*")).otherwise(F.col("child"))
        joined = keep(node.join(nodes, ["host", "template"], "left"), "url-level") if depth % STAGE_LEVELS == STAGE_LEVELS - 1 else node.join(
            nodes, ["host", "template"], "left")
        ends = F.col("child").isNull() | (F.col("below") < min_children)
        rest = F.slice("segs", depth + 1, F.greatest(F.size("segs") - depth, F.lit(0)))
        done.append(joined.where(ends).withColumn("template", F.concat("template", rest)).select(*columns))
        tree = joined.where(~ends).withColumn("template", F.concat("template", F.array(step))).select(*columns)
        depth += 1
        if depth % STAGE_LEVELS == 0 and tree.isEmpty():
            return reduce(DataFrame.unionByName, done)


def template_purity(tree: DataFrame, max_z: float = MAX_Z, prior_weight: float = PRIOR_WEIGHT) -> DataFrame:
    """(host, template, urls, labelled, bad_share): smoothed share of bad labels of each template,
    counted over the similar siblings it is merged with."""
    total = tree.groupBy("host", "template").agg(
        F.sum("urls").alias("urls"), F.sum("bad").alias("bad"), (F.sum("bad") + F.sum("good")).alias("labelled"))
    parent = F.slice("template", 1, F.greatest(F.size("template") - 1, F.lit(0)))
    share = F.when(F.col("labelled") > 0, F.col("bad") / F.col("labelled"))
    rows = total.withColumn("parent", parent).withColumn("has_labels", F.col("labelled") > 0).withColumn("share", share)
    siblings = Window.partitionBy("host", "parent", "has_labels").orderBy("share", "template")
    before_bad, before_n = F.lag("bad").over(siblings), F.lag("labelled").over(siblings)
    both = rows.withColumn("bad_0", before_bad).withColumn("n_0", before_n)
    pooled = (F.col("bad") + F.col("bad_0") + 1) / (F.col("labelled") + F.col("n_0") + 2)  # never 0 or 1
    z = (F.col("share") - F.col("bad_0") / F.col("n_0")) / F.sqrt(pooled * (1 - pooled) * (1 / F.col("labelled") + 1 / F.col("n_0")))
    apart = F.when(~F.col("has_labels"), F.lit(1)).when(F.col("n_0").isNull(), F.lit(0)).when(z >= max_z, F.lit(1)).otherwise(F.lit(0))
    branch = both.withColumn("apart", apart).withColumn("branch", F.sum("apart").over(siblings))
    merged = branch.groupBy("host", "parent", "has_labels", "branch").agg(F.sum("bad").alias("all_bad"), F.sum("labelled").alias("all_labelled"))
    smoothed = (F.col("all_bad") + prior_weight * 0.5) / (F.col("all_labelled") + prior_weight)
    return branch.join(merged, ["host", "parent", "has_labels", "branch"]).select(
        "host", "template", "urls", "labelled", smoothed.alias("bad_share"))


def judge_urls(
    pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, reject_at: float = REJECT_AT, labels: DataFrame | None = None
) -> DataFrame:
    """page_id, host, path, rule, verdict, template and bad_share of every page.

    ``labels`` (url, bad) are labelled urls that take the place of those under a rule; they need not
    be among the pages. A NULL ``bad`` is no label.
    """

    def parsed(urls: DataFrame, *columns: Column) -> DataFrame:
        host, path = split_url(F.col("url"))
        return urls.select(*columns, host.alias("host"), path.alias("path")).withColumn("segs", segments(F.col("path")))

    ruled = parsed(pages, F.col("page_id")).select(
        "*", longest_rule(F.col("host"), F.col("path"), rules, lambda r: r.rule).alias("rule"),
        longest_rule(F.col("host"), F.col("path"), rules, lambda r: r.verdict).alias("ruled"))
    if labels is None:
        seen = ruled.select("host", "segs", (F.col("ruled") == "block").alias("bad"), F.lit(1).alias("page"))
    else:
        seen = ruled.select("host", "segs", F.lit(None).cast("boolean").alias("bad"), F.lit(1).alias("page")).unionByName(
            parsed(labels, F.col("bad")).select("host", "segs", "bad", F.lit(0).alias("page")))
    counted = keep(seen.groupBy("host", "segs").agg(
        F.sum("page").alias("urls"), F.count_if(F.col("bad")).alias("bad"), F.count_if(~F.col("bad")).alias("good")), "url-counts")
    tree = keep(templates(counted), "url-tree")
    judged = tree.select("host", "segs", "template").join(template_purity(tree), ["host", "template"]).select(
        "host", "segs", F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"), "bad_share")
    method = F.when(F.col("bad_share") >= reject_at, F.lit("block")).otherwise(F.lit("allow"))
    return ruled.join(judged, ["host", "segs"]).select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "template", "bad_share")
