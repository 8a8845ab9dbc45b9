"""Benchmark decontamination by winnowing.

A window is ``span`` consecutive words of a benchmark item; an item of fewer words is one window.
Of every ``span - gram + 1`` consecutive gram hashes the smallest is kept as a fingerprint. A window
shared by a document and an item holds the same grams on both sides, hence at least one fingerprint
value kept on both: no shared span of ``span`` words is missed. Documents' fingerprints are joined
with those of the benchmark; a hit is extended to all windows around each place of the gram, and the
windows' words are compared in full by an equality join, so a hash collision gives no result.

The texts are read where they lie: fingerprints are exploded and looked up in one stage against the
benchmark's, whose number is counted first. Up to ``broadcast_rows`` they are broadcast; beyond it
only (document, fingerprint) pairs are shuffled, and matching documents are read again.

NULL and empty texts have no words. Items without words match nothing. Repeated documents each get
their row; equal items each count. Column names of the inputs other than the named ones don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemline.llm.common import alnum_words, keep, text_key, without

SPAN = 10
GRAM = 5
BROADCAST_ROWS = 200_000


def gram_hashes(words: Column, k: int) -> Column:
    """64-bit hashes of all runs of ``k`` words."""
    return F.when(F.size(words) >= k, F.transform(
        F.sequence(F.lit(0), F.size(words) - k), lambda i: F.xxhash64(*[words[i + j] for j in range(k)])
    )).otherwise(F.array().cast("array<bigint>"))


def window_minima(hashes: DataFrame, column: str, width: int) -> DataFrame:
    """Replace the array by the minima of all its windows of ``width`` elements (of the whole, if shorter).

    Minima of doubled windows are taken from pairs of minima, one step per doubling.
    """
    def pair(shift: int) -> Column:
        values, left = F.col(column), F.size(F.col(column)) - shift
        return F.when(left > 0, F.zip_with(
            F.slice(values, 1, left), F.slice(values, shift + 1, left), lambda a, b: F.least(a, b),
        )).otherwise(F.when(F.size(values) > 0, F.array(F.array_min(values))).otherwise(values))

    length = 1
    while length * 2 <= width:
        hashes, length = hashes.withColumn(column, pair(length)), length * 2
    return hashes.withColumn(column, pair(width - length)) if width > length else hashes


def benchmark_windows(benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """(item_id, window, n): all windows of all items, as words joined by a blank."""
    items = benchmark.select(F.col("item_id"), alnum_words(F.col("text")).alias("words")).where(F.size("words") > 0)
    sized = items.withColumn("n", F.least(F.size("words"), F.lit(span)))
    # the outer form of explode adds no filter that would compute its array a second time
    starts = sized.select("item_id", "words", "n", F.explode_outer(F.sequence(F.lit(1), F.size("words") - F.col("n") + 1)).alias("at"))
    return starts.select("item_id", F.array_join(F.slice("words", F.col("at"), F.col("n")), " ").alias("window"), "n").distinct()


def _words_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id"), text_key(F.col("text")).alias("text_key"), alnum_words(F.col("text")).alias("words"))


def _fingerprints(words: DataFrame, k: int, width: int) -> DataFrame:
    """Adds ``grams`` (all hashes, in place) and ``picked`` (the different fingerprints)."""
    placed = words.withColumn("grams", gram_hashes(F.col("words"), k)).withColumn("picked", F.col("grams"))
    return window_minima(placed, "picked", width).withColumn("picked", F.array_distinct("picked"))


def hits(docs: DataFrame, windows: DataFrame, span: int = SPAN, gram: int = GRAM, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(doc_id, text_key, start, n, window): every place of a document where a window occurs."""
    lengths = sorted(r["n"] for r in windows.select("n").distinct().collect())  # at most ``span`` values
    found = None
    for n in lengths:
        k = min(gram, n) if n == span else n
        width = n - k + 1
        ours = windows.where(F.col("n") == n).select("window").distinct()
        # a window is short: its own grams and their smallest one
        values = window_minima(ours.select(gram_hashes(F.split("window", " "), k).alias("v")), "v", width)
        values = keep(values.select(F.explode_outer("v").alias("v")).where(F.col("v").isNotNull()).distinct(), "fingerprints")
        small = values.count() <= broadcast_rows and ours.count() <= broadcast_rows
        prints = _fingerprints(_words_of(docs), k, width)
        if small:
            matched = prints.select("doc_id", "text_key", "words", "grams", F.explode_outer("picked").alias("v")).join(
                F.broadcast(values), "v", "left_semi")
        else:
            pairs = prints.select(
                F.col("doc_id").alias("pair_id"), F.col("text_key").alias("pair_key"), F.explode_outer("picked").alias("v"),
            ).join(values, "v", "left_semi").distinct()
            grams = _words_of(docs).withColumn("grams", gram_hashes(F.col("words"), k))
            same = F.col("doc_id").eqNullSafe(F.col("pair_id")) & (F.col("text_key") == F.col("pair_key"))
            matched = grams.join(pairs, same).drop("pair_id", "pair_key")
        last = F.size("words") - n
        at = F.filter(F.transform("grams", lambda g, i: F.when(g == F.col("v"), i)), lambda i: i.isNotNull())
        around = F.flatten(F.transform(at, lambda i: F.sequence(F.greatest(i - (width - 1), F.lit(0)), F.least(i, last))))
        starts = matched.select(
            "doc_id", "text_key", "words", F.explode_outer(F.when(last >= 0, F.array_distinct(around))).alias("start"))
        spans = starts.select(
            "doc_id", "text_key", "start", F.array_join(F.slice("words", F.col("start") + 1, n), " ").alias("window"))
        spans = spans.join(F.broadcast(ours) if small else ours, "window", "left_semi").select(
            "doc_id", "text_key", "start", F.lit(n).alias("n"), "window")
        found = spans if found is None else found.unionByName(spans)
    if found is None:
        return _words_of(docs).where(F.lit(False)).select(
            "doc_id", "text_key", F.lit(0).alias("start"), F.lit(0).alias("n"), F.lit("").alias("window"))
    return found


def covered_words(spans: Column) -> Column:
    """Words under the union of (start, n) spans."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(
        F.array_sort(spans), start, lambda acc, s: F.struct(
            F.greatest(acc["end"], s["start"] + s["n"]).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), s["start"] + s["n"] - F.greatest(acc["end"], s["start"]))).alias("n")),
        lambda acc: acc["n"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """One row per document: doc_id, text_key, n_words, n_hit, item_ids (array) and contaminated.

    A document's spans and items are arrays no longer than its own words and the benchmark's items.
    """
    windows = keep(benchmark_windows(benchmark, span), "windows")
    found = keep(hits(docs, windows, span, gram), "hits")
    key = ["doc_id", "text_key"]
    places = found.groupBy(*key).agg(covered_words(F.collect_set(F.struct("start", "n"))).alias("n_hit"))
    items = found.select(*key, "window").distinct().join(windows, "window").groupBy(*key).agg(F.collect_set("item_id").alias("item_ids"))
    hit = places.join(items, key, "left").select(
        F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key"), "n_hit", "item_ids")
    counted = _words_of(docs).select(*key, F.size("words").cast("long").alias("n_words"))
    joined = counted.join(hit, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_key") == F.col("hit_key")), "left")
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    return joined.select(
        *key, "n_words", n_hit.alias("n_hit"),
        F.coalesce("item_ids", F.array().cast(dict(benchmark.dtypes)["item_id"].join(["array<", ">"]))).alias("item_ids"),
        (n_hit > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """The rows, with all their columns, that share no window with the benchmark."""
    windows = keep(benchmark_windows(benchmark, span), "windows")
    return without(docs, hits(docs, windows, span, gram))
