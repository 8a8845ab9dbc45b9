"""Importance resampling towards a target distribution of hashed n-grams.

Features of a text are all runs of 1 to ``NGRAM`` consecutive words joined by a blank; a feature's
bucket is the CRC-32 of its bytes modulo ``BUCKETS``. A bucket's gain is the whole-numbered log ratio
of its smoothed shares in the target texts and in all documents; a document's weight is the sum of
the gains of its features. Scores add Gumbel noise fixed by the document's id, so that the highest
scores are a sample without replacement in proportion to the weights' exponentials.

1. Feature counts: every task counts its texts' buckets into one array; arrays are summed by bucket.
   ``BUCKETS`` sums reach the driver, whatever the input.
2. Weights: every task looks its buckets up in the array of gains. Scores are written to the shared
   folder, the only table that later steps read.
3. Cutoff: the score of the last drawn document is found by bisection on the numbers themselves.
   Each job counts the documents at or above the midpoints of the next ``HALVINGS`` halvings, and
   reads only scores inside the interval that is left. Documents tied at the cutoff are divided the
   same way by id.
4. Ranks: the drawn rows, and no others, are range-partitioned by score and id and sorted inside
   their range; a rank is the row's place plus the number of rows in earlier ranges.

NULL and empty texts have no features and weight 0. A NULL id is noise's empty string and stands
after all ids in a tie. Repeated rows are documents of their own; of equal rows at the cutoff as
many are drawn as fit. An empty target has no features; an empty table gives an empty table. Columns
other than the named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemline.llm.common import keep, small_batches
from hemline.llm.words import word_pieces

BUCKETS = 10_000
NGRAM = 3
MIN_WORDS = 20
PERCENT = 5
SEED = "42"
#: Halvings of the interval that one counting job decides.
HALVINGS = 4
#: Drawn rows a range of ranks should hold.
ROWS_PER_RANGE = 200_000
LAST_ID = 2**63 - 1


def feature_buckets(text: str | None) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of the features that end in them) of the successive pieces of a text.

    The CRC of a run is that of the run before its last word, carried on over a blank and that word.
    """
    before: list[bytes] = []
    for piece in word_pieces(text):
        words = before + piece
        spaced = [b" " + w for w in words]
        runs, found = list(map(crc32, words)), []
        for length in range(1, NGRAM + 1):
            if length > 1:
                runs = list(map(crc32, spaced[length - 1:], runs))
            # runs that end before the new words were counted with the piece before
            found.append(np.array(runs[max(0, len(before) - length + 1):], np.uint32))
        yield len(piece), np.concatenate(found) % BUCKETS
        before = words[-(NGRAM - 1):]


def feature_counts(texts: DataFrame) -> np.ndarray:
    """Features of all texts by bucket: one array per task, summed by bucket."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                for _, buckets in feature_buckets(text):
                    counts += np.bincount(buckets, minlength=BUCKETS)
        filled = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(filled, pa.int32()), pa.array(counts[filled])], names=["bucket", "n"])

    small_batches(texts.sparkSession)
    sums = texts.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(BUCKETS, np.int64)
    counts[sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whole-numbered gain of every bucket, in thousandths of a natural logarithm."""
    s, t = source.astype(np.float64), target.astype(np.float64)
    ratio = ((t + 1) * (s.sum() + BUCKETS)) / ((s + 1) * (t.sum() + BUCKETS))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def noise(doc_id: Column, seed: str = SEED) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of a digest of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(-1000 * F.log(-F.log(uniform))).cast("long")


def weigh(docs: DataFrame, gain: np.ndarray, seed: str = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.zeros((batch.num_rows, 3), np.int64)
            for row, text in zip(rows, batch.column("text").to_pylist()):
                for words, buckets in feature_buckets(text):
                    row += words, len(buckets), gain[buckets].sum()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, rows.T.copy())], names=["doc_id", "n_words", "n_features", "weight"])

    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    weighed = rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")
    return weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def cutoff(rows: DataFrame, key: str, wanted: int, lo: int, hi: int) -> tuple[int, int]:
    """(the largest x with at least ``wanted`` rows of ``key`` >= x, the number of rows above x).

    All keys lie in [lo, hi] and there are ``wanted`` rows at least.
    """
    above = 0  # rows beyond hi
    while lo < hi:
        parts = 2**HALVINGS
        cuts = sorted({lo + (hi + 1 - lo) * j // parts for j in range(1, parts)} - {lo})
        counted = rows.where(F.col(key).between(lo, hi)).agg(
            *[F.count_if(F.col(key) >= c).alias(f"c{i}") for i, c in enumerate(cuts)]).first()
        reached = [c for i, c in enumerate(cuts) if above + counted[i] >= wanted]
        missed = [(c, counted[i]) for i, c in enumerate(cuts) if above + counted[i] < wanted]
        lo = max(reached, default=lo)
        if missed:
            hi, above = missed[0][0] - 1, above + missed[0][1]
    return lo, above


def ranked(drawn: DataFrame, order: list[Column], n_rows: int) -> DataFrame:
    """Adds ``rank``, from 1 in the given order: ranges of the order, then places inside them."""
    parts = max(1, -(-n_rows // ROWS_PER_RANGE))
    # the id is the range's number above 33 bits and the row's place below
    placed = drawn.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    placed = keep(placed, "drawn").withColumn("range", F.shiftright("place", 33).cast("int"))
    sizes = {r["range"]: r["n"] for r in placed.groupBy("range").agg(F.count("*").alias("n")).collect()}  # one row per range
    offsets = np.concatenate(([0], np.cumsum([sizes.get(k, 0) for k in range(max(sizes) + 1)])))
    offset = F.get(F.array(*[F.lit(int(n)) for n in offsets]), F.col("range"))
    return placed.withColumn("rank", (offset + F.col("place").bitwiseAND((1 << 33) - 1) + 1).cast("long")).drop("place", "range")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: str = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every row; rows that aren't drawn have no rank.

    Of the rows with at least ``min_words`` words, ``percent`` in a hundred are drawn, rounded down.
    """
    gain = gains(feature_counts(docs), feature_counts(target))
    scores = keep(weigh(docs, gain, seed), "scores")
    enough = F.col("n_words") >= min_words
    tie = F.bitwise_not(F.coalesce("doc_id", F.lit(LAST_ID)))  # falls as the id rises, without an overflow
    fit = scores.where(enough).withColumn("tie", tie)
    bounds = fit.agg(F.count("*").alias("n"), F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    wanted = percent * bounds["n"] // 100
    if not wanted:
        return scores.withColumn("rank", F.lit(None).cast("long"))
    score, above = cutoff(fit, "score", wanted, bounds["lo"], bounds["hi"])
    tied = fit.where(F.col("score") == score)
    ids = tied.agg(F.min("tie").alias("lo"), F.max("tie").alias("hi")).first()
    last, _ = cutoff(tied, "tie", wanted - above, ids["lo"], ids["hi"])
    drawn = (F.col("score") > score) | ((F.col("score") == score) & (tie >= last))
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("n_words")]
    with_ranks = ranked(scores.where(enough & drawn), order, wanted)
    # rows equal in score and id to the last drawn one may exceed the number
    with_ranks = with_ranks.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    return scores.where(~(enough & drawn)).withColumn("rank", F.lit(None).cast("long")).unionByName(with_ranks)
