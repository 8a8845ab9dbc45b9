"""Ranked lexical search by NRA: no random access, sequential reads of impact-sorted lists.

Terms are runs of ASCII letters and digits and of characters beyond ASCII, A-Z in lower case. With
N texts that have a term, L terms in all, n terms in a document, tf occurrences of a term and df
documents that hold it, the impact of a term in a document is the whole number
``w * ((10**9 * tf) div (1000 * tf + 8 * m))`` with ``w = floor(1000 ln((2 N + 2) / (2 df + 1)))`` and
``m = 25 + (75 n N) div L``. A score is the sum of the impacts of the query's terms, repeats included.

1. ``build_index`` reads the texts once. A shard holds at most ``SHARD_DOCS`` documents and, unless a
   single text is longer, ``SHARD_TERMS`` terms. The index is two tables in the shared folder: lists
   (shard, term, places, tfs) and shards (shard, doc_ids, lengths).
2. ``search`` sums N, L and df over the index, picks the lists of query terms by a join, and brings
   the lists of a shard together. In a shard, each list is sorted by impact, and every query reads
   its lists in step, ever deeper. What was read of a document is the lower end of its score; the
   upper end adds the impacts at which the unread lists stand. Documents whose upper end is below
   the k-th lower end are out; reading goes on until no unseen document can come in, and every
   document left has its two ends equal. So ties and scores are exact, and only places are left to
   sort: a shard returns its k best rows a query, and a window keeps the k best of all.
3. The first shard is searched before the others. Its k-th score bounds every query from below, so
   other shards stop reading early and return only rows that reach it. Results don't depend on it.

Queries are searched in blocks of about ``BLOCK_TERMS`` different terms, so what is sent to a task
has a bound. NULL and empty texts have no terms; queries without known terms return nothing.
Documents with equal scores stand by ascending id, NULL last. Repeated rows are documents of their
own, and repeated queries are searched one by one. Empty tables give an empty result; columns
other than the named ones are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hemline.llm.common import alnum_words, keep, small_batches
from hemline.llm.words import word_pieces

TOP = 10
SHARD_DOCS = 8_192
SHARD_TERMS = 2_000_000
BLOCK_TERMS = 100_000
#: Postings that the first step reads of each list, and how much deeper every step reads than the last.
FIRST_DEPTH, DEEPER = 64, 4
#: Query terms up to which the join with the lists broadcasts them.
BROADCAST_TERMS = 200_000

LISTS = "shard long, term binary, places array<int>, tfs array<int>"
HITS = "query long, doc_id long, score long"


class Index(NamedTuple):
    lists: DataFrame
    shards: DataFrame


class _Shard:
    """The documents of a shard in order: their ids, lengths and term numbers."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = defaultdict(count().__next__)
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.pairs: list[np.ndarray] = []  # (term number, place) of every text's terms
        self.tfs: list[np.ndarray] = []
        self.held = 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        length = 0
        for piece in word_pieces(text):
            found = np.fromiter(map(self.numbers.__getitem__, piece), np.int64, len(piece))
            numbers, tfs = np.unique(found, return_counts=True)
            self.pairs.append(numbers << 32 | len(self.ids))
            self.tfs.append(tfs)
            length += len(piece)
        self.ids.append(doc_id)
        self.lengths.append(length)
        self.held += length

    def full(self) -> bool:
        return len(self.ids) >= SHARD_DOCS or self.held >= SHARD_TERMS

    def batches(self, shard: int) -> Iterator[pa.RecordBatch]:
        """One row with the documents, then the lists; ``kind`` tells them apart."""
        n = len(self.numbers)
        if n:
            pairs, inverse = np.unique(np.concatenate(self.pairs), return_inverse=True)
            tfs = np.bincount(inverse, np.concatenate(self.tfs))
            numbers, places = pairs >> 32, (pairs & 0xFFFFFFFF).astype(np.int32)
            ends = np.searchsorted(numbers, np.arange(n + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, shard)), pa.array(list(self.numbers), pa.binary()), pa.ListArray.from_arrays(ends, pa.array(places)),
                 pa.ListArray.from_arrays(ends, pa.array(tfs.astype(np.int32))), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int64()))],
                names=["shard", "term", "places", "tfs", "doc_ids", "lengths"])
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard]), pa.nulls(1, pa.binary()), pa.nulls(1, pa.list_(pa.int32())), pa.nulls(1, pa.list_(pa.int32())),
             pa.array([self.ids], pa.list_(pa.int64())), pa.array([self.lengths], pa.list_(pa.int64()))],
            names=["shard", "term", "places", "tfs", "doc_ids", "lengths"])


def build_index(docs: DataFrame) -> Index:
    """The inverted lists of all rows, written to the shared folder."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number = _Shard(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                shard.add(doc_id, text.as_py())
                if shard.full():
                    yield from shard.batches(number)
                    shard, number = _Shard(), number + 1
        if shard.ids:
            yield from shard.batches(number)

    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    written = keep(rows.mapInArrow(run, f"{LISTS}, doc_ids array<long>, lengths array<long>"), "index")
    return Index(
        written.where("term is not null").select("shard", "term", "places", "tfs"),
        written.where("doc_ids is not null").select(F.col("shard").alias("in_shard"), "doc_ids", "lengths"))


def query_terms(queries: DataFrame, id_col: str = "item_id") -> DataFrame:
    """(query, query_id, term, repeats) of every row of ``queries``; ``query`` numbers the rows."""
    numbered = keep(queries.select(F.monotonically_increasing_id().alias("query"), F.col(id_col).alias("query_id"), F.col("text")), "queries")
    terms = numbered.select("query", "query_id", F.explode(alnum_words(F.col("text"))).alias("term"))
    counted = terms.groupBy("query", "query_id", F.col("term").cast("binary").alias("term")).agg(F.count("*").alias("repeats"))
    return keep(counted, "query-terms")


class Query:
    """A query's lists in a shard, sorted by falling impact, and how far they were read."""

    def __init__(self, lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int) -> None:
        self.lists = lists
        self.lower = np.zeros(n_docs, np.int64)
        self.seen = np.zeros((n_docs, len(lists)), bool)
        self.depth = 0
        #: The impact at which each list stands: no unread entry has more; 0 at its end.
        self.stands = np.array([impacts[0] for _, impacts in lists], np.int64)

    def read_to(self, depth: int) -> None:
        for k, (places, impacts) in enumerate(self.lists):
            read = places[self.depth:depth]
            self.lower[read] += impacts[self.depth:depth]
            self.seen[read, k] = True
            self.stands[k] = impacts[depth - 1] if depth < len(impacts) else 0
        self.depth = depth

    def search(self, k: int, least: int) -> np.ndarray:
        """Places of all documents that may be among the k best and reach ``least``, their scores known."""
        depth = FIRST_DEPTH
        while True:
            self.read_to(depth)
            depth *= DEEPER
            bound = max(least, int(np.partition(self.lower, -k)[-k]) if len(self.lower) >= k else 0, 1)
            unseen = int(self.stands.sum())
            left = np.flatnonzero(self.lower + unseen >= bound)
            missing = unseen - self.seen[left] @ self.stands
            left, missing = (x[self.lower[left] + missing >= bound] for x in (left, missing))
            # a document that was seen nowhere has all of ``unseen`` missing
            if not missing.any():
                return left


def shard_hits(lists: pa.Table, shards: pa.Table, queries: dict, total_docs: int, total_terms: int, k: int, least: dict) -> pa.Table:
    """(query, doc_id, score) of a shard's k best documents of every query."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if lists.num_rows:
        ids = shards["doc_ids"][0].values
        order_of_ids = np.argsort(pc.array_sort_indices(ids, null_placement="at_end").to_numpy())
        n = shards["lengths"][0].values.to_numpy()
        m = 25 + 75 * n * total_docs // total_terms
        term_lists = {}
        for term, w, places, tfs in zip(lists["term"].to_pylist(), lists["w"].to_pylist(), lists["places"], lists["tfs"]):
            at, tf = places.values.to_numpy(), tfs.values.to_numpy().astype(np.int64)
            impacts = w * (1_000_000_000 * tf // (1_000 * tf + 8 * m[at]))
            order = np.argsort(-impacts, kind="stable")
            term_lists[term] = (at[order], impacts[order])
        for query, terms in queries.items():
            own = [(term_lists[t][0], term_lists[t][1] * r) for t, r in terms if t in term_lists]
            own = [x for x in own if x[1][0] > 0]
            if not own or sum(int(x[1][0]) for x in own) < least.get(query, 0):
                continue
            state = Query(own, len(n))
            best = state.search(k, least.get(query, 0))
            best = best[np.lexsort((order_of_ids[best], -state.lower[best]))][:k]
            out.append((np.full(len(best), query), best, state.lower[best]))
    if not out:
        return pa.table({"query": pa.array([], pa.int64()), "doc_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
    query, best, score = (np.concatenate(x) for x in zip(*out))
    return pa.table({"query": pa.array(query), "doc_id": ids.take(pa.array(best)), "score": pa.array(score)})


def _weights(index: Index, terms: DataFrame, small: bool) -> tuple[DataFrame, int, int]:
    """(lists of the query terms with their ``w``, N, L)."""
    sums = index.shards.agg(
        F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("terms"),
        F.sum(F.size(F.filter("lengths", lambda x: x > 0))).alias("docs")).first()
    total_docs, total_terms = sums["docs"] or 0, sums["terms"] or 0
    wanted = terms.select("term").distinct()
    picked = index.lists.join(F.broadcast(wanted) if small else wanted, "term")
    df = picked.groupBy("term").agg(F.sum(F.size("places")).alias("df"))
    w = F.floor(1000 * F.log(F.lit(2.0 * total_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    weights = df.select("term", w.alias("w"))
    return index.lists.join(F.broadcast(weights) if small else weights, "term"), total_docs, total_terms


def search(index: Index, queries: DataFrame, k: int = TOP, id_col: str = "item_id") -> DataFrame:
    """(``id_col``, rank, doc_id, score): the k best documents with a score above 0 of every query."""
    spark = queries.sparkSession
    terms = query_terms(queries, id_col)
    n_terms = terms.count()
    blocks = max(1, -(-n_terms // BLOCK_TERMS))
    found = None
    for block in range(blocks):
        own = terms.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block) if blocks > 1 else terms
        hits = _search_block(index, own, k, n_terms <= BROADCAST_TERMS)
        found = hits if found is None else found.unionByName(hits)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = terms.select("query", F.col("query_id").alias(id_col)).distinct()
    return best.join(names, "query").select(id_col, "rank", "doc_id", "score")


def _search_block(index: Index, terms: DataFrame, k: int, small: bool) -> DataFrame:
    by_query: dict[int, list[tuple[bytes, int]]] = defaultdict(list)
    for r in terms.orderBy("query", "term").toLocalIterator():  # about BLOCK_TERMS rows
        by_query[r["query"]].append((bytes(r["term"]), r["repeats"]))
    lists, total_docs, total_terms = _weights(index, terms, small)

    def hits(lists: DataFrame, shards: DataFrame, least: dict[int, int]) -> DataFrame:
        queries = dict(by_query)

        def run(ours: pa.Table, documents: pa.Table) -> pa.Table:
            return shard_hits(ours, documents, queries, total_docs, total_terms, k, least)

        return keep(lists.groupBy("shard").cogroup(shards.groupBy("in_shard")).applyInArrow(run, HITS), "hits")

    first = index.shards.agg(F.min("in_shard")).first()[0]
    if first is None:
        return index.shards.select(F.col("in_shard").alias("query"), F.col("in_shard").alias("doc_id"), F.col("in_shard").alias("score"))
    least: dict[int, int] = {}
    pilot = hits(lists.where(F.col("shard") == first), index.shards.where(F.col("in_shard") == first), {})
    of_query = Window.partitionBy("query").orderBy(F.desc("score"))
    for r in pilot.withColumn("at", F.row_number().over(of_query)).where(F.col("at") == k).toLocalIterator():  # one row a query
        least[r["query"]] = r["score"]
    rest = hits(lists.where(F.col("shard") != first), index.shards.where(F.col("in_shard") != first), least)
    return pilot.unionByName(rest)
