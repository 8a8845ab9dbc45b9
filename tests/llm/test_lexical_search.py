"""Ranked search against plain scoring of every document."""

import math
from collections import Counter

import numpy as np
import pytest

from hemline.llm import lexical_search

from .test_importance import words


def scored(docs, queries, k):
    """(item_id, rank, doc_id, score) by scoring every document for every query."""
    terms = [Counter(words(t)) for _, t in docs]
    total_docs, total_terms = sum(bool(c) for c in terms), sum(sum(c.values()) for c in terms)
    df = Counter(t for c in terms for t in c)
    out = []
    for item, text in queries:
        found = []
        for (doc, _), own in zip(docs, terms):
            score = 0
            for t, repeats in Counter(words(text)).items():
                if own[t]:
                    w = math.floor(1000 * math.log((2 * total_docs + 2) / (2 * df[t] + 1)))
                    m = 100 - 75 + (75 * sum(own.values()) * total_docs) // total_terms
                    score += repeats * w * ((1_000_000_000 * own[t]) // (1_000 * own[t] + 8 * m))
            if score:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank + 1, f[3], -f[0]) for rank, f in enumerate(sorted(found, key=lambda f: f[:3])[:k])]
    return sorted(out, key=repr)


def pairs(df, key):
    return [(r[key], r["text"]) for r in df.collect()]


def got(docs, queries, k=10):
    return sorted(map(tuple, lexical_search.search(lexical_search.build_index(docs), queries, k).collect()), key=repr)


@pytest.mark.parametrize("shard_docs, depth, block", [(8_192, 64, 100_000), (3, 1, 5)])
def test_odd_rows_equal_plain_scoring(documents, benchmark, monkeypatch, shard_docs, depth, block):
    """One shard and one step, or shards of three documents, lists read entry by entry, several blocks of queries."""
    monkeypatch.setattr(lexical_search, "SHARD_DOCS", shard_docs)
    monkeypatch.setattr(lexical_search, "FIRST_DEPTH", depth)
    monkeypatch.setattr(lexical_search, "DEEPER", 2)
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", block)
    items = benchmark.unionByName(benchmark.sparkSession.createDataFrame([(1, "dog dog DOG lazy"), (None, "the the hund")], benchmark.schema))
    assert got(documents, items, 3) == scored(pairs(documents, "doc_id"), pairs(items, "item_id"), 3)


def test_given_tables_equal_plain_scoring(spark):
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    assert got(docs.repartition(3), items) == scored(pairs(docs, "doc_id"), pairs(items, "item_id"), 10)


def test_a_large_group_of_equal_documents_is_cut_by_id(spark):
    docs = spark.createDataFrame([(i * 7919 % 500, "alpha beta") for i in range(500)] + [(900, "gamma"), (901, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "beta gamma")], "item_id long, text string")
    rows = got(docs.repartition(4), items)
    assert [r[2] for r in sorted(rows, key=lambda r: r[1])] == [900, *range(9)]


def test_reading_stops_before_the_ends_of_the_lists():
    """NRA reads no deeper than the bounds ask for."""
    n = 10_000
    rare = (np.arange(20), np.full(20, 1_000))
    common = (np.arange(n), np.sort(np.random.default_rng(1).integers(1, 900, n))[::-1])
    state = lexical_search.Query([rare, common], n)
    best = state.search(10, 0)
    assert state.depth < n / 4
    exact = np.zeros(n, np.int64)
    exact[rare[0]] += rare[1]
    exact[common[0]] += common[1]
    assert set(np.lexsort((np.arange(n), -exact))[:10]) <= set(best) and (state.lower[best] == exact[best]).all()


def test_empty_tables(documents, benchmark):
    assert got(documents.limit(0), benchmark) == [] and got(documents, benchmark.limit(0)) == []
    assert got(documents.where("text is null"), benchmark) == []
