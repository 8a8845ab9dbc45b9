"""The near-duplicate join under other rules than three words and 90/100."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from hemline.llm import jaccard_join
from hemline.llm.common import keep

from .test_pairs import variants

RULES = [(3, 90), (5, 80), (2, 50)]


def shingles(text, length):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + length]) for i in range(len(w) - length + 1)} if len(w) >= length else {tuple(w)} if w else set()


def groups(rows, length, percent):
    """(doc_id, set size, smallest linked doc_id), by comparing all pairs."""
    sets = [(i, shingles(t, length)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return sorted((i, len(s), find(i)) for i, s in sets)


@pytest.mark.parametrize("length, percent", RULES)
def test_groups_equal_brute_force(spark, length, percent):
    rows = variants(4, 60, [1, 2, 4, 5, 6, 9, 12, 13, 14, 15, 20, 24, 30, 60, 150, 400])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = jaccard_join.near_duplicate_groups(docs, 2_000, words=length, percent=percent).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == groups(rows, length, percent)


def test_scattered_edits_go_under_five_words_and_80(spark):
    words = [f"w{i}" for i in range(304)]
    edited = [f"x{i}" if i in range(20, 300, 50) else w for i, w in enumerate(words)]
    rows = [(1, " ".join(words)), (2, " ".join(edited)), (3, " ".join(words[::-1]))]
    assert [g for *_, g in groups(rows, 5, 80)] == [1, 1, 3] and [g for *_, g in groups(rows, 3, 90)] == [1, 2, 3]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = corpus_pipeline.one_of_near_duplicates(spark, docs, "", words=5, percent=80).collect()
    assert sorted(r["doc_id"] for r in left) == [1, 3]


@settings(max_examples=300, deadline=None)
@given(st.sampled_from(RULES), st.integers(1, 400), st.integers(0, 100), st.integers(0, 100), st.integers(0, 10**6))
def test_linked_sets_share_a_list(rule, size, only_a, only_b, seed):
    _, percent = rule
    room = size * (100 - percent) // percent  # most shingles outside the common ones
    only_a = min(only_a, room)
    only_b = min(only_b, room - only_a)
    r = np.random.default_rng(seed)
    common, a, b = (r.integers(0, 1 << 63, n, dtype=np.uint64) for n in (size, only_a, only_b))
    one, two = np.unique(np.concatenate([common, a])), np.unique(np.concatenate([common, b]))
    shared = set(jaccard_join.list_keys(one, percent).tolist()) & set(jaccard_join.list_keys(two, percent).tolist())
    assert 100 * size < percent * (size + only_a + only_b) or shared


def test_codes_tell_all_shingles_apart():
    r = random.Random(2)
    texts = [" ".join(f"w{r.randrange(n)}" for _ in range(size)) for n, size in [(3, 50), (90_000, 40_000), (90_000, 40_000), (5, 4), (2, 0)]]
    for length in (3, 5, 8):
        sets = [shingles(t, length) for t in texts]
        coded = jaccard_join._exact_sets(texts, length)
        assert [len(c) for c in coded[:4]] == [len(s) for s in sets[:4]]
        assert len(np.unique(np.concatenate(coded[:4]))) == len(set().union(*sets[:4]))


def test_lists_are_shuffled_once_and_not_written(spark, monkeypatch):
    r = random.Random(6)
    rows = [(i, " ".join(f"w{r.randrange(10**6)}" for _ in range(300))) for i in range(200)]
    rows += [(1_000 + i, t + " x") for i, t in rows[:5]]
    written = {}

    def noted(df, label):
        written[label] = (df.dtypes, df._jdf.queryExecution().executedPlan().toString())
        return keep(df, label)

    monkeypatch.setattr(jaccard_join, "keep", noted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.near_duplicate_groups(docs, words=5, percent=80).collect()
    assert sorted((x["doc_id"], x["n_shingles"], x["component_id"]) for x in got) == groups(rows, 5, 80)
    assert not [label for label, (types, _) in written.items() if any(t.startswith("array") for _, t in types)]
    assert written["hub-members"][1].count("Exchange hashpartitioning(key#") == 1
