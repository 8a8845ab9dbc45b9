import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hemline.llm import jaccard_join, suffix_dedup
from hemline.llm.jaccard_join import list_keys, shingle_hashes


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set()


def groups(rows):
    """doc_id -> (set size, smallest linked doc_id)."""
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= 90 * len(a | b):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return sorted((i, len(s), find(i)) for i, s in sets)


def variants(seed, count, sizes):
    """Texts of many sizes with copies that differ in a few words."""
    r, out = random.Random(seed), []
    for k in range(count):
        words = [f"w{r.randrange(400)}" for _ in range(r.choice(sizes))]
        out.append(words)
        for _ in range(r.randrange(4)):
            copy = list(r.choice(out[-3:]))
            for _ in range(r.randrange(4)):
                at = r.randrange(len(copy) + 1)
                copy[at:at + r.randrange(2)] = [f"v{r.randrange(50)}"] * r.randrange(2)
            out.append(copy)
    return [(i, " ".join(w)) for i, w in enumerate(out)]


@pytest.mark.parametrize("piece, bound", [(400_000, 500_000), (300, 0)])
def test_groups_equal_brute_force(spark, piece, bound):
    rows = variants(3, 60, [1, 2, 3, 8, 11, 12, 13, 20, 21, 22, 23, 30, 60, 150, 400])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = jaccard_join.near_duplicate_groups(docs, piece, bound).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == groups(rows)


def test_large_group_of_near_copies(spark):
    r = random.Random(1)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(120):
        copy = list(base)
        for _ in range(r.randrange(4)):
            copy[r.randrange(150)] = f"x{r.randrange(10_000)}"
        rows.append((i, " ".join(copy)))
    got = jaccard_join.near_duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string"), 2_000).collect()
    assert sorted((x["doc_id"], x["n_shingles"], x["component_id"]) for x in got) == groups(rows)


@settings(max_examples=150, deadline=None)
@given(st.integers(9, 90), st.integers(0, 5), st.integers(0, 5), st.integers(0, 10**6))
def test_linked_sets_share_a_list(size, only_a, only_b, seed):
    r = random.Random(seed)
    common = [f"{r.random()}" for _ in range(size)]
    a, b = common + [f"a{i}" for i in range(only_a)], common + [f"b{i}" for i in range(only_b)]
    hashes = [jaccard_join.np.unique(jaccard_join.np.concatenate([shingle_hashes([w.encode()]) for w in x])) for x in (a, b)]
    if 100 * size >= 90 * (size + only_a + only_b):
        assert set(list_keys(hashes[0]).tolist()) & set(list_keys(hashes[1]).tolist())


def test_odd_rows_and_empty_table(documents):
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicate_groups(documents).collect()}
    assert {(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4)} <= got
    assert {c for i, _, c in got if i in (5, 6, 7)} == {5}
    assert jaccard_join.near_duplicate_groups(documents.limit(0)).count() == 0


def test_one_of_each_group_stays(documents):
    left = jaccard_join.one_of_each_group(documents)
    assert left.columns == documents.columns
    ids = [r["doc_id"] for r in left.collect()]
    assert sorted(i for i in ids if i) == [1, 2, 3, 4, 5, 8, 9, 10, 11, 12] and ids.count(None) == 1


def without_repeats(rows, length=200):
    data = [(t or "").encode() for _, t in rows]
    seen = {}
    for b in data:
        for i in range(len(b) - length + 1):
            seen[b[i:i + length]] = seen.get(b[i:i + length], 0) + 1
    out = []
    for (doc, _), b in zip(rows, data):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i, x in enumerate(gone) if x and not (i and gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((doc or 0, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def removed(docs, **options):
    got = suffix_dedup.remove_repeats(docs, ["doc_id"], **options).collect()
    return sorted((r["kept"]["doc_id"] or 0, r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got)


@pytest.mark.parametrize("options", [{}, {"piece": 2}])
def test_removed_bytes_equal_brute_force(spark, options):
    r = random.Random(5)
    letters = lambda n: "".join(r.choice("abcdeé ") for _ in range(n))
    passages = [letters(n) for n in (190, 199, 200, 201, 230, 320, 700)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(r.randrange(5)):
            p = r.choice(passages)
            a, b = sorted((r.randrange(len(p)), r.randrange(len(p) + 1)))
            parts += [letters(r.randrange(300)), r.choice([p, p, p[a:b], p[a:]])]
        rows.append((i, "".join(parts)))
    rows += [(100, "ab" * 500), (101, "a" * 260), (102, rows[3][1]), (103, None), (104, "")]
    assert removed(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), **options) == without_repeats(rows)


def test_odd_rows_of_repeats(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert removed(documents) == without_repeats(rows)
    assert removed(documents.limit(0)) == []


def test_stage_cuts_texts_and_keeps_columns(documents):
    left = suffix_dedup.without_repeats(documents)
    assert left.columns == documents.columns
    rows = {r["doc_id"]: r for r in left.collect()}
    assert rows[1]["text"] is None and rows[4]["text"] == "One." and rows[6]["text"] == "" and rows[6]["n_chars"] == 0
    assert rows[8]["text"] == "" or "hund" in rows[8]["text"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=60))
def test_suffix_array_is_sorted(symbols):
    text = [*symbols, 0]
    assert suffix_dedup.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=1, max_size=40))
def test_groups_hold_longest_lyndon_prefixes(symbols):
    text = [*symbols, 0]

    def lyndon_prefix(i):
        return max((text[i:j] for j in range(i + 1, len(text) + 1) if all(text[i:j] < text[k:j] for k in range(i + 1, j))), key=len)

    group, _ = suffix_dedup.lyndon_groups(text)
    prefixes = [lyndon_prefix(i) for i in range(len(text))]
    assert [group[i] for i in range(len(text))] == [sum(p < prefixes[i] for p in prefixes) for i in range(len(text))]
