"""Importance resampling against plain Python."""

import hashlib
import math
import re
from zlib import crc32

import numpy as np
import pytest

from hemline.llm import importance
from hemline.llm.words import word_pieces


def words(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in found]


def features(text):
    w = words(text)
    return [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def counts(texts):
    out = np.zeros(importance.BUCKETS, np.int64)
    for t in texts:
        for f in features(t):
            out[crc32(f.encode()) % importance.BUCKETS] += 1
    return out


def resampled(rows, target, percent, min_words):
    """(doc_id, n_words, n_features, weight, score, rank) of (doc_id, text) rows."""
    s, t = counts(x for _, x in rows), counts(target)
    gain = [math.floor(1000 * math.log((int(b) + 1) * (int(s.sum()) + 10_000) / ((int(a) + 1) * (int(t.sum()) + 10_000)))) for a, b in zip(s, t)]
    out = []
    for doc, text in rows:
        found = features(text)
        weight = sum(gain[crc32(f.encode()) % 10_000] for f in found)
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append((doc, len(words(text)), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[1]))
    drawn = fit[:percent * len(fit) // 100]
    rest = [r for r in out if r[1] < min_words] + fit[len(drawn):]
    return sorted([(*r, k + 1) for k, r in enumerate(drawn)] + [(*r, None) for r in rest], key=repr)


def got(docs, target, **options):
    return sorted(map(tuple, importance.resample(docs, target, **options).collect()), key=repr)


@pytest.mark.parametrize("percent, min_words", [(5, 20), (50, 0), (0, 0)])
def test_odd_rows_equal_plain_python(documents, benchmark, percent, min_words):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    target = [r["text"] for r in benchmark.collect()]
    assert got(documents, benchmark, percent=percent, min_words=min_words) == resampled(rows, target, percent, min_words)


def test_given_tables_equal_plain_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got(docs, target) == resampled(rows, [r["text"] for r in target.collect()], 5, 20)


def test_ties_and_repeated_rows(spark, benchmark, monkeypatch):
    """One id, hence one score, for a third of all rows: as many as fit are drawn, over many ranges."""
    monkeypatch.setattr(importance, "ROWS_PER_RANGE", 3)
    text = "lazy dog and runs far away"
    rows = [(7, text)] * 20 + [(None, text)] * 5 + [(i, f"{text} number {i % 3}") for i in range(35)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = [r["text"] for r in benchmark.collect()]
    for percent in (10, 55):
        found = got(docs.repartition(4), benchmark, percent=percent, min_words=1)
        assert found == resampled(rows, target, percent, 1)
        assert sorted(r[5] for r in found if r[5]) == list(range(1, percent * len(rows) // 100 + 1))


def test_cutoff_is_exact(spark):
    values = [-(2**63), -5, -5, 0, 3, 3, 3, 2**63 - 1]
    rows = spark.createDataFrame([(v,) for v in values], "v long")
    ordered = sorted(values, reverse=True)
    for wanted in (1, 2, 5, 8):
        x, above = importance.cutoff(rows, "v", wanted, values[0], values[-1])
        assert x == ordered[wanted - 1] and above == sum(v > x for v in values)


def test_empty_tables(documents, benchmark):
    assert importance.resample(documents.limit(0), benchmark).count() == 0
    none = importance.resample(documents, benchmark.limit(0))
    assert none.count() == documents.count() and none.where("rank is not null").count() == 0  # fewer than 20 rows with 20 words


def test_pieces_of_a_long_text_give_the_features_of_the_whole(monkeypatch):
    text = "  ".join(f"Wörd{i % 13}-{i % 7}" for i in range(400)) + " end"
    assert [w for p in word_pieces(text, 5) for w in p] == [w.encode() for w in words(text)]
    monkeypatch.setattr(importance, "word_pieces", lambda t: word_pieces(t, 5))
    found = np.zeros(importance.BUCKETS, np.int64)
    for _, buckets in importance.feature_buckets(text):
        found += np.bincount(buckets, minlength=importance.BUCKETS)
    assert (found == counts([text])).all()
