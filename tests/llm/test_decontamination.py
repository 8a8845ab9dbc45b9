import re

import pytest

from hemline.llm import decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items, span=10):
    doc, hit, found = words(text), set(), set()
    for item, item_text in items:
        w = words(item_text)
        n = min(span, len(w))
        windows = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()
        for i in range(len(doc) - n + 1):
            if windows and tuple(doc[i:i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add(item)
    return len(doc), len(hit), sorted(found)


@pytest.mark.parametrize("bound", [200_000, 0])
def test_equals_brute_force(documents, benchmark, bound, monkeypatch):
    monkeypatch.setattr(decontamination.hits, "__defaults__", (10, 5, bound))
    items = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    got = decontamination.decontaminate(documents, benchmark).collect()
    assert len(got) == documents.count()
    wanted = sorted((r["doc_id"] or 0, *brute(r["text"], items)) for r in documents.collect())
    assert sorted((r["doc_id"] or 0, r["n_words"], r["n_hit"], sorted(r["item_ids"])) for r in got) == wanted
    assert all(r["contaminated"] == (r["n_hit"] > 0) for r in got)


def test_every_place_of_a_planted_window(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"
    passage = item.split()[2:12]
    filler = [f"f{i}" for i in range(40)]
    docs = [(i, " ".join(filler[:i] + passage + filler[i:] + passage)) for i in range(40)] + [(99, " ".join(filler + passage[:9]))]
    got = decontamination.decontaminate(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([("q", item)], "item_id string, text string")).collect()
    assert {r["doc_id"]: r["n_hit"] for r in got} == {**{i: 20 for i in range(40)}, 99: 0}


def test_empty_tables(documents, benchmark):
    assert decontamination.decontaminate(documents.limit(0), benchmark).count() == 0
    none = decontamination.decontaminate(documents, benchmark.limit(0)).collect()
    assert len(none) == documents.count() and not any(r["contaminated"] for r in none)


def test_clean_rows_keep_all_columns(documents, benchmark):
    left = decontamination.clean_documents(documents, benchmark)
    assert left.columns == documents.columns
    assert {r["doc_id"] for r in left.collect()} == {1, 2, 3, 4, 8, 9, 10, 11, 12, None}


def test_capitals_beyond_ascii_stay(spark):
    docs = spark.createDataFrame([(1, "ÄPFEL Und Birnen")], "doc_id long, text string")
    hit = lambda t: decontamination.decontaminate(docs, spark.createDataFrame([(1, t)], "item_id long, text string")).first()["n_hit"]
    assert hit("Äpfel UND birnen") == 3 and hit("äpfel und birnen") == 0
