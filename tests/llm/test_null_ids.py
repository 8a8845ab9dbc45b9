"""Rows without an id on texts that are copied, near-copied and contaminated."""

import pytest

from hemline.llm import decontamination, jaccard_join

WORDS = [f"w{i}" for i in range(60)]
TEXT, NEAR = " ".join(WORDS), " ".join(WORDS[:-1])
OTHER, OTHER_NEAR = " ".join(WORDS[::-1]), " ".join(WORDS[:1:-1])


@pytest.mark.parametrize("bound", [500_000, 0])
def test_copies_without_an_id_keep_the_links_of_their_text(spark, bound):
    rows = [(None, TEXT), (7, TEXT), (8, TEXT), (None, TEXT), (3, NEAR), (None, OTHER), (None, OTHER), (5, OTHER_NEAR), (9, "a b c d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = jaccard_join.near_duplicate_groups(docs, broadcast_rows=bound).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"]) for r in got) == [
        (0, 3), (0, 3), (0, 5), (0, 5), (3, 3), (5, 5), (7, 3), (8, 3), (9, 9)]


def test_near_copies_of_a_text_that_also_occurs_without_an_id_go(spark):
    docs = spark.createDataFrame([(None, TEXT), (7, TEXT), (3, NEAR)], "doc_id long, text string")
    assert [r["doc_id"] for r in jaccard_join.one_of_each_group(docs).collect() if r["doc_id"]] == [3]


@pytest.mark.parametrize("bound", [200_000, 0])
def test_contaminated_rows_without_an_id_are_found(spark, bound, monkeypatch):
    monkeypatch.setattr(decontamination.hits, "__defaults__", (10, 5, bound))
    rows = [(None, TEXT), (None, TEXT), (1, TEXT), (1, TEXT), (None, OTHER), (2, OTHER), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(WORDS[5:17]))], "item_id long, text string")
    got = decontamination.decontaminate(docs, items).collect()
    assert sorted((r["doc_id"] or 0, r["n_hit"]) for r in got) == [(0, 0), (0, 0), (0, 12), (0, 12), (1, 12), (1, 12), (2, 0)]
    left = decontamination.clean_documents(docs, items).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in left) == [(0, ""), (0, OTHER), (2, OTHER)]
