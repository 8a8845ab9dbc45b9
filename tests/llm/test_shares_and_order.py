"""Stop-word shares, positions in training order, and token ids of very long runs."""

import random
import re

import pytest

from hemline.llm import chat_format, mixing, quality_rules

STOPS = set(quality_rules.STOP_WORDS)


def test_stop_words_are_a_share_of_latin_words(spark, documents):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for r in documents.join(quality_rules.measures(documents).select("doc_id", "n_latin_words", "n_stop_words"), "doc_id").collect():
        text = (r["text"] or "").translate(lower)
        if text.isascii():
            words = re.findall("[a-z]+", text)
            assert (r["n_latin_words"], r["n_stop_words"]) == (len(words), sum(w in STOPS for w in words))


def test_scripts_case_and_punctuation(spark):
    texts = [
        (1, "THE, AND! (of) to"), (2, "나는 오늘 학교에 갔다 " * 20), (3, "für den Übermut, der war"), (4, "xq zv " * 30 + "mno"), (5, ""), (6, None)]
    rows = {r["doc_id"]: r for r in quality_rules.judge(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert (rows[1]["n_stop_words"], rows[1]["n_latin_words"]) == (4, 4) and "stop_words" in rows[1]["broken_rules"]
    assert rows[2]["n_latin_words"] == 0 and "stop_words" not in rows[2]["broken_rules"]
    assert (rows[3]["n_stop_words"], rows[3]["n_latin_words"]) == (3, 5)
    assert "stop_words" in rows[4]["broken_rules"] and rows[5]["n_latin_words"] == rows[6]["n_latin_words"] == 0


def test_training_ranks_follow_first_positions(spark, documents):
    rows = mixing.in_training_order(mixing.plan(documents)).collect()
    assert len(rows) == documents.count()
    read = sorted((r for r in rows if r["copies"]), key=lambda r: r["training_rank"])
    assert [r["training_rank"] for r in read] == list(range(1, len(read) + 1))
    assert [r["first_position"] for r in read] == sorted(r["first_position"] for r in read)
    assert all(r["first_position"] == r["copies"][0]["position"] for r in read)
    assert all(r["first_position"] is None and r["training_rank"] is None for r in rows if not r["copies"])
    assert mixing.in_training_order(mixing.plan(documents.limit(0))).count() == 0


def test_rows_without_an_id_spread_and_meet_targets(spark):
    docs = spark.createDataFrame([(None if i % 3 else i, f"w{i % 50} " * (i % 7), "ab"[i % 2]) for i in range(600)], "doc_id long, text string, source string")
    rows = mixing.plan(docs, rows_per_range=20).collect()
    assert len(rows) == 600
    for source in "ab":
        mine = [r for r in rows if r["source"] == source]
        assert abs(sum(c["take"] for r in mine for c in r["copies"]) - mine[0]["target"]) <= 1
    firsts = [r["copies"][0]["position"] for r in rows if r["doc_id"] is None and r["source"] == "a" and r["copies"]]
    assert max(firsts) - min(firsts) > 0.3


@pytest.mark.parametrize("blank", [" ", "\n", " \t", "　", "\x85 "])
def test_long_runs_keep_the_encoders_ids(blank):
    enc, draw = chat_format.encoding(chat_format.TOKENIZERS), random.Random(3)
    word = "".join(draw.choices("abcdefgh,.7한", k=5_000))
    run = blank * 12_000
    for text in (f"some words {word} more words", word, f"a{run}b {run}", f"{run}x", run, f"x {run}\x1c{run} y"):
        assert chat_format.encode(enc, text) == enc.encode_ordinary(text)


def test_runs_that_overflow_the_splitter_come_back():
    enc = chat_format.encoding(chat_format.TOKENIZERS)
    text = "a" + " " * 1_500_000 + "b\n" + "\n" * 1_200_000
    assert enc.decode(chat_format.encode(enc, text)) == text
