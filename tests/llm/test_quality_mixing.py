import hashlib
import re
from collections import Counter

from hemline.llm import mixing, quality_rules

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    words = SPACE.findall(text or "")
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    twice = {g for g, n in Counter(grams).items() if n > 1}
    marked = {j for i, g in enumerate(grams) if g in twice for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if SPACE.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(marked))


def test_measures_equal_plain_python(documents):
    got = quality_rules.measures(documents).collect()
    assert len(got) == documents.count()
    wanted = sorted((r["doc_id"] or 0, *measures(r["text"])) for r in documents.collect())
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted((r["doc_id"] or 0, *(r[n] for n in names)) for r in got) == wanted


def test_rules_name_what_they_reject(spark):
    clean = "The people of the town walked to the market and it was a good day for them."
    texts = [
        (1, " ".join(f"{clean} number{i} was seen" for i in range(8))),
        (2, " ".join(f"token{i}%%%" for i in range(80))), (3, "THE!! " * 100), (4, None), (5, "too short")]
    rows = {r["doc_id"]: r for r in quality_rules.judge(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert "symbols" in rows[2]["broken_rules"] and "stop_words" in rows[3]["broken_rules"]
    assert "repeated_words" in rows[3]["broken_rules"]
    assert not rows[4]["kept"] and not rows[5]["kept"] and "words" in rows[5]["broken_rules"]


def test_measures_need_no_shuffle_and_no_python(documents):
    plan = quality_rules.judge(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_empty_tables(spark, documents):
    none = documents.limit(0)
    assert quality_rules.judge(none).count() == 0
    assert mixing.plan(none).count() == 0


def sizes_of(rows):
    return {r["source"]: r["source_size"] for r in rows}


def test_targets_are_filled_by_weight_under_the_ceiling(spark):
    rows = [(i, "w " * n, s) for i, (s, n) in enumerate([("a", 10), ("a", 20), ("b", 400), ("c", 5), (None, 100), ("d", 0)])]
    got = mixing.plan(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    target = {r["source"]: r["target"] for r in got}
    size = sizes_of(got)
    assert abs(sum(target.values()) - sum(size.values())) < 1e-6
    weights = dict(zip(["a", "b", "c", "d", None], [1, 2, 3, 1, 2]))
    open_sources = [s for s in target if target[s] < 3 * size[s] - 1e-9]
    assert len({round(target[s] / weights[s], 6) for s in open_sources}) == 1
    assert all(target[s] <= 3 * size[s] for s in target)


def test_taken_words_meet_targets_and_reruns_agree(spark, documents):
    for ranges in (1, 4_000):  # many digest ranges, or few
        first = sorted(mixing.plan(documents, rows_per_range=ranges).collect(), key=repr)
        assert first == sorted(mixing.plan(documents.repartition(3), rows_per_range=ranges).collect(), key=repr)
        taken, target = {}, {}
        for r in first:
            assert sum(c["take"] for c in r["copies"]) <= 3 * r["size"]
            taken[r["source"]] = taken.get(r["source"], 0) + sum(c["take"] for c in r["copies"])
            target[r["source"]] = r["target"]
        assert all(abs(taken[s] - target[s]) <= 1 for s in target)


def test_positions_follow_the_schedule(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "abc"[i % 3]) for i in range(900)], "doc_id long, text string, source string")
    rows = mixing.manifest(mixing.plan(docs)).collect()
    assert [r["position"] for r in rows] == sorted(r["position"] for r in rows)
    assert all(0 < r["position"] < 1 for r in rows)
    early = lambda s: sum(r["take"] for r in rows if r["source"] == s and r["position"] < 0.5)
    late = lambda s: sum(r["take"] for r in rows if r["source"] == s and r["position"] >= 0.5)
    assert early("a") > 1.3 * late("a") and late("c") > 1.3 * early("c") and abs(early("b") - late("b")) <= 20


def test_digest_order_is_that_of_the_id(spark):
    docs = spark.createDataFrame([(i, "w", "a") for i in range(20)], "doc_id long, text string, source string")
    rows = mixing.manifest(mixing.plan(docs)).collect()
    assert [r["doc_id"] for r in rows] == sorted(range(20), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
