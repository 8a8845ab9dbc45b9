"""Keyword ratios of several requests on one scale, against plain Python; trend ids that stay."""

import json

import pytest
from pyspark.sql import functions as F

from hemline.plans import schemas, trend

SCHEMA = "request string, gender string, keyword_name string, period date, ratio double"


def plain(points):
    """{(gender, request): (group, factor)} by following shared points request by request."""
    held = {}
    for request, gender, word, day, ratio in points:
        if ratio and ratio > 0 and request is not None:
            values = held.setdefault((gender, request), {})
            values[word, day] = max(ratio, values.get((word, day), 0))
    done = {}
    for gender, root in sorted(held):
        if (gender, root) in done:
            continue
        scaled = {(gender, root): 1.0}
        while True:
            value = {}
            for r, f in scaled.items():
                for p, v in held[r].items():
                    value.setdefault(p, []).append(v * f)
            value = {p: sum(v) / len(v) for p, v in value.items()}
            found = {}
            for r in held:
                shared = [p for p in held[r] if p in value]
                if r[0] == gender and r not in scaled and shared:
                    found[r] = sum(value[p] for p in shared) / sum(held[r][p] for p in shared)
            if not found:
                break
            scaled |= found
        top = max(v * f for r, f in scaled.items() for v in held[r].values())
        done |= {r: (root, 100 * f / top) for r, f in scaled.items()}
    return done


def frame(spark, points):
    return spark.createDataFrame(points, "request string, gender string, keyword_name string, d string, ratio double").select(
        "request", "gender", "keyword_name", F.col("d").cast("date").alias("period"), "ratio")


POINTS = [
    # a chain whose smallest request stands at its end, with requests that don't agree on what they share
    ("c", "w", "dress", "2025-01-01", 50.0), ("c", "w", "knit", "2025-01-01", 100.0), ("c", "w", "knit", "2025-01-02", 70.0),
    ("b", "w", "knit", "2025-01-01", 10.0), ("b", "w", "knit", "2025-01-02", 9.0), ("b", "w", "coat", "2025-01-02", 100.0),
    ("d", "w", "coat", "2025-01-02", 30.0), ("d", "w", "knit", "2025-01-02", 4.0), ("d", "w", "hat", "2025-01-02", 100.0),
    ("a", "w", "hat", "2025-01-02", 80.0), ("a", "w", "belt", "2025-01-02", 100.0), ("a", "w", "belt", "2025-01-02", 60.0),
    # others: no shared point, only zeros shared, nothing above zero, another gender, no request
    ("e", "w", "knit", "2025-02-01", 100.0), ("f", "w", "hat", "2025-01-02", 0.0), ("f", "w", "sock", "2025-01-02", 100.0),
    ("g", "w", "hat", "2025-01-02", 0.0), ("h", "w", "hat", "2025-01-02", None), ("a", "m", "hat", "2025-01-02", 25.0),
    (None, "w", "hat", "2025-01-02", 20.0),
]


def test_factors_equal_plain_python(spark):
    got = trend.rescale(frame(spark, POINTS)).collect()
    assert len(got) == len(POINTS)
    wanted = plain(POINTS)
    for r in got:
        group, factor = wanted.get((r.gender, r.request), (r.request, 1.0))
        assert r.group == group and r.factor == pytest.approx(factor)
        assert r.scaled == (None if r.ratio is None else pytest.approx(r.ratio * factor, abs=1e-6))
    assert {r.group for r in got if r.gender == "w" and r.request and r.request in "abcd"} == {"a"}
    assert max(r.scaled for r in got if r.group == "a" and r.gender == "w") == 100


def test_scales_of_consistent_requests_are_found_again(spark):
    true = {f"k{i}": 3.0 * i + 1 for i in range(12)}
    points = []
    for n in range(5):
        words = [f"k{i}" for i in range(2 * n, 2 * n + 4)]
        largest = max(true[w] for w in words)
        points += [(f"r{n}", "w", w, "2025-01-01", 100 * true[w] / largest) for w in words]
    got = trend.rescale(frame(spark, points)).collect()
    assert {r.group for r in got} == {"r0"}
    assert all(r.scaled == pytest.approx(100 * true[r.keyword_name] / true["k11"], abs=1e-5) for r in got)


def test_ranks_within_groups_and_empty_input(spark):
    best = trend.top_keywords_rescaled(frame(spark, POINTS), "2025-01-05", n=2).collect()
    first = {(r.gender, r.group): r.keyword_name for r in best if r.position == 1}
    assert first["w", "a"] == max(("belt", "hat", "coat", "knit", "dress"), key=lambda w: max(
        [p[4] * plain(POINTS)["w", p[0]][1] for p in POINTS if p[1] == "w" and p[2] == w and p[0] and p[0] in "abcd"]))
    assert first["m", "a"] == "hat" and first["w", "f"] == "sock" and first["w", "e"] == "knit"
    assert trend.rescale(frame(spark, POINTS).limit(0)).count() == 0


def test_trend_ids_stay_over_days(spark, tmp_path):
    def results(*words):
        found = [{"title": w, "keyword": [w], "data": [{"period": "2025-01-01", "ratio": "5"}]} for w in words]
        text = json.dumps({"startDate": "2025-01-01", "endDate": "2025-01-02", "timeUnit": "date", "results": found})
        return spark.createDataFrame([(text,)], "v string").select(F.from_json("v", schemas.as_text(schemas.KEYWORD_TREND)).alias("d")).select("d.*")

    def day(*words):
        trend.register_results(results(*words), "men", "trend_ids_test", str(tmp_path / "ids"))
        return {r.keyword_name: r.trend_id for r in trend.keyword_trend(results(*words), "men", "2025-01-02", dictionary="trend_ids_test").collect()}

    first, second = day("a", "b", "c"), day("z", "b", "y")
    assert sorted(first.values()) == [1, 2, 3] and second["b"] == first["b"] and {second["z"], second["y"]} == {4, 5}
