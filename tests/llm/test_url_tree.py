"""The template tree against plain Python, at any depth and number of repeats."""

import re
from collections import Counter, defaultdict

from hemline.llm import url_filter


def plain_templates(paths, least=url_filter.MIN_CHILDREN):
    """{(host, segments): template} by walking the tree from its root, without leaving any path early."""
    at = {p: () for p in paths}
    for depth in range(max((len(s) for _, s in paths), default=0)):
        nodes = defaultdict(Counter)
        for (host, segs), template in at.items():
            if len(segs) > depth:
                nodes[host, template][segs[depth]] += 1
        for (host, segs), template in list(at.items()):
            if len(segs) > depth:
                n = nodes[host, template]
                wide = len(n) >= least and sum(n.values()) ** 2 / sum(c * c for c in n.values()) >= least
                at[host, segs] = (*template, "*" if wide else segs[depth])
    return at


def segments(path):
    return tuple(re.sub("[0-9]+", "#", s) for s in path.split("/") if s)  # the urls below hold no long hexadecimal runs


def urls_of_all_kinds():
    urls = [f"http://h/user/name{chr(97 + i % 26)}{chr(97 + i // 26)}/posts/{w}" for i in range(100) for w in ("x", "y")]
    urls += [f"http://h/a/b/c/d/e/f/{kind}/1" for kind in ("good", "bad")] + ["http://h/a/b/c/d/e/f"]
    urls += [f"http://h/a/b/c/d/e/f/deep/er/v{chr(97 + i)}/end" for i in range(20)]
    urls += [f"http://h/few/{w}/z" for w in "abcd"] + [f"http://g/most/{'same' if i < 60 else chr(97 + i % 10)}/p{chr(97 + i % 26)}" for i in range(70)]
    return urls + ["http://h/" + "/".join("s" * 3000), "http://h", None, "no url"]


def test_templates_equal_plain_python_and_ignore_repeats(spark):
    urls = urls_of_all_kinds()
    for times in (1, 5):
        pages = spark.createDataFrame([(i, u) for i, u in enumerate(u for u in urls for _ in range(times))], "page_id long, url string")
        got = url_filter.judge_urls(pages).collect()
        assert len(got) == len(urls) * times
        paths = {(r["host"], segments(r["path"])) for r in got}
        wanted = plain_templates(paths)
        for r in got:
            assert r["template"] == "/" + "/".join(wanted[r["host"], segments(r["path"])])
        of = {urls[r["page_id"] // times]: r["template"] for r in got}
        assert of[urls[0]] == "/user/*/posts/x" and of["http://h/a/b/c/d/e/f"] == "/a/b/c/d/e/f"
        assert of["http://h/a/b/c/d/e/f/good/1"] == "/a/b/c/d/e/f/good/#" != of["http://h/a/b/c/d/e/f/bad/1"]
        assert of["http://h/a/b/c/d/e/f/deep/er/va/end"] == "/a/b/c/d/e/f/deep/er/*/end"
        assert len(of["http://h/" + "/".join("s" * 3000)]) == 6000


def test_given_labels_decide_through_templates(spark):
    pages = spark.createDataFrame([(i, f"http://shop/{k}/n{chr(97 + i)}") for i in range(20) for k in ("ads", "news")] + [(99, None)], "page_id long, url string")
    labels = spark.createDataFrame(
        [(f"http://shop/{k}/m{chr(97 + i)}", k == "ads") for i in range(10) for k in ("ads", "news")] + [("http://shop/ads/x", None), (None, True)],
        "url string, bad boolean")
    got = url_filter.judge_urls(pages, labels=labels).collect()
    assert len(got) == 41
    assert all(r["verdict"] == ("block" if "/ads/" in r["path"] else "allow") for r in got if r["host"])
    without = url_filter.judge_urls(pages, labels=labels.limit(0)).collect()
    assert {r["verdict"] for r in without} == {"allow"}
