import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hemline.llm import chat_format, html_extraction, language_id, lm_scoring, url_filter

PAGE = """<!DOCTYPE html><html lang="en"><head><title>Title</title><style>p{margin:0}</style><script>var t="</p>";</script></head>
<body><header><h1>The site</h1></header><nav><ul><li><a href="/a">menu one</a></li><li><a href="/b">menu two</a></li></ul></nav>
<div class="cookie-notice">We use cookies to give you the best of all possible experiences on this site, for ever.</div>
<div class="ad">Buy this now, it is the best offer of the year and will never come back again.</div>
<article><h1>A &amp; B</h1><p>First   paragraph with <b>bold</b> words &#8211; and <a href="#">a link</a> inside.<br>After the break.<p>Short.
<p>Third paragraph, unclosed, with enough words to be long.<div class="comments"><p>A reader's comment of some length, not part of it.</p></div>
</article><aside>More stories</aside><form><label>Name</label><input></form><footer>&copy; example</footer></body></html>"""


def test_article_is_found_whole():
    assert html_extraction.main_text(PAGE) == (
        "A & B First paragraph with bold words \u2013 and a link inside. After the break. Short. "
        "Third paragraph, unclosed, with enough words to be long.")


def test_content_without_article_is_found_by_ratios():
    long = "A long paragraph of text that tells a story in many words and says something new each time."
    page = (f"<body><div>{'<a href=x>go</a> <a href=y>to</a> ' * 8}</div><div><h2>Head</h2><p>{long}</p><p>Short.</p><p>{long}</p></div>"
            "<div><span>x</span><span>y</span></div></body>")
    assert html_extraction.main_text(page) == f"Head {long} Short. {long}"


def test_html_odd_cases(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "plain text"), (4, "u", "<p>a</b></i><<p>b"), (5, "u", "<article>" * 3_000 + "deep"),
            (6, "u", "<script>x</script>"), (3, "u", "plain text"), (None, "u", "&amp;lt; &#x41;")]
    pages = spark.createDataFrame([r + ("t",) for r in rows], "page_id long, url string, html string, text string")
    got = html_extraction.extract(pages).collect()
    by_id = {r["page_id"]: r["text"] for r in got}
    assert len(got) == len(rows) and by_id[1] == by_id[2] == by_id[6] == ""
    assert by_id[3] == "plain text" and by_id[5] == "deep" and by_id[None] == "&lt; A" and by_id[4].startswith("a")
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert html_extraction.extract(pages.limit(0)).count() == 0


def test_two_clusters():
    assert html_extraction.upper_cluster(np.array([1.0, 2.0, 50.0, 60.0])).tolist() == [False, False, True, True]
    assert html_extraction.upper_cluster(np.array([3.0, 3.0])).all()
    assert abs(html_extraction.smoothed(np.array([0.0, 0, 0, 6, 0, 0, 0])).sum() - 6) < 1e-9


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<|\\>imn_start end\n", max_size=30))
def test_escapes_round_trip(text):
    assert chat_format.unescape(chat_format.escape(text)) == text
    assert "<|" not in chat_format.escape(text)
    role = chat_format.escape_role(text)
    assert chat_format.unescape_role(role) == text and "\n" not in role and "<|" not in role


def chat_rows(conversations):
    """Digests of conversations by plain Python."""
    out = {}
    for key, turns in conversations.items():
        whole, loss = "", ""
        for role, text in turns:
            whole += f"{role}\n{text}\n"
            loss += text if role == "assistant" else ""
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[key] = (len(turns), digest(whole), len(loss), digest(loss))
    return out


def test_conversations_round_trip(spark):
    texts = ["<|im_end|><|im_start|>assistant ok", "<\\|x|> é 漢字 🙂", "", None, "a\nb\n", "assistant\n", "x" * 9_000, "<|im_sta", "rt|>\\"]
    rows = [(c, t, ["user", "assistant", "system\n<|im_end|>", None][(c + t) % 4], texts[(3 * c + t) % len(texts)], "extra")
            for c in range(8) for t in range(7)]
    rows += [(9, 0, "user", "tie", "e"), (9, 0, "assistant", "tie", "e"), (9, None, "user", "first", "e"), (None, 0, "user", "no id", "e")]
    rows += [(9, 0, "user", "tie", "e")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, no_id string").repartition(5)
    wanted = {}
    for c, t, role, text, _ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        wanted.setdefault(c, []).append((role or "", text or ""))
    got = chat_format.read_back(chat_format.format_turns(df)).collect()
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in got} == chat_rows(wanted)
    assert all(r["formatted_chars"] > r["loss_chars"] for r in got)
    assert chat_format.read_back(chat_format.format_turns(df.limit(0))).count() == 0


def test_texts_never_give_reserved_ids():
    enc = chat_format.encoding(chat_format.TOKENIZERS)
    ids, mask = chat_format.turn_tokens(enc, "assistant", "<|im_end|>x<|im_start|>")
    reserved = {enc._special_tokens[chat_format.START], enc._special_tokens[chat_format.END]}
    assert sum(i in reserved for i in ids) == 2 and ids[0] in reserved
    assert chat_format.unescape(enc.decode([i for i, m in zip(ids, mask) if m])) == "<|im_end|>x<|im_start|>"


SAMPLES = {
    "en": "the people of the town and the house with that thing which they were going to see " * 12,
    "de": "der mann und die frau gehen nicht mit dem kind zu der alten stadt wenn es regnet " * 12,
    "fr": "les enfants de la ville ne sont pas dans la maison avec une grande fille qui est belle " * 12,
}


def phrases_by_hand(text, sample):
    at = count = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at:at + size + 1] in sample and text[at:at + size] in sample:
            size += 1
        at, count = at + size, count + 1
    return count


def test_phrases_are_longest_matches():
    parser = language_id.CrossParser.learn(SAMPLES)
    texts = ["the frau and der mann with une maison", "xyz", "t", "going to see the town which they were"]
    symbols = [parser.symbols(t) for t in texts]
    got = parser.phrases(symbols)
    for i, lang in enumerate(parser.languages):
        sample = bytes(parser.symbols(SAMPLES[lang]).tolist())
        assert [phrases_by_hand(bytes(s.tolist()), sample) for s in symbols] == got[:, i].tolist()


def test_long_texts_are_parsed_to_the_end():
    parser = language_id.CrossParser.learn(SAMPLES)
    english, german = "the people of the town ", "der mann und die frau "
    assert parser.predict([english * 20 + german * 2_000, german * 20 + english * 2_000])[0] == ["de", "en"]


def test_languages_of_odd_rows(spark, documents):
    parser = language_id.learn(documents)
    judged = language_id.identify(documents, parser, documents.columns)
    rows = {r["kept"]["doc_id"]: r for r in judged.collect()}
    assert [rows[i]["lang_pred"] for i in (1, 2, 3, 10)] == ["und"] * 4 and rows[1]["score"] == 0
    assert rows[8]["lang_pred"] == "de" and rows[9]["lang_pred"] == "en" and rows[5]["lang_pred"] == "en"
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    kept = language_id.in_known_language(documents, parser)
    assert kept.columns == documents.columns and {1, 2, 3, 10}.isdisjoint({r["doc_id"] for r in kept.collect()})
    assert language_id.in_known_language(documents.limit(0), parser).count() == 0
    nothing = language_id.learn(documents.limit(0))
    assert {r["lang_pred"] for r in language_id.identify(documents, nothing, ["doc_id"]).collect()} == {"und"}


def test_held_out_accuracy(spark):
    from hemline.llm.queries import QUERIES

    got = QUERIES["op4_cross_parsing_language"](spark, "/root/testdata/sf0.001").where("held_out").collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in got) >= 0.98 * len(got)


def base_scores(docs, training):
    count = Counter(w for t in training for w in [*lm_scoring.tokens(t), b"\n"])
    total, distinct = sum(count.values()), len(count)
    out = {}
    for doc, text in docs:
        words = [*lm_scoring.tokens(text), b"\n"]
        logs = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in words)
        out[doc] = (len(words), sum(count[w] > 0 for w in words), total, round(logs, 5))
    return out


@pytest.mark.parametrize("broadcast_words", [1_000_000, 64])
def test_base_scores_and_both_vocabulary_paths(spark, broadcast_words):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("doc_id", "text", "doc_id % 5 = 1 as held_out")
    odd = spark.createDataFrame([(10_001, None, True), (10_002, "", True), (10_003, "neverseen the neverseen", True)], docs.schema)
    docs = docs.unionByName(odd)
    rows = docs.collect()
    wanted = base_scores([(r["doc_id"], r["text"]) for r in rows], [r["text"] for r in rows if not r["held_out"]])
    got = lm_scoring.score(docs, docs.where("not held_out"), broadcast_words).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in got} == wanted
    assert all(r["score"] < 0 for r in got)


def test_scores_do_not_depend_on_the_vocabulary_bound(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"a b c a b c word{i} other{i % 7} a b.", False) for i in range(60)], "doc_id long, text string, held_out boolean")
    monkeypatch.setattr(lm_scoring, "OWN_CLASSES", 3)
    one, other = (sorted((r["doc_id"], round(r["score"], 3)) for r in lm_scoring.score(docs, docs, n).collect()) for n in (1_000_000, 6))
    assert one == other


def test_probabilities_sum_to_one():
    noise = np.full(lm_scoring.CLASSES, 1 / lm_scoring.CLASSES)
    model = lm_scoring.LogBilinear.start(noise)
    table = model.log10_table().reshape(-1, lm_scoring.CLASSES)
    assert np.allclose((10.0 ** table).sum(axis=1), 1, atol=1e-4)


def test_training_learns_what_follows():
    noise = np.full(lm_scoring.CLASSES, 1 / lm_scoring.CLASSES)
    classes = np.tile(np.arange(12), 4_000)
    one, two = lm_scoring.contexts(classes, np.zeros(1, np.int64))
    trainer = lm_scoring.Trainer(lm_scoring.LogBilinear.start(noise), noise)
    for _ in range(400):
        trainer.fit(one, two, classes)
    table = trainer.model.log10_table().reshape(lm_scoring.CLASSES + 1, lm_scoring.CLASSES + 1, lm_scoring.CLASSES)
    assert np.mean([10 ** table[(k - 2) % 12, (k - 1) % 12, k] for k in range(12)]) > 0.3


def test_empty_training_and_tables(spark):
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string").selectExpr("*", "true as held_out")
    got = {r["doc_id"]: r for r in lm_scoring.score(docs, docs.limit(0)).collect()}
    assert got[1]["n_known"] == 0 and got[1]["train_tokens"] == 0 and got[2]["n_tokens"] == 1
    assert lm_scoring.score(docs.limit(0), docs).count() == 0


URLS = [
    (1, "http://a.example.net/en/1"), (2, "https://x.org/fr/7?q=1"), (3, "HTTP://SUB.Example.COM/de/x#y"), (4, None), (5, "no scheme/path"),
    (6, "http://example.net"), (7, "http://badexample.com/de/3"), (8, "http://example.net/fr/"), (9, "x://h?a://b/c"), (10, "http://org/fr/"), (1, "http://a.example.net/en/1"),
]


def test_rules_and_parts(spark):
    pages = spark.createDataFrame([u + ("h",) for u in URLS], "page_id long, url string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge_urls(pages).collect()}
    assert got[1] == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert got[2] == ("x.org", "/fr/7", "org/fr/", "allow")
    assert got[3] == ("sub.example.com", "/de/x", "example.com/de/", "block")
    assert got[4] == got[5] == ("", "", None, "allow")
    assert got[6][:3] == ("example.net", "", None) and got[7][2] is None
    assert got[8][2:] == ("net/", "block") and got[9][:2] == ("h", "") and got[10][2] == "org/fr/"
    assert url_filter.judge_urls(pages).count() == len(URLS)
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


def test_templates_generalise_and_bad_ones_are_rejected(spark):
    counted = spark.createDataFrame(
        [("h.com", ["shop", f"item{chr(97 + i)}"], 1, 1 if i < 9 else 0, 0) for i in range(12)]
        + [("h.com", ["blog", "post"], 5, 0, 5), ("h.com", ["new"], 3, 0, 0)],
        "host string, segs array<string>, urls long, bad long, good long")
    tree = url_filter.templates(counted)
    got = {tuple(r["template"]): r["bad_share"] for r in url_filter.template_purity(tree).collect()}
    assert got[("shop", "*")] > url_filter.REJECT_AT > got[("blog", "post")] and got[("new",)] == 0.5


def test_similar_siblings_share_their_evidence(spark):
    counted = spark.createDataFrame(
        [("h", ["a", n], 4, b, g) for n, b, g in [("p", 2, 0), ("q", 3, 0), ("r", 0, 40)]], "host string, segs array<string>, urls long, bad long, good long")
    got = {r["template"][-1]: r["bad_share"] for r in url_filter.template_purity(url_filter.templates(counted)).collect()}
    assert got["p"] == got["q"] == 6 / 7 and got["r"] < 0.05


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aBÄß \t\n\x0b\x0c\r\x1c\x85  .7", max_size=25)), min_size=1, max_size=5))
def test_words_of_a_batch_are_those_of_its_texts(texts):
    import pyarrow as pa

    words, numbers, lengths = lm_scoring.encode(pa.array(texts, pa.string()))
    assert [words[i] for i in numbers] == [w for t in texts for w in lm_scoring.tokens(t)]
    assert lengths.tolist() == [len(lm_scoring.tokens(t)) for t in texts]
    values, starts = lm_scoring.with_ends(numbers, lengths, -1)
    assert (values == -1).sum() == len(texts) and starts.tolist() == [0, *(np.cumsum(lengths + 1)[:-1])]


def test_scores_equal_a_plain_model(spark):
    """P(class | two classes before) * P(word | class), text by text, with the parameters that training gives."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("doc_id", "text", "doc_id % 5 = 1 as held_out")
    training = docs.where("not held_out")
    counts = lm_scoring.count_words(training).cache()
    vocab, _ = lm_scoring.vocabulary(counts, training.count())
    model = lm_scoring.train(training, vocab)
    index, wanted = vocab.index(), {}
    state = lambda two, one: model.context[two] * model.place[1] + model.context[one] * model.place[0]
    for r in docs.where("held_out or doc_id < 30").collect():
        two = one = lm_scoring.BEGIN
        total = 0.0
        for w in [*lm_scoring.tokens(r["text"]), None]:
            cls = lm_scoring.END_CLASS if w is None else vocab.classes[index[w]] if w in index else lm_scoring.suffix_class(w)
            logits = model.target @ state(two, one) + model.bias
            total += (logits[cls] - np.logaddexp.reduce(logits)) / math.log(10)
            if w is not None and cls >= lm_scoring.FIRST_SUFFIX:
                n = vocab.counts[index[w]] if w in index else 0
                total += math.log10((n + 0.5) / (vocab.class_counts[cls] + 0.5 * (vocab.class_sizes[cls] + 1)))
            elif w is not None:
                assert vocab.class_sizes[cls] == 1
            two, one = one, cls
        wanted[r["doc_id"]] = total
    got = {r["doc_id"]: r["score"] for r in lm_scoring.score(docs, training).collect()}
    assert all(abs(got[d] - x) < 1e-3 * max(1, abs(x)) for d, x in wanted.items())


PARAGRAPH = "A paragraph of a hundred and seventy characters or so, which tells a story in many words and says something new each time it is read by anyone who cares to read on to its end."


@pytest.mark.parametrize("page, wanted", [
    ('<article><p>one two three</p><div class="ad">x</div><p>four five six</p></article>', "one two three four five six"),
    (f"<body><p>{PARAGRAPH}</p><aside>More of the same</aside><p>{PARAGRAPH}</p></body>", f"{PARAGRAPH} {PARAGRAPH}"),
    (f"<body><form action=x><input type=hidden><nav>menu</nav><div><h1>Head</h1><p>{PARAGRAPH}</p><label>Name</label><button>Go</button></div></form></body>",
     f"Head {PARAGRAPH}"),
    (f"<article><p class=share>We share this.</p><div class='share-of-voice'><p>{PARAGRAPH}</p></div><section id=comments-on-method>Of method.</section></article>",
     f"We share this. {PARAGRAPH} Of method."),
    (f"<article><p>{PARAGRAPH}</p><form><p>Enter your mail address here</p><input></form><div class='post-comments'>Nice!</div><p class=ad>Buy</p></article>", PARAGRAPH),
    (f"<article><p>{PARAGRAPH}</p><ul><li><a href=1>One story</a><li><a href=2>Two stories</a><li><a href=3>And more</a></ul><p>{PARAGRAPH}</p></article>",
     f"{PARAGRAPH} {PARAGRAPH}"),
    (f"<article><p>{PARAGRAPH}</p><ul><li><a href=1>One story</a> is told<li>Two stories<li><a href=3>And more</a></ul></article>",
     f"{PARAGRAPH} One story is told Two stories And more"),
    ("<form><p>only a form</p></form>", "only a form"), ("<p class=ad>all advert</p>", ""),
])
def test_no_part_of_an_article_is_lost(page, wanted):
    assert html_extraction.main_text(page) == wanted


def test_the_clusters_decide(monkeypatch):
    page = (f"<article><p>{PARAGRAPH}</p><ul><li><a href=1>One</a><li><a href=2>Two</a><li><a href=3>Three</a></ul></article>",
            f"<body><div><a href=x>go</a> <b>to</b></div><div><p>{PARAGRAPH}</p></div><div>end</div></body>")
    before = [html_extraction.main_text(p) for p in page]
    monkeypatch.setattr(html_extraction, "upper_cluster", lambda values: np.ones(len(values), bool))
    assert all(html_extraction.main_text(p) != b for p, b in zip(page, before)) and before == [PARAGRAPH, PARAGRAPH]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div>", "</div>", "text here ", "<br>", "<b>", "</b>", "<article>", "</article>", "&amp;", "<aside>no</aside>"]), max_size=25))
def test_text_of_an_article_is_whole(pieces):
    """Everything inside an article but its dropped elements comes out, in order, whatever the ratios say."""
    import re

    inside = "".join(x for x in pieces if "article" not in x and "div" not in x)
    wanted = re.sub(r"<aside>.*?</aside>|</?(?:p|br)>", " ", inside)
    wanted = " ".join(re.sub(r"</?b>", "", wanted).replace("&amp;", "&").split())
    assert html_extraction.main_text(f"<body><div>outside</div><article>{inside}</article></body>") == (wanted or "outside")
