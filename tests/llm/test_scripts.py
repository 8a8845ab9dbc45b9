"""Languages of many scripts, whose letters are more than the dense tables hold."""

import random

from hemline.llm import language_id

from .test_texts import SAMPLES


def wide_samples():
    r = random.Random(7)
    out = dict(SAMPLES)
    for name, first, letters in [("c1", 0x4E00, 400), ("c2", 0x4E00 + 400, 400), ("k", 0xAC00, 300), ("r", 0x430, 32), ("x", 0x20000, 200)]:
        words = ["".join(chr(first + r.randrange(letters)) for _ in range(r.randrange(1, 5))) for _ in range(150)]
        out[name] = " ".join(r.choice(words) for _ in range(900))
    return out


def phrases_by_hand(text, sample):
    at = count = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at:at + size + 1] in sample and text[at:at + size] in sample:
            size += 1
        at, count = at + size, count + 1
    return count


def as_text(symbols):
    return "".join(chr(0x100 + s) for s in symbols.tolist())


def test_phrases_are_longest_matches_in_any_script():
    samples = wide_samples()
    parser = language_id.CrossParser.learn(samples)
    texts = [t[k:k + 60] for t in samples.values() for k in (0, 301)] + ["ѣѣѣѣѣѣ", samples["c1"][:9] + "龘the龘龘" + samples["k"][:9]]
    symbols = [parser.symbols(t) for t in texts]
    got = parser.phrases(symbols)
    for i, lang in enumerate(parser.languages):
        sample = as_text(parser.symbols(samples[lang]))
        assert [phrases_by_hand(as_text(s), sample) for s in symbols] == got[:, i].tolist(), lang


def test_scripts_are_told_apart_and_unlearned_ones_are_phrases():
    samples = wide_samples()
    parser = language_id.CrossParser.learn(samples)
    names = [n for n in samples if n not in SAMPLES]
    assert parser.predict([samples[n][1_000:1_200] for n in names])[0] == names
    assert parser.predict(["ѣ" * 200, "龘" * 200, "\U00030000" * 200])[2] == [1.0, 1.0, 1.0]


def test_samples_are_spread_over_the_text(spark):
    docs = spark.createDataFrame([(1, "a" * 900 + "b" * 900, "l"), (2, "short", "l")], "doc_id long, text string, lang string")
    pieces = {r["doc_id"]: r["p"] for r in docs.select("doc_id", language_id.spread_sample(docs["text"], 160).alias("p")).collect()}
    assert len(pieces[1]) <= 160 and pieces[1].count("b") > 60 and pieces[1].count("a") > 60 and pieces[2] == "short"
