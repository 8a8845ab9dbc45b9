"""Quality rules: a table of thresholds compiled into one projection.

Every rule compares two measures of a document, ``low * of <= 100 * measure <= high * of``, in
whole numbers. All measures are built-in expressions over the row, so there is no shuffle and
no user function, and a very long text costs one task the sorting of its own three-word windows.

NULL and empty texts have no words and fail. Extra columns, whatever their names, are ignored;
repeated rows are judged one by one; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemline.llm.common import SPACE, ascii_lower

#: Frequent function words by language, all in Latin script.
STOP_WORDS_OF = {
    "English": "the of and to in is that for it with as on be this by",
    "German": "der die und den von zu das mit sich des auf für ist im dem nicht ein",
    "Spanish": "de la que el en y los del se las por un para con no una",
    "French": "le et les des un une du est dans qui que pour au sur",
    "Italian": "di che la il un per non una sono gli della con",
    "Portuguese": "de que do da em um para com uma os no na por mais",
    "Dutch": "de het een van en in is dat op te zijn voor met niet",
}
STOP_WORDS = tuple(sorted({word for words in STOP_WORDS_OF.values() for word in words.split()}))


@dataclass(frozen=True)
class Rule:
    """``low`` and ``high`` are percent of the measure ``of``; None leaves the side open."""

    name: str
    measure: str
    of: str
    low: int | None = None
    high: int | None = None


#: Lengths, symbols, stop words and lines. ``one`` is the number 1. Stop words are a share of the words in Latin
#: script, the script of all listed languages: a text in another script has none and passes this rule.
RULES = (
    Rule("words", "n_words", "one", low=5_000),
    Rule("repeated_words", "n_repeat_words", "n_words", high=50),
    Rule("word_length", "word_chars", "n_words", low=200, high=1_500),
    Rule("symbols", "n_symbols", "n_words", high=30),
    Rule("letters", "n_letters", "word_chars", low=60),
    Rule("stop_words", "n_stop_words", "n_latin_words", low=2, high=90),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=50),
)


def _repeat_words(grams: Column) -> Column:
    """Words covered by the three-word windows whose 64-bit hash occurs twice or more."""
    placed = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    last = F.size(grams) - 1

    def positions(ordered: Column) -> Column:
        twice = F.filter(ordered, lambda e, k: F.when(
            k > 0, ordered[k - 1]["g"] == e["g"]).otherwise(False) | F.when(
            k < last, ordered[k + 1]["g"] == e["g"]).otherwise(False))
        return F.array_sort(F.transform(twice, lambda e: e["i"]))

    start = F.struct(F.lit(-3).alias("at"), F.lit(0).alias("n"))
    covered = lambda at: F.aggregate(
        at, start, lambda acc, p: F.struct(p.alias("at"), (acc["n"] + F.least(F.lit(3), p - acc["at"])).alias("n")),
        lambda acc: acc["n"])
    # a one-element array binds the sorted windows, so that they are sorted once
    return F.transform(F.array(placed), lambda ordered: covered(positions(ordered)))[0]


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measures of every row: id, n_words, word_chars, n_symbols, n_letters, n_lines, n_dup_lines,
    n_repeat_words, and among runs of Latin letters (A-Z lower-cased, so punctuation around a word doesn't hide
    it) n_latin_words and n_stop_words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    pieces = docs.select(F.col(id_col), text.alias("text"), F.split(text, SPACE).alias("pieces"))
    words = pieces.select(
        id_col, "text", F.array_remove("pieces", "").alias("words"),
        (F.length("text") - F.size("pieces") + 1).cast("long").alias("word_chars"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    grams = words.select(
        id_col, "text", "word_chars", F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.array_remove(F.split(ascii_lower(F.col("text")), r"[^\p{IsLatin}]+"), "").alias("latin"),
        F.when(F.size("words") >= 3, F.transform(
            F.sequence(F.lit(0), F.size("words") - 3),
            lambda i: F.xxhash64(F.col("words")[i], F.col("words")[i + 1], F.col("words")[i + 2]),
        )).otherwise(F.array().cast("array<bigint>")).alias("grams"),
    )
    return grams.select(
        id_col, "n_words", "word_chars", "n_lines", "n_dup_lines",
        F.size("latin").cast("long").alias("n_latin_words"),
        F.size(F.filter("latin", lambda word: word.isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("text", r"[^\p{L}]+", "")).cast("long").alias("n_letters"),
        F.when(F.size(F.array_distinct("grams")) == F.size("grams"), F.lit(0))
        .otherwise(_repeat_words(F.col("grams"))).cast("long").alias("n_repeat_words"),
    )


def failed(rule: Rule) -> Column:
    """Whether a row of measures breaks the rule."""
    of = F.lit(1) if rule.of == "one" else F.col(rule.of)
    broken = F.lit(False)
    if rule.low is not None:
        broken = broken | (100 * F.col(rule.measure) < rule.low * of)
    if rule.high is not None:
        broken = broken | (100 * F.col(rule.measure) > rule.high * of)
    return broken


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The measures of every row, the names of the rules it breaks, and ``kept``."""
    broken = F.filter(F.array(*[F.when(failed(r), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())
    return measures(docs, id_col, text_col).withColumn("broken_rules", broken).withColumn("kept", F.size("broken_rules") == 0)
