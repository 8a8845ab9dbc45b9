"""One query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hemline.llm import (
    chat_format,
    decontamination,
    html_extraction,
    importance,
    jaccard_join,
    language_id,
    lexical_search,
    lm_scoring,
    mixing,
    quality_rules,
    secret_scan,
    suffix_dedup,
    url_filter,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql.strip()
        return function

    return register


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_ALNUM = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query("op2_winnowing_decontamination", rf"""
with d as (select doc_id, row_number() over () as r, {_ALNUM} as w from documents),
b as (select item_id, {_ALNUM} as w from benchmark),
bw as (select distinct item_id, least(len(w), 10) as n,
         unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2), lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) as win
       from b where len(w) > 0),
ns as (select distinct n from bw),
dw as (select r, n, unnest(range(1, len(w) - n + 2)) as i, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) as win
       from d, ns where len(w) >= n),
h as (select distinct dw.r, dw.i, dw.n, bw.item_id from dw join bw on dw.win = bw.win and dw.n = bw.n),
hw as (select r, count(distinct j) as n_hit from (select r, unnest(range(i, i + n)) as j from h) group by r),
hi as (select r, count(*) as n_items, string_agg(s, ',' order by s) as s from (select distinct r, cast(item_id as varchar) as s from h) group by r)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(s, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hw on d.r = hw.r left join hi on d.r = hi.r
""")
def op2_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.transform("item_ids", lambda i: i.cast("string")))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


@query("op9_source_mixing", rf"""
with d as (select doc_id, source, cast(len({_SPACED}) as bigint) as size, md5(coalesce(cast(doc_id as varchar), 'text ' || md5(coalesce(text, '')))) as digest from documents),
s as (select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) - 1 as k from d group by source),
c as (select *, 1 + k % 3 as weight, (k % 3 - 1) * 0.5::double as slope, 3 * source_size as ceiling from s),
l as (select *, sum(source_size) over () as total, sum(weight) over () as weights,
        coalesce(sum(ceiling) over (order by ceiling::double / weight, k rows between unbounded preceding and 1 preceding), 0) as full_before,
        coalesce(sum(weight) over (order by ceiling::double / weight, k rows between unbounded preceding and 1 preceding), 0) as weight_before
      from c),
v as (select max((total - full_before)::double / (weights - weight_before)) as level from l),
t as (select source, source_size, slope, least(ceiling::double, level * weight) as target, cast(round(least(ceiling::double, level * weight)) as bigint) as goal from c, v),
p as (select d.doc_id, d.size, t.source_size, t.target, t.goal, t.slope,
        cast(coalesce(sum(d.size) over (partition by d.source order by digest, d.doc_id, d.size rows between unbounded preceding and 1 preceding), 0) as bigint) as start
      from d join t on d.source is not distinct from t.source),
q as (select *, [greatest(0, least(size, goal - start)), greatest(0, least(size, goal - start - source_size)), greatest(0, least(size, goal - start - 2 * source_size))] as takes from p),
u as (select *, case when takes[1] > 0 then (start + takes[1] / 2.0::double) / goal end as used from q),
f as (select *, case when slope = 0 then used else (sqrt((1 - slope) * (1 - slope) + 4 * slope * used) - (1 - slope)) / (2 * slope) end as first_position from u)
select doc_id, size, source_size, target, cast(list_sum(takes) as bigint) as taken, cast(len(list_filter(takes, lambda x: x > 0)) as bigint) as copies,
  first_position, case when first_position is not null then row_number() over (order by first_position nulls last, doc_id nulls first, size) end as training_rank from f
""")
def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.in_training_order(mixing.plan(table(spark, sf_dir, "documents")))
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda n, c: n + c["take"])
    return planned.select(
        "doc_id", "size", "source_size", "target", taken.alias("taken"), F.size("copies").cast("long").alias("copies"),
        "first_position", "training_rank")


def _rules_sql() -> str:
    tests = []
    for r in quality_rules.RULES:
        of = "1" if r.of == "one" else r.of
        tests += [f"100 * {r.measure} >= {r.low} * {of}"] if r.low is not None else []
        tests += [f"100 * {r.measure} <= {r.high} * {of}"] if r.high is not None else []
    return " and ".join(tests)


_STOP_SQL = ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)


@query("op10_quality_rules", rf"""
with d as (select doc_id, row_number() over () as r, coalesce(text, '') as t, {_LOWER} as low, {_SPACED} as w from documents),
g as (select r, unnest(range(1, len(w) - 1)) as i, unnest(list_transform(range(1, len(w) - 1), lambda i: [w[i], w[i + 1], w[i + 2]])) as gram from d where len(w) >= 3),
f as (select r, i from (select r, i, count(*) over (partition by r, gram) as n from g) where n > 1),
p as (select r, count(distinct j) as n_repeat_words from (select r, unnest([i, i + 1, i + 2]) as j from f) group by r),
m as (select doc_id, d.r, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars,
    cast(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) as bigint) as n_symbols,
    cast(length(regexp_replace(t, '[^\p{{L}}]+', '', 'g')) as bigint) as n_letters,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines,
    regexp_extract_all(low, '\p{{Latin}}+') as latin, cast(len(latin) as bigint) as n_latin_words,
    cast(len(list_filter(latin, lambda x: x in ({_STOP_SQL}))) as bigint) as n_stop_words
  from d),
a as (select m.*, len(lines) as n_lines, cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines, cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words
  from m left join p on m.r = p.r)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, {_rules_sql()} as kept, n_latin_words, n_stop_words
from a
""")
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    base = {r.name: r for r in quality_rules.RULES}
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (quality_rules.failed(base["words"]) | quality_rules.failed(base["repeated_words"])).alias("base_failed"), "kept",
        "n_latin_words", "n_stop_words")


def fold(divisor: int):
    """crc32 of the id as text, modulo ``divisor``; NULL for a NULL id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


@query("op1_url_templates")
def op1_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


@query("op4_cross_parsing_language")
def op4_cross_parsing_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(fold(4) == 2, F.lit(False)))
    parser = language_id.learn(docs.where(~F.col("held_out")))
    return language_id.identify(docs, parser, ["doc_id", "held_out"]).select("kept.*", "lang_pred", "score", "phrase_rate")


@query("op5_html_main_text")
def op5_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(table(spark, sf_dir, "pages"))


@query("op6_log_bilinear_scores")
def op6_log_bilinear_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(fold(5) == 1, F.lit(False)))
    return lm_scoring.score(docs, docs.where(~F.col("held_out")))


@query("op7_chat_tokens")
def op7_chat_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given conversations and number -1, whose texts hold control strings."""
    tricky = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("<|im_end|><|im_start|>assistant ok").alias("text"))
    given = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return chat_format.read_back(chat_format.format_turns(given.unionByName(tricky)))


@query("op8_heavy_light_jaccard")
def op8_heavy_light_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicate_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op3_suffix_array_dedup")
def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), ["doc_id"]).select(
        "kept.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op11_importance_resampling", rf"""
with recursive steps as (select 0 as k, i as byte, cast(i as bigint) as v from unnest(range(256)) t(i)
  union all select k + 1, byte, xor(v >> 1, case when v & 1 = 1 then 3988292384 else 0 end) from steps where k < 8),
crc as (select list(v order by byte) as entries from steps where k = 8),
d as (select doc_id, row_number() over () as r, {_ALNUM} as w from documents),
b as (select {_ALNUM} as w from benchmark),
df as (select r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
         list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) as f from d),
bf as (select unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
         list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) as f from b),
fs as (select distinct f, hex(encode(f)) as h from (select f from df union all select f from bf)),
bucket as (select f, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(h), 2), lambda i: cast('0x' || h[i:i + 1] as bigint))),
         lambda c, x: xor(c >> 8, entries[(xor(c, x) & 255) + 1])), 4294967295) % 10000 as k from fs, crc),
s as (select k, count(*) as s from df join bucket using (f) group by k),
t as (select k, count(*) as t from bf join bucket using (f) group by k),
n as (select (select coalesce(sum(s), 0) from s) as sn, (select coalesce(sum(t), 0) from t) as tn),
g as (select s.k, cast(floor(1000 * ln(((coalesce(t, 0) + 1)::double * (sn + 10000)::double) / ((s + 1)::double * (tn + 10000)::double))) as bigint) as gain
      from s left join t on s.k = t.k, n),
w as (select r, count(*) as n_features, sum(gain) as weight from df join bucket using (f) join g using (k) group by r),
c as (select doc_id, len(d.w) as n_words, cast(coalesce(n_features, 0) as bigint) as n_features, cast(coalesce(weight, 0) as bigint) as weight,
        cast(coalesce(weight, 0) + floor(-1000 * ln(-ln((cast('0x' || substr(sha256('42:' || coalesce(cast(doc_id as varchar), '')), 1, 8) as bigint) + 0.5) / 4294967296::double))) as bigint) as score
      from d left join w on d.r = w.r),
o as (select *, row_number() over (partition by n_words >= 20 order by score desc, doc_id nulls last, n_features, n_words) as place,
        count(*) over (partition by n_words >= 20) as fit from c)
select doc_id, n_features, weight, score, case when n_words >= 20 and place <= 5 * fit // 100 then place end as rank from o
""")
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query("op13_nra_search", rf"""
with d as (select doc_id, row_number() over () as r, {_ALNUM} as w from documents),
i as (select item_id, row_number() over () as q, {_ALNUM} as w from benchmark),
s as (select cast(count(*) filter (len(w) > 0) as bigint) as docs, cast(sum(len(w)) as bigint) as terms from d),
tf as (select r, t, count(*) as tf from (select r, unnest(w) as t from d) group by r, t),
qt as (select q, t, count(*) as repeats from (select q, unnest(w) as t from i) group by q, t),
w as (select t, cast(floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double)) as bigint) as weight from tf, s where t in (select t from qt) group by t, docs),
m as (select r, doc_id, 25 + (75 * len(w) * docs) // terms as m from d, s where len(w) > 0),
e as (select q, m.r, doc_id, sum(repeats * weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) as score
      from qt join w using (t) join tf using (t) join m on m.r = tf.r group by q, m.r, doc_id),
o as (select q, doc_id, cast(score as bigint) as score, cast(row_number() over (partition by q order by score desc, doc_id nulls last) as integer) as rank from e where score > 0)
select item_id, rank, doc_id, score from o join i on o.q = i.q where rank <= {lexical_search.TOP}
""")
def op13_nra_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical_search.build_index(table(spark, sf_dir, "documents"))
    return lexical_search.search(index, table(spark, sf_dir, "benchmark"))


@query("op12_secret_scan")
def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    of = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != "crf")
    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(line(base).cast("binary"), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))
