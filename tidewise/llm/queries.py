"""Registered queries of the corpus operators: each applies its operator with
production parameters to its whole table, and derives the result columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from . import (
    exact_dedup,
    html_text,
    kneser_ney,
    lexical_search,
    mixing,
    ngram_join,
    packing,
    periodic_runs,
    pii,
    quality_rules,
    records,
    sentence_spans,
    toxicity,
)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return register


@query("op1_fair_queue_mix", r"""
with d as (select doc_id, source, md5(coalesce(doc_id::varchar, '')) as m,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size from documents),
s as (select source, sum(size)::hugeint as words,
    [5, 2, 1][((row_number() over (order by source is null, source) - 1) % 3 + 1)::int]::hugeint as w from d group by source),
o as (select *, row_number() over p as i, sum(words) over () - coalesce(sum(3 * words) over b, 0) as rest,
    sum(w) over () - coalesce(sum(w) over b, 0) as rest_w
  from s window p as (order by words::double / w, source is null, source),
    b as (order by words::double / w, source is null, source rows between unbounded preceding and 1 preceding)),
f as (select min(i) as i, arg_min(rest, i) as rest, arg_min(rest_w, i) as rest_w from o where w * rest <= 3 * words * rest_w),
t as (select o.source, o.words, case when o.i < f.i then (3 * o.words)::double
    else (o.w * f.rest)::double / f.rest_w::double end as target from o, f),
q as (select d.*, t.words::bigint as source_size, t.target, sum(d.size) over (partition by d.source
    order by d.m, d.doc_id, d.size rows unbounded preceding)::bigint as served
  from d join t on d.source is not distinct from t.source)
select doc_id, size, source_size, target,
  (case when size > 0 and target > 0 then size * (
    (case when 2 * served - size <= 2 * target then 1 else 0 end)
    + (case when 2 * (served + source_size) - size <= 2 * target then 1 else 0 end)
    + (case when 2 * (served + 2 * source_size) - size <= 2 * target then 1 else 0 end)) else 0 end)::bigint as taken,
  case when target <> 0 then served::double / target end as virtual_finish from q""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents"))


@query("op7_exact_dedup", """
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
  doc_id = max(doc_id) over g as kept, sha256(coalesce(text, '')) as text_sha256
from documents window g as (partition by coalesce(text, ''))""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_map(table(spark, sf_dir, "documents"))


@query("op9_ngram_jaccard_join", r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct doc_id, g from (select doc_id, unnest(case when len(w) >= 3 then list_transform(range(1, len(w) - 1),
    lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) when len(w) > 0 then [array_to_string(w, ' ')]
    else []::varchar[] end) as g from w) x),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as x, b.doc_id as y, count(*) as shared from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
l as (select x, y from p join n a on a.doc_id = x join n b on b.doc_id = y where 100 * shared >= 90 * (a.n + b.n - shared)),
e as (select x, y from l union all select y, x from l),
r as (select doc_id, doc_id as seen from documents union select r.doc_id, e.y from r join e on e.x = r.seen)
select doc_id, coalesce(any_value(n.n), 0)::bigint as n_shingles, min(seen) as component_id
from r left join n using (doc_id) group by doc_id""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_components(table(spark, sf_dir, "documents"), k=3, percent=90)


@query("op4_best_fit_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query("op10_compression_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_composite_density")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query("op2_kneser_ney_perplexity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.perplexities(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_sentence_spans")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentence_spans.remove_repeats(docs)


def _op6_sql() -> str:
    classes = [quality_rules.CLASSES[k] for k in quality_rules.CLASSES]
    counts = ", ".join("len(regexp_extract_all(t, '" + c.replace("'", "''") + "'))" for c in classes)
    listed = " ".join(f"when '{k}' then [" + ", ".join(f"'{w}'" for w in v) + "]" for k, v in quality_rules.COMMON_WORDS.items())
    bins = range(1, len(classes) + 2)
    common = range(1, max(map(len, quality_rules.COMMON_WORDS.values())) + 2)
    distance = """case when list_sum({a}) > 0 and list_sum({b}) > 0 then sqrt(greatest(0, list_sum(list_transform(
      range(1, len({a}) + 1), lambda i: (
        case when {a}[i] > 0 then ({a}[i]::double / list_sum({a})) * log2(2 * ({a}[i]::double / list_sum({a}))
          / ({a}[i]::double / list_sum({a}) + {b}[i]::double / list_sum({b}))) else 0 end
        + case when {b}[i] > 0 then ({b}[i]::double / list_sum({b})) * log2(2 * ({b}[i]::double / list_sum({b}))
          / ({a}[i]::double / list_sum({a}) + {b}[i]::double / list_sum({b}))) else 0 end) / 2)))) end"""
    return rf"""
with d as (select row_number() over () as r, doc_id, lang, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
g as (select r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as gram
  from (select r, w, unnest(range(1, len(w) - 1)) as i from d where len(w) >= 3) x),
c as (select r, count(distinct k) as n_repeat_words from (select r, unnest([i, i + 1, i + 2]) as k
  from (select r, i, count(*) over (partition by r, gram) as n from g) y where n > 1) z group by r),
f as (select d.r, doc_id, lang, len(w)::bigint as n_words,
    (length(t) - len(regexp_extract_all(t, '[\x20\x09-\x0D]')))::bigint as word_chars,
    len(regexp_extract_all(t, '{quality_rules.SYMBOLS}'))::bigint as n_symbols,
    (len(list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')))
      - len(list_distinct(list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')))))::bigint as n_dup_lines,
    coalesce(n_repeat_words, 0)::bigint as n_repeat_words, length(t) as chars, [{counts}] as k,
    case lang {listed} else []::varchar[] end as listed, w from d left join c on d.r = c.r),
h as (select * exclude (k, listed, w, chars), n_words < {quality_rules.MIN_WORDS}
      or 100 * n_repeat_words > {quality_rules.REPEAT_PERCENT} * n_words as base_failed, chars,
    list_concat([chars - list_sum(k)], k) as classes,
    list_concat(list_transform(listed, lambda x: len(list_filter(w, lambda y: y = x))),
      [len(w) - len(list_filter(w, lambda y: list_contains(listed, y)))]) as common from f),
m as (select lang, [{", ".join(f"sum(classes[{i}])" for i in bins)}] as rk,
    list_filter([{", ".join(f"sum(common[{i}])" for i in common)}], lambda x: x is not null) as rc
  from h where not base_failed and n_words >= {quality_rules.WORD_LEAST} group by lang),
v as (select h.*, case when chars >= {quality_rules.CHARACTER_LEAST} then {distance.format(a="classes", b="rk")} end as dk,
    case when n_words >= {quality_rules.WORD_LEAST} and len(common) > 1 then {distance.format(a="common", b="rc")} end as dc
  from h left join m on h.lang is not distinct from m.lang)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed
  and coalesce(dk <= {quality_rules.CHARACTER_DISTANCE}, true) and coalesce(dc <= {quality_rules.WORD_DISTANCE}, true) as kept from v"""


@query("op6_distribution_divergence", _op6_sql())
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(table(spark, sf_dir, "documents")).drop("char_distance", "word_distance")


@query("op8_disclosing_terms")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_spans(table(spark, sf_dir, "documents"))


@query("op11_length_delimited_records")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.round_trip(table(spark, sf_dir, "documents"))


@query("op12_branching_tandem_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(table(spark, sf_dir, "documents"), rewrite=periodic_runs.looped)
    return found.drop("runs", "collapsed")


@query("op13_reversed_search", r"""
with t as (select row_number() over () as d, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
s as (select count(*) filter (len(w) > 0) as n, sum(len(w))::bigint as l from t),
q as (select i, item_id, term, count(*) as k from (select i, item_id, unnest(w) as term from (select row_number() over () as i,
    item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from benchmark) x) y group by all),
f as (select d, doc_id, size, term, count(*) as tf from (select d, doc_id, len(w) as size, unnest(w) as term from t) x
  where term in (select term from q) group by all),
g as (select term, floor(1000 * ln((2 * (select n from s) + 2)::double / (2 * count(*) + 1)))::bigint as weight from f group by term),
c as (select d, doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * size * s.n) // s.l))) as gain
  from f join g using (term), s),
p as (select i, item_id, d, doc_id, sum(k * gain)::bigint as score from q join c using (term) group by all)
select item_id, rank::int as rank, doc_id, score from (select item_id, doc_id, score,
  row_number() over (partition by i order by score desc, doc_id nulls last) as rank from p where score > 0) x where rank <= 10
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("item")


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
