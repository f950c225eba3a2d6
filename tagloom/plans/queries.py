"""Driver queries of the engine's own operators, each over its whole table, with DuckDB oracles where SQL can express them."""

from __future__ import annotations

import json
import random
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import extract, html_tree, invariants, mutate, rendering, similarity, text, tokens
from ..operators import dataset, evaluate, reports
from ..functions.kinds import SIMPLE
from ..sources import records, registry, scratch, sinks
from ..sources.tables import spread, table
from ..streaming import capture
from . import rouge_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def pages_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages"))


def page_lang(url: Column) -> Column:
    return F.regexp_extract(url, "^[a-z]+://[^/]+/([a-z]{2})/", 1)


PAGE_LANG = "regexp_extract(url, '^[a-z]+://[^/]+/([a-z]{2})/', 1)"


def digest(c: Column) -> Column:
    return F.md5(c.cast("binary"))


#: Largest remainders in two stages: train of all, then validation of the rest.
SPLIT = """select {cols}, case when r <= train then 'train' when r <= train + validation then 'validation' else 'test' end as split
from (select *, row_number() over (partition by {by} order by md5('42:' || doc_id), doc_id) as r from {t}) members join (
  select k, train, w2 + case when row_number() over (order by rest2 desc, md5('43:' || k), k) <= t2 - sum(w2) over () then 1 else 0 end as validation from (
    select *, (c2 * t2) // n2 as w2, (c2 * t2) % n2 as rest2 from (select *, sum(c2) over () as n2, cast(floor(sum(c2) over () * 0.5) as bigint) as t2 from (select *, c - train as c2 from (
      select *, w + case when row_number() over (order by rest desc, md5('42:' || k), k) <= t - sum(w) over () then 1 else 0 end as train from (
        select *, (c * t) // n as w, (c * t) % n as rest from (select k, c, sum(c) over () as n, cast(floor(sum(c) over () * 0.8) as bigint) as t from (
          select coalesce(cast({by} as varchar), '') as k, count(*) as c from {t} group by 1))))))) ) quotas on k = coalesce(cast({by} as varchar), '')"""


# --- the same pages in SQL ---------------------------------------------------

# Oracles only: the pages of the tables have few tags (unclosed <p><b> in an article, pages without an end), so patterns find what the tree does.
TOKENS_SQL = r"cast(len(regexp_extract_all({}, '\p{{L}}{{1,6}}|\p{{N}}|[^\p{{L}}\p{{N}}\s\x0B]')) as bigint)"
LEVELS_SQL = r"""
raw as (select page_id, html, len(regexp_extract_all(html, '<b>')) as n_open, regexp_replace(html, '(?s)<style>.*?</style>|<script>.*?</script>', '', 'g') as plain from pages),
unescaped_pages as (select *, replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(plain, '&amp;?', chr(2), 'g'), '(href="[^"]*)&quot;', '\1' || chr(1), 'g'), '&quot;?', '"', 'g'), '&copy;', '©'), '&middot;', '·'), '&', '&amp;'), chr(2), '&amp;'), chr(1), '&quot;') as unescaped from raw),
minimal_pages as (select *, replace(regexp_replace(unescaped, '<(meta charset="utf-8"|br)>', '<\1/>', 'g'), '</article>', repeat('</b></p>', n_open) || '</article>') || case when contains(html, '</html>') then '' else '</body></html>' end as minimal from unescaped_pages),
moderate_pages as (select *, replace(minimal, '<div class="ad">', '<div>') as moderate from minimal_pages),
cleaned_pages as (select page_id, html as original, minimal, moderate,
  regexp_replace(regexp_replace(regexp_replace(moderate, '(?s)<nav>.*?</nav>|<footer>.*?</footer>|<meta charset="utf-8"/>|<br/>', '', 'g'), '<html lang="[^"]*">', '<html>'), '<p>\s*</p>|<div>\s*</div>', '', 'g') as aggressive from moderate_pages)"""
LONG_LEVELS_SQL = LEVELS_SQL + f""", counted as (select page_id, {", ".join(f"{TOKENS_SQL.format(x)} as {x}" for x in html_tree.LEVELS)} from cleaned_pages),
level_rows as ({" union all ".join(f"select page_id, '{x}' as level, {x} as tokens, {'null' if x == 'original' else f'(original - {x}) * 100.0 / nullif(original, 0)'} as less from counted" for x in html_tree.LEVELS)})"""


def _stripped(sql: str) -> str:
    """Text of markup: no tags and comments, characters for entities, no space around."""
    bare = rf"regexp_replace({sql}, '(?s)<!--.*?-->|<[^>]*>', '', 'g')"
    plain = f"replace(replace(replace(regexp_replace(regexp_replace({bare}, '&amp;?', chr(2), 'g'), '&quot;?', '\"', 'g'), '&copy;', '©'), '&middot;', '·'), chr(2), '&')"
    return rf"regexp_replace({plain}, '^\s+|\s+$', '', 'g')"


#: What ends a paragraph by the rules of HTML: its end tag, the start of a block, the end of what it stands in.
PARAGRAPH_END = r"</(?:p|div|article|section|main|li|ul|ol|td|body|html)\s*>|<(?:address|article|aside|blockquote|center|details|dialog|dir|div|dl|dd|dt|fieldset|figcaption|figure|footer|form|h[1-6]|header|hgroup|hr|li|main|menu|nav|ol|p|pre|section|summary|table|ul)[\s/>]|$"
FIELDS_SQL = rf"""
field_texts as (select page_id, nullif({_stripped("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")}, '') as heading, nullif({_stripped(f"regexp_extract(html, '(?s)<p>(.*?)(?:{PARAGRAPH_END})', 1)")}, '') as first_p,
  {_stripped("regexp_extract(html, '(?s)<body>.*')")} as body, list_filter(list_transform(regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1), lambda x: {_stripped("x")}), lambda x: x <> '') as items from pages)"""
_P = "case when length(first_p) > {} and length(first_p) < {} then to_json(first_p) end"
_MATCH = "to_json(nullif(regexp_extract(body, '{}'), ''))"
#: type -> field -> JSON of what the rules find on these pages; all other fields keep their template.
_FOUND = {
    "recipe": {"name": "to_json(heading)", "description": _P.format(20, 500), "ingredients": "case when len(items) between 1 and 29 then '[' || array_to_string(list_transform(items, lambda x: cast(to_json(x) as varchar)), ', ') || ']' end"},
    "event": {"title": "to_json(heading)", "description": _P.format(20, 1 << 40), "price": _MATCH.format(extract.PRICE)},
    "job_posting": {"title": "to_json(heading)"},
    "person": {"name": "to_json(heading)", "bio": _P.format(30, 1 << 40), "email": _MATCH.format(extract.EMAIL), "phone": _MATCH.format(extract.PHONE)},
    "error_page": {"message": "to_json(heading)", "description": "to_json(first_p)", "error_code": f"nullif(regexp_extract(body, '{extract.STATUS}'), '')"},
    "auth_required": {"message": "to_json(heading)", "description": "to_json(first_p)"},
}


def _label_sql(kind: str) -> str:
    """The label of a type as json.dumps writes it."""
    found = _FOUND.get(kind, {})
    parts = []
    for name, default in registry.TEMPLATES[kind].items():
        plain = "'" + json.dumps(default) + "'"
        parts.append(f"'\"{name}\": ' || " + (f"coalesce(cast({found[name]} as varchar), {plain})" if name in found else plain))
    return "'{' || " + " || ', ' || ".join(parts) + " || '}'"


def _labels_sql(kinds: tuple[str, ...]) -> str:
    """page_id, type, label of every page, the types by turns."""
    cases = lambda of: " ".join(f"when {i} then {of(k)}" for i, k in enumerate(kinds))
    turn = f"page_id % {len(kinds)}"
    return FIELDS_SQL + f""", labelled as (select page_id, case {turn} {cases(lambda k: f"'{k}'")} end as type, case {turn} {cases(_label_sql)} end as label from field_texts)"""


def _there(field: str) -> str:
    return f"coalesce(json_extract_string(label, '$.{field}') not in ('', '[]', '{{}}', 'false', '0'), false)"


def _named(field: str) -> str:
    return f"({_there(field)} and json_extract_string(label, '$.{field}') <> 'TODO')"


#: (type, metric) -> value of a label.
_QUALITY = {
    ("recipe", "has_ingredients"): _there("ingredients"), ("recipe", "ingredient_count"): "json_array_length(label, '$.ingredients')", ("recipe", "has_instructions"): _there("instructions"),
    ("recipe", "instruction_count"): "json_array_length(label, '$.instructions')", ("recipe", "has_timing"): f"({_there('cook_time')} or {_there('prep_time')})", ("recipe", "has_rating"): _there("rating"),
    ("job_posting", "has_title"): _named("title"), ("event", "has_title"): _there("title"), ("job_posting", "has_company"): _there("company"), ("event", "has_datetime"): _named("datetime"),
    ("job_posting", "has_location"): _there("location"), ("event", "has_location"): _there("location"), ("event", "has_price"): _there("price"), ("job_posting", "has_description"): _there("description"),
    ("event", "has_description"): _there("description"), ("job_posting", "description_length"): "length(coalesce(json_extract_string(label, '$.description'), ''))",
}


# --- profiles of pages -------------------------------------------------------


@query(f"""
with p as (select {PAGE_LANG} as lang, length(html) as size,
  len(regexp_extract_all(html, '<[a-zA-Z]')) as tags, len(regexp_extract_all(html, '<div[ >]')) as divs, len(regexp_extract_all(html, '<span[ >]')) as spans,
  len(regexp_extract_all(html, '<[a-z][^>]* class="[^"]+"')) as classes, len(regexp_extract_all(html, '<[a-z][^>]* id="[^"]+"')) as ids from pages)
select lang, count(*) as n, round(avg(size), 1) as size_mean, median(size) as size_median, min(size) as size_min, max(size) as size_max,
  round(avg(tags), 1) as tags_mean, median(tags) as tags_median, cast(sum(divs) as bigint) as divs, cast(sum(spans) as bigint) as spans, cast(sum(classes) as bigint) as classes, cast(sum(ids) as bigint) as ids
from p group by lang""")
def html_profile_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = pages_of(spark, sf_dir).select(page_lang(F.col("url")).alias("lang"), "html")
    p = reports.profiled(pages)
    return p.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("html_size"), 1).alias("size_mean"), F.median("html_size").alias("size_median"), F.min("html_size").alias("size_min"), F.max("html_size").alias("size_max"),
        F.round(F.avg("tag_count"), 1).alias("tags_mean"), F.median("tag_count").alias("tags_median"), F.sum("div_count").alias("divs"), F.sum("span_count").alias("spans"), F.sum("class_count").alias("classes"), F.sum("id_count").alias("ids"),
    )


@query(rf"""
with {LEVELS_SQL}, p as (select page_id, length(html) as size, len(regexp_extract_all(html, '<[a-zA-Z]')) as tags, greatest(6, 4 + 2 * n_open) as depth,
  len(list_filter(regexp_split_to_array(regexp_replace(unescaped, '(?s)<!--.*?-->|<[^>]*>', ' ', 'g'), '[\s\x{{0B}}\x{{1C}}-\x{{1F}}\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]+'), lambda w: w <> '')) as words from unescaped_pages)
select {PAGE_LANG} as lang, count(*) as n, round(avg(size), 1) as size_mean, round(median(size), 1) as size_median, min(size) as size_min, max(size) as size_max, round(avg(tags), 1) as tags_mean, round(median(tags), 1) as tags_median,
  round(avg(words), 1) as words_mean, round(median(words), 1) as words_median, round(avg(depth), 1) as depth_mean, max(depth) as depth_max from p join pages using (page_id) group by lang""")
def html_size_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = pages_of(spark, sf_dir).select(page_lang(F.col("url")).alias("lang"), "html")
    return reports.size_summary(scratch.kept(reports.profiled(pages).drop("html"), "profiles"), "lang")


@query("""
select page_id, trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) as title, contains(html, '<body') as has_body,
  cast(len(regexp_extract_all(html, '<div[ >]')) as bigint) as n_div, cast(len(regexp_extract_all(html, '<p[ >]')) as bigint) as n_p, cast(len(regexp_extract_all(html, '<a[ >]')) as bigint) as n_a, cast(len(regexp_extract_all(html, '<h[1-6][ >]')) as bigint) as n_headings
from (select page_id, replace(replace(replace(replace(html, '&amp;', '&'), '&quot;', '"'), '&middot;', '·'), '&copy;', '©') as html from pages)""")
def html_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = pages_of(spark, sf_dir).withColumn("o", reports.html_overview.asNondeterministic()("html"))
    return made.select("page_id", "o.*")


@query("""
select tag, count(*) as n from (select unnest(regexp_extract_all(html, '<([a-zA-Z][a-zA-Z0-9]*)', 1)) as tag from pages) group by tag order by n desc, tag limit 15""")
def tag_top15(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_tags(pages_of(spark, sf_dir))


@query(f"""
with {LONG_LEVELS_SQL} select level, count(*) as n, round(avg(tokens), 4) as tokens_mean, median(tokens) as tokens_median, min(tokens) as tokens_min, max(tokens) as tokens_max, round(avg(less), 4) as reduction_mean from level_rows group by level""")
def clean_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.level_stats(scratch.kept(reports.token_levels(pages_of(spark, sf_dir), "page_id"), "levels"))


@query(f"""
with {LEVELS_SQL}, s as ({SPLIT.format(cols="doc_id as page_id", by="kind", t="(select page_id as doc_id, 1 as kind from pages)")}),
first as (select page_id from s where split = 'train' order by page_id limit 50), t as (select {TOKENS_SQL.format("original")} as a, {TOKENS_SQL.format("moderate")} as b from cleaned_pages join first using (page_id))
select count(*) as n, round(avg(a), 4) as original_mean, round(avg(b), 4) as moderate_mean, round(avg((a - b) * 100.0 / nullif(a, 0)), 4) as reduction_mean from t""")
def train_sample_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "html", F.lit("page").alias("type"))
    return reports.sample_means(dataset.stratified_split(pages, "page_id", "type").filter("split = 'train'"), "page_id")


@query(f"""
with {LONG_LEVELS_SQL} select w as context_window, level, count(*) filter (tokens <= w) as fits from level_rows, (values {", ".join(f"({w})" for w in registry.CONTEXT_WINDOWS)}) v(w) group by w, level""")
def context_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.context_fit(reports.token_levels(pages_of(spark, sf_dir), "page_id"))


@query(f"""
with {LONG_LEVELS_SQL}, {_labels_sql(("job_posting",))}, r as (select level, {TOKENS_SQL.format("label")} / nullif(tokens, 0)::double as snr from level_rows join labelled using (page_id))
select level, round(avg(snr), 6) as snr, round(1 / nullif(avg(snr), 0), 6) as inverse from r group by level""")
def signal_to_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = pages_of(spark, sf_dir).withColumn("label", extract.annotated("html", F.lit("job_posting"), "url"))
    return reports.signal_to_noise(reports.token_levels(pages, "page_id", json="label"))


# --- counts, statistics, completeness ----------------------------------------


@query("select event_type, count(*) as n from events group by event_type order by event_type")
def type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).orderBy("event_type")


@query("""
select d.event_type, coalesce(c.n, 0) as n, case when coalesce(c.n, 0) >= 10 then '[Complete] ' else '' end || d.event_type || ' (' || coalesce(c.n, 0) || '/10)' as label
from (values ('click'), ('view'), ('purchase'), ('refund')) d(event_type) left join (select event_type, count(*) as n from events group by event_type) c using (event_type)""")
def zero_filled_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    dimension = spark.createDataFrame([("click",), ("view",), ("purchase",), ("refund",)], "event_type string")
    return reports.option_labels(reports.zero_filled(table(spark, sf_dir, "events"), dimension, "event_type"), "event_type")


@query(r"""
with d as (select lang, n_chars, len(list_filter(regexp_split_to_array(text, '[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+'), lambda w: w <> '')) as words from documents)
select lang, cast(grouping(lang) as int) as is_total, count(*) as n, round(avg(n_chars), 4) as n_chars_mean, median(n_chars) as n_chars_median, min(n_chars) as n_chars_min, max(n_chars) as n_chars_max,
  round(avg(words), 4) as words_mean, median(words) as words_median, min(words) as words_min, max(words) as words_max
from d group by grouping sets ((lang), ())""")
def length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents")).select("lang", "n_chars", text.word_count(F.col("text")).alias("words"))
    return reports.grouped_stats(docs, "lang", ["n_chars", "words"])


@query("""
select count(n_chars) as n, cast(sum(n_chars) as bigint) as total, round(avg(n_chars), 4) as mean, max(n_chars) as max, round(quantile_cont(n_chars, 0.95), 4) as p95, cast(ceil(max(n_chars) / 1000.0) * 1000 as bigint) as max_to_thousand from documents""")
def length_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.overall(table(spark, sf_dir, "documents"), "n_chars")


@query("""
with l as (unpivot (select cast(l_quantity as double) as l_quantity, cast(l_extendedprice as double) as l_extendedprice, cast(l_discount as double) as l_discount from lineitem) on l_quantity, l_extendedprice, l_discount into name variable value value)
select variable, count(value) as count, round(avg(value), 4) as mean, round(stddev_samp(value), 4) as std, min(value) as min, round(quantile_cont(value, 0.25), 4) as q25, round(quantile_cont(value, 0.5), 4) as q50, round(quantile_cont(value, 0.75), 4) as q75, max(value) as max
from l group by variable""")
def described(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.described(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])


@query("""
select lang, round(quantile_cont(n_chars, 0.0), 4) as low, round(quantile_cont(n_chars, 0.25), 4) as q1, round(quantile_cont(n_chars, 0.5), 4) as middle, round(quantile_cont(n_chars, 0.75), 4) as q3, round(quantile_cont(n_chars, 1.0), 4) as high from documents group by lang""")
def length_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.box_plot(table(spark, sf_dir, "documents"), "lang", "n_chars")


@query("""
with b as (select cast(min(n_chars) as double) as lo, cast(max(n_chars) as double) as hi from documents)
select cast(least(floor((n_chars - lo) / ((hi - lo) / 30)), 29) as int) as bin, count(*) as n from documents, b group by bin""")
def length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.histogram(table(spark, sf_dir, "documents"), "n_chars")


@query("""
select min(n_chars) as min, max(n_chars) as max, round(avg(n_chars), 4) as mean, cast((list_sort(list(n_chars)))[count(*) // 2 + 1] as double) as upper_median from documents""")
def upper_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.upper_median(table(spark, sf_dir, "documents"), "n_chars")


@query("""
select event_type, case when not json_valid(props) then 'not JSON' when json_type(props) <> 'OBJECT' then 'not an object' when json_extract(props, '$.k') is null then 'no key' else 'valid' end as state, count(*) as n from events group by all""")
def props_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.try_parse_json("props")
    state = F.when(v.isNull(), "not JSON").when(~F.schema_of_variant(v).startswith("OBJECT"), "not an object").when(~records.has_key(v, "$.k"), "no key").otherwise("valid")
    return table(spark, sf_dir, "events").groupBy("event_type", state.alias("state")).agg(F.count(F.lit(1)).alias("n"))


LABEL = """case when value < 20 then '{"type": "' || event_type || '", "value": null, "user": "TODO"}' when value < 40 then '{"type": "' || event_type || '", "value": "", "note": "x"}' else '{"type": "' || event_type || '", "value": "' || user_id || '"}' end"""


@query(f"""
with l as (select event_type, {LABEL} as raw from events), t as (select event_type, count(*) as total from l group by event_type),
f as (select event_type, unnest(json_keys(raw)) as field, raw from l)
select event_type, field, count(*) as present, total, round(sum(case when coalesce(json_extract_string(raw, '$.' || field), '') in ('', 'TODO') then 0 else 1 end) * 100.0 / total, 4) as coverage_pct,
  round(sum(case when coalesce(json_extract_string(raw, '$.' || field), '') in ('', 'TODO') then 0 else 1 end) * 100.0 / count(*), 4) as completeness_pct
from f join t using (event_type) group by event_type, field, total""")
def field_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_type", F.expr(LABEL).alias("raw"))
    return reports.completeness(events, "event_type", "raw")


@query(f"""
with {_labels_sql(tuple(registry.PROMPTS))}, m as ({" union all ".join(f"select type, '{m}' as metric, cast({v} as double) as value from labelled where type = '{k}'" for (k, m), v in _QUALITY.items())})
select type, metric, count(*) as n, round(avg(value), 4) as mean, median(value) as median from m group by type, metric""")
def label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.element_at(F.array(*[F.lit(k) for k in registry.PROMPTS]), (F.col("page_id") % 3 + 1).cast("int"))
    pages = pages_of(spark, sf_dir).withColumn("type", kind)
    labelled = pages.withColumn("expected_json", extract.annotated("html", "type", "url")).select("type", "expected_json")
    return reports.quality_summary(reports.quality_flags(labelled))


@query("""
with g as (select user_id, count(*) as n, count(distinct json_extract_string(props, '$.k')) = 1 as ok from events group by user_id)
select cast(sum(n) as bigint) as rows, cast(coalesce(sum(n) filter (ok), 0) as bigint) as consistent_rows, count(*) as groups from g""")
def group_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.consistency(table(spark, sf_dir, "events"), "user_id", "props")


@query("""
select mark, answer, count(*) as n from (
  select 'quality' as mark, case quality when 1 then 'yes' when 0 then 'no' end as answer from labels union all select 'toxic', case toxic when 1 then 'yes' when 0 then 'no' end from labels)
group by mark, answer""")
def relabelled_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = table(spark, sf_dir, "labels").unpivot("doc_id", ["quality", "toxic"], "mark", "value")
    return long.groupBy("mark", F.when(F.col("value") == 1, "yes").when(F.col("value") == 0, "no").alias("answer")).agg(F.count(F.lit(1)).alias("n"))


# --- split, quota, variations ------------------------------------------------


@query(SPLIT.format(cols="doc_id, lang", by="lang", t="documents"))
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset.stratified_split(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", "lang")


@query(f"""
with s as ({SPLIT.format(cols="mark", by="mark", t="(select doc_id, quality * 10 + toxic as mark from labels)")})
select mark, count(*) as total, nullif(count(*) filter (split = 'train'), 0) as train, nullif(count(*) filter (split = 'validation'), 0) as validation, nullif(count(*) filter (split = 'test'), 0) as test from s group by mark""")
def split_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") * 10 + F.col("toxic")).alias("mark"))
    return dataset.split_table(dataset.stratified_split(labels, "doc_id", "mark"), "mark")


@query("""
with b as (select page_id, row_number() over (order by page_id) - 1 as place, count(*) over () as n, 400000 as target from pages),
c as (select page_id, place, greatest(target - n, 0) // n as each, greatest(target - n, 0) % n as extra from b),
d as (select page_id, place * each + least(place, extra) as first, each + case when place < extra then 1 else 0 end as k from c)
select page_id, ordinal, case when ordinal > 0 then cast(first + ordinal - 1 as bigint) end as variation_id from (select *, unnest(generate_series(0, k)) as ordinal from d)""")
def variation_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset.with_quota(table(spark, sf_dir, "pages").select("page_id"), "page_id", 400_000)


@query()
def page_variations(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = pages_of(spark, sf_dir).select("page_id", F.col("html").alias("example_html"))
    # One variation of every page: the target follows the table.
    made = dataset.variations(dataset.with_quota(pages, "page_id", 2 * pages.count()), "page_id")
    return made.select("page_id", "ordinal", "variation_id", digest(F.col("example_html")).alias("html_md5"), "metadata.augmentations", "metadata.applied")


@query()
def exploratory_variations(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = pages_of(spark, sf_dir).select("page_id", F.col("html").alias("example_html"))
    made = dataset.variations(dataset.variation_grid(pages, "page_id"), "page_id", profile="exploratory")
    return made.select("base_id", "ordinal", "variation_id", digest(F.col("example_html")).alias("html_md5"), "metadata.augmentations", "metadata.applied")


@query("""
with v as (select profile, k * (select count(*) from pages) as n from (values ('standard', 4), ('exploratory', 4)) t(profile, k)) select profile, n, n as n_kept, n as n_exact, n as n_labels from v""")
def variation_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four variations of each page by either profile: all keep the original's tags, texts and label, and name just what they changed. The oracle says so; a comparison of the pages finds out."""
    pages = pages_of(spark, sf_dir).select("page_id", F.col("html").alias("example_html"), F.col("html").alias("original"), F.concat(F.lit('{"url": "'), "url", F.lit('"}')).alias("expected_json"), F.md5("url").alias("label_md5"))
    made = {"standard": dataset.with_quota(pages, "page_id", 5 * pages.count()), "exploratory": dataset.variation_grid(pages, "page_id", 5).drop("base_id")}
    out = None
    for profile, rows in made.items():
        varied = dataset.variations(rows.filter(F.col("ordinal") > 0), "page_id", profile=profile)
        seen = varied.select(F.lit(profile).alias("profile"), invariants.checked("original", "example_html", "metadata.applied", profile).alias("x"), (F.md5(F.get_json_object("expected_json", "$.url")) == F.col("label_md5")).alias("same"))
        out = seen if out is None else out.unionByName(seen)
    return out.groupBy("profile").agg(F.count(F.lit(1)).alias("n"), F.count_if("x.kept").alias("n_kept"), F.count_if("x.exact").alias("n_exact"), F.count_if("same").alias("n_labels"))


@query("""
select count(*) as n, count(*) filter (trim(event_type) <> '') as html_ok, count(*) filter (json_valid(props)) as json_ok, count(*) filter (json_exists(props, '$.k')) as keys_ok from events""")
def validation_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.validation_tally(table(spark, sf_dir, "events"), "event_type", "props", ["k"])


@query("""
with v as (select user_id, row_number() over (partition by user_id order by event_id) - 1 as variation, props from events)
select user_id, count(*) filter (json_extract_string(v.props, '$.k') <> json_extract_string(f.props, '$.k')) as n_unlike from v join (select user_id, props from v where variation = 0) f using (user_id) group by user_id""")
def unlike_original(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("variation", F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1)
    return reports.unlike_original(events, "user_id", "variation", "props")


@query(r"""select page_id, md5(replace(replace(html, '<div', chr(10) || '<div'), '><', '>' || chr(10) || '<')) as html_md5 from pages""")
def whitespace_variation(spark: SparkSession, sf_dir: str) -> DataFrame:
    @F.pandas_udf(SIMPLE["string"])
    def spaced(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        always = random.Random()
        always.random = lambda: 0.0
        for texts in batches:
            yield texts.map(lambda t: mutate.spaced(t, always))

    return pages_of(spark, sf_dir).select("page_id", digest(spaced("html")).alias("html_md5"))


# --- chat --------------------------------------------------------------------


def _examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.element_at(F.array(*[F.lit(k) for k in registry.PROMPTS]), (F.col("page_id") % 3 + 1).cast("int"))
    answer = F.concat(F.lit('{"type":"'), kind, F.lit('", "url":"'), "url", F.lit('"}'))
    rows = pages_of(spark, sf_dir).select("page_id", kind.alias("type"), F.col("html").alias("example_html"), answer.alias("expected_json"))
    return dataset.chat_examples(rows, registry.prompts(spark))


_PROMPTS = " ".join(f"when {i} then '{t}'" for i, t in enumerate(registry.PROMPTS.values()))
_TYPES = " ".join(f"when {i} then '{k}'" for i, k in enumerate(registry.PROMPTS))
_CHAT = f"""select page_id, html, '{registry.INSTRUCTION}' || chr(10) || chr(10) || 'HTML:' || chr(10) || html || chr(10) || chr(10) || case page_id % 3 {_PROMPTS} end as user_text,
  '{{' || chr(10) || '  "type": "' || case page_id % 3 {_TYPES} end || '",' || chr(10) || '  "url": "' || url || '"' || chr(10) || '}}' as answer from pages"""


@query(rf"""
with c as ({_CHAT}), t as (select page_id, md5(user_text) as user_md5, md5(answer) as answer_md5,
  cast(len(regexp_extract_all(user_text, '\p{{L}}{{1,6}}|\p{{N}}|[^\p{{L}}\p{{N}}\s\x0B]')) + len(regexp_extract_all(answer, '\p{{L}}{{1,6}}|\p{{N}}|[^\p{{L}}\p{{N}}\s\x0B]')) + 10 as bigint) as n_tokens from c)
select * from t where n_tokens <= 24000""")
def chat_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dataset.within_budget(_examples(spark, sf_dir))
    part = lambda i, name: digest(F.get("messages", F.lit(i))["content"]).alias(name)
    return kept.select("page_id", part(0, "user_md5"), part(1, "answer_md5"), "n_tokens")


@query(f"""with c as ({_CHAT}) select page_id, md5(html) as html_md5, md5(answer) as answer_md5, length(user_text) - length(html) as overhead from c""")
def chat_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = dataset.from_chat(_examples(spark, sf_dir).drop("prompt"), registry.prompts(spark))
    user = F.length(F.get("messages", F.lit(0))["content"])
    return cut.select("page_id", digest(F.col("html")).alias("html_md5"), digest(F.col("answer")).alias("answer_md5"), (user - F.length("html")).cast("long").alias("overhead"))


@query("""
select conv_id, count(*) as n, md5(string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' order by turn)) as text_md5 from conversations group by conv_id""")
def conversation_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("messages"))
    return turns.select("conv_id", F.size("messages").cast("long").alias("n"), digest(dataset.one_text(F.col("messages"))).alias("text_md5"))


THOUGHT = "case turn % 4 when 0 then text when 1 then '<think>plan</think> ' || text || ' ' when 2 then text || ' <think>' || role else '<think>a</think> ' || text || '</think>rest' end"


@query(f"""
with t as (select conv_id, turn, {THOUGHT} as x from conversations)
select conv_id, turn, md5(trim(case when not contains(x, '<think>') then x when contains(x, '</think>') then split_part(x, '</think>', 2) else split_part(x, '<think>', 1) end, chr(32) || chr(10) || chr(9) || chr(13))) as answer_md5 from t""")
def answers_without_thoughts(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.expr(THOUGHT).alias("x"))
    return turns.select("conv_id", "turn", digest(text.answer_of(F.col("x"))).alias("answer_md5"))


# --- similarity and evaluation -----------------------------------------------

# Non-ASCII characters count as one sign each on both sides: DuckDB measures bytes.
PAIRS = r"""select conv_id, turn, regexp_replace(text, '[^\x00-\x7F]', '?', 'g') as reference, regexp_replace(coalesce(lag(text) over (partition by conv_id order by turn), ''), '[^\x00-\x7F]', '?', 'g') as prediction from conversations"""


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = lambda c: F.regexp_replace(c, r"[^\x00-\x7F]", "?")
    before = F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", plain(F.col("text")).alias("reference"), plain(F.coalesce(before, F.lit(""))).alias("prediction"))
    return rows


@query(f"""
with p as ({PAIRS}) select conv_id, turn, cast(levenshtein(prediction, reference) as bigint) as distance,
  round(case when greatest(length(prediction), length(reference)) = 0 then 1.0 else 1.0 - levenshtein(prediction, reference) / greatest(length(prediction), length(reference))::double end, 6) as similarity from p""")
def edit_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _pairs(spark, sf_dir).select("conv_id", "turn", similarity.edits.asNondeterministic()("prediction", "reference").alias("e"))
    return made.select("conv_id", "turn", "e.distance", F.round("e.similarity", 6).alias("similarity"))


OVERLAP = f"""
with p as ({PAIRS}), t as (select conv_id, turn, regexp_extract_all(lower(prediction), '[a-z0-9]+') as a, regexp_extract_all(lower(reference), '[a-z0-9]+') as b from p),
g as (select conv_id, turn, n, list_transform(range(1, len(a) - n + 2), lambda i: array_to_string(a[i:i + n - 1], ' ')) as ga, list_transform(range(1, len(b) - n + 2), lambda i: array_to_string(b[i:i + n - 1], ' ')) as gb from t, (values (1), (2)) v(n)),
ca as (select conv_id, turn, n, x, count(*) as c from (select conv_id, turn, n, unnest(ga) as x from g) group by all), cb as (select conv_id, turn, n, x, count(*) as c from (select conv_id, turn, n, unnest(gb) as x from g) group by all),
m as (select conv_id, turn, n, sum(least(ca.c, cb.c)) as both from ca join cb using (conv_id, turn, n, x) group by all)
select g.conv_id, g.turn, g.n, case when m.both is null then 0.0 else 2.0 * m.both / (len(ga) + len(gb)) end as f1 from g left join m on m.conv_id = g.conv_id and m.turn = g.turn and m.n = g.n"""


@query(f"""with o as ({OVERLAP}) select conv_id, turn, round(cast(max(f1) filter (n = 1) as double), 6) as rouge1, round(cast(max(f1) filter (n = 2) as double), 6) as rouge2 from o group by conv_id, turn""")
def overlap_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _pairs(spark, sf_dir).withColumn("s", similarity.overlap_scores.asNondeterministic()("prediction", "reference"))
    return made.select("conv_id", "turn", F.round("s.rouge1", 6).alias("rouge1"), F.round("s.rouge2", 6).alias("rouge2"))


@query(f"""
with recursive {rouge_sql.scores(f"select conv_id * 1000 + turn as k, reference, prediction from ({PAIRS})", ("prediction",))}
select k // 1000 as conv_id, k % 1000 as turn, round(rouge1, 6) as rouge1, round(rouge2, 6) as rouge2, round(rougel, 6) as "rougeL" from rouge""")
def rouge_stemmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = evaluate.scored(_pairs(spark, sf_dir))
    return made.select("conv_id", "turn", *[F.round(c, 6).alias(c) for c in ("rouge1", "rouge2", "rougeL")])


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """References, and the predictions of two made-up models: the turn before, and the reference's first half."""
    rows = _pairs(spark, sf_dir).select((F.col("conv_id") * 1000 + F.col("turn")).alias("example_idx"), "reference", "prediction")
    half = F.left("reference", F.floor(F.length("reference") / 2).cast("int"))
    failed = F.nullif("prediction", F.lit(""))  # a first turn has none before it: a prediction that failed
    return rows.select("example_idx", "reference"), rows.select("example_idx", failed.alias("prediction")), rows.select("example_idx", half.alias("prediction"))


def _f1(n: int, side: str) -> str:
    """Mean F1 of n-gram multisets of a side (a or b) with the reference, over all rows of s."""
    grams = lambda c: f"list_transform(range(1, len({c}) - {n} + 2), lambda i: array_to_string({c}[i:i + {n - 1}], ' '))"
    return f"""(with t as (select k, regexp_extract_all(lower({side}), '[a-z0-9]+') as x, regexp_extract_all(lower(reference), '[a-z0-9]+') as y from s), g as (select k, {grams('x')} as gx, {grams('y')} as gy from t),
  cx as (select k, u, count(*) as c from (select k, unnest(gx) as u from g) group by all), cy as (select k, u, count(*) as c from (select k, unnest(gy) as u from g) group by all),
  m as (select k, sum(least(cx.c, cy.c)) as n from cx join cy using (k, u) group by k) select avg(case when m.n is null then 0.0 else 2.0 * m.n / (len(gx) + len(gy)) end) from g left join m using (k))"""


_METRICS = {
    "levenshtein_avg": lambda side: f"(select avg(levenshtein({side}, reference)) from s)",
    "levenshtein_normalized": lambda side: f"(select avg(case when greatest(length({side}), length(reference)) = 0 then 1.0 else 1 - levenshtein({side}, reference) / greatest(length({side}), length(reference))::double end) from s)",
    "rouge1": lambda side: _f1(1, side),
    "rouge2": lambda side: _f1(2, side),
}


@query(
    f"with p as ({PAIRS}), s as (select row_number() over () as k, reference, prediction as a, left(reference, cast(floor(length(reference) / 2) as int)) as b from p), m as ("
    + " union all ".join(f"select '{m}' as metric, {of('a')} as base, {of('b')} as tuned" for m, of in _METRICS.items())
    + ") select metric, round(base, 6) as base, round(tuned, 6) as finetuned, round(case when base > 0 then (case when metric = 'levenshtein_avg' then base - tuned else tuned - base end) * 100 / base else 0 end, 4) as improvement_pct from m"
)
def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluate.comparison(*_sides(spark, sf_dir), stemmed=False))


@query(
    "with recursive " + rouge_sql.scores(f"select row_number() over () as k, reference, prediction as a_, left(reference, cast(floor(length(reference) / 2) as int)) as b_ from ({PAIRS})", ("a_", "b_")).replace("rouge as (select", "rouge as materialized (select")
    + ", s as (select k, reference, a_ as a, b_ as b from pairs_), m as ("
    + " union all ".join(f"select '{m}' as metric, (select avg({m.lower()}) from rouge where side = 'a_') as base, (select avg({m.lower()}) from rouge where side = 'b_') as tuned" for m in ("rouge1", "rouge2", "rougeL"))
    + "".join(f" union all select '{m}', {of('a')}, {of('b')}" for m, of in _METRICS.items() if m.startswith("lev"))
    + ") select metric, round(base, 6) as base, round(tuned, 6) as finetuned, round(case when base > 0 then (case when metric = 'levenshtein_avg' then base - tuned else tuned - base end) * 100 / base else 0 end, 4) as improvement_pct from m"
)
def model_comparison_stemmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluate.comparison(*_sides(spark, sf_dir)))


def _rounded(table: DataFrame) -> DataFrame:
    return table.select("metric", F.round("base", 6).alias("base"), F.round("finetuned", 6).alias("finetuned"), F.round("improvement_pct", 4).alias("improvement_pct"))


@query(f"""with p as ({PAIRS}) select conv_id * 1000 + turn as example_idx, md5(reference) as reference_md5, md5(prediction) as base_md5, md5(left(reference, cast(floor(length(reference) / 2) as int))) as finetuned_md5 from p""")
def comparison_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = evaluate.samples(*_sides(spark, sf_dir))
    return made.select("example_idx", digest(F.col("reference")).alias("reference_md5"), digest(F.col("base_prediction")).alias("base_md5"), digest(F.col("finetuned_prediction")).alias("finetuned_md5"))


# --- extraction and matching -------------------------------------------------


@query("""
select page_id, nullif(trim(replace(replace(regexp_extract(html, '<h1[^>]*>([^<]*)</h1>', 1), '&amp;', '&'), '&quot;', '"')), '') as title from pages""")
def extracted_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = pages_of(spark, sf_dir).withColumn("e", extract.extracted("html", F.lit("job_posting"), "url"))
    return made.select("page_id", F.get_json_object("e", "$.title").alias("title"))


@query(f"with {_labels_sql(registry.TYPES)} select page_id, type, label as expected_json from labelled")
def annotated_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.array(*[F.lit(k) for k in registry.TYPES])
    pages = pages_of(spark, sf_dir).withColumn("type", F.element_at(kinds, (F.col("page_id") % len(registry.TYPES) + 1).cast("int")))
    return pages.select("page_id", "type", extract.annotated("html", "type", "url").alias("expected_json"))


@query(r"""
select doc_id, nullif(regexp_extract(text, '\$\d+(?:\.\d{2})?'), '') as price, nullif(regexp_extract(text, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}'), '') as email,
  nullif(regexp_extract(text, '\(\d{3}\)\s*\d{3}-\d{4}|\d{3}-\d{3}-\d{4}'), '') as phone, nullif(regexp_extract(text, '\b(404|500|503|502|403|429)\b'), '') as status from documents""")
def first_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    found = {"price": extract.first_match(text, extract.PRICE, "$"), "email": extract.first_match(text, extract.EMAIL_AT_RUNS, "@"), "phone": extract.first_match(text, extract.PHONE, "-"), "status": extract.first_match(text, extract.STATUS)}
    return table(spark, sf_dir, "documents").select("doc_id", *[c.alias(n) for n, c in found.items()])


@query("""
select page_id, case when contains(html, '__next') or contains(html, '_reactRoot') then 'react' when contains(html, '__nuxt') or contains(html, '__NUXT__') then 'vue' when contains(html, 'ng-version') or contains(html, 'ng-app') then 'angular' end as framework from pages""")
def page_framework(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", extract.framework(F.col("html")).alias("framework"))


@query(f"""
with {FIELDS_SQL} select page_id, cast(case when len(items) between 1 and 5 then len(items) else 0 end as bigint) as n, case when len(items) between 1 and 5 then array_to_string(items, '|') end as names from field_texts""")
def pricing_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages with their list items as headings of plans: up to five are a pricing table, more are something else."""
    html = F.replace(F.replace("html", F.lit("<li>"), F.lit("<h3>")), F.lit("</li>"), F.lit("</h3>"))
    made = pages_of(spark, sf_dir).select("page_id", extract.extracted(html, F.lit("pricing_table")).alias("e"))
    plans = F.from_json(F.get_json_object("e", "$.plans"), "array<struct<name: string, price: string, features: array<string>>>")
    return made.select("page_id", plans.alias("plans")).select("page_id", F.coalesce(F.size("plans"), F.lit(0)).cast("long").alias("n"), F.array_join("plans.name", "|").alias("names"))


@query("""
with l as (select page_id, regexp_extract(url, '^([a-z]+)://', 1) as scheme, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) as host, regexp_extract_all(html, '<a href="([^"]*)"', 1) as refs from pages)
select page_id, i - 1 as place, replace(replace(refs[i], '&amp;', '&'), '&quot;', '"') as reference, scheme, host, replace(replace(refs[i], '&amp;', '&'), '&quot;', '"') as path from (select *, unnest(range(1, len(refs) + 1)) as i from l)""")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every link of every page, resolved at the page's URL; the oracle holds as all references of these pages are paths from the root, in letters that stay or are escaped and read back."""
    links = pages_of(spark, sf_dir).select("page_id", F.posexplode(extract.page_links.asNondeterministic()("html", "url")).alias("place", "link"))
    part = lambda p: F.regexp_extract("link.url", r"^([a-z]+)://([^/]+)(/.*)$", p)
    return links.select("page_id", F.col("place").cast("long").alias("place"), "link.reference", part(1).alias("scheme"), part(2).alias("host"), F.try_url_decode(F.replace(part(3), F.lit("+"), F.lit("%2B"))).alias("path"))


# --- URLs --------------------------------------------------------------------

HOST = "nullif(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1), '')"


@query(f"select {HOST} as host, count(*) as n, count(distinct url) as urls, count(*) filter (starts_with(url, 'https:')) as secure from pages group by host")
def url_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("url", text.host(F.col("url")).alias("host"))
    return pages.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("url").alias("urls"), F.count_if(F.col("url").startswith("https:")).alias("secure"))


@query(f"""
select page_id, host from (select page_id, {HOST} as host, row_number() over (partition by {HOST} order by md5(url), url) as r from pages) where r <= 2""")
def few_of_each_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", text.host(F.col("url")).alias("host"))
    return dataset.few_of_each_host(pages, "host", "url").select("page_id", "host")


@query(f"""
with l as (select '- **' || {HOST} || '/x** - page ' || page_id as line, page_id as place from pages union all select '# ' || url, page_id from pages union all select '- ' || {HOST} || ' - again', page_id + 1 from pages)
select 'https://' || d as url, min(place) as place from (select case when contains(line, '**') then split_part(split_part(line, '**', 2), '/', 1) else split_part(trim(substr(line, 2)), ' ', 1) end as d, place from l where starts_with(line, '-')) where contains(d, '.') group by d""")
def domain_bullets(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", text.host(F.col("url")).alias("host"))
    bold = pages.select(F.concat(F.lit("- **"), "host", F.lit("/x** - page "), F.col("page_id").cast("string")).alias("line"), F.col("page_id").alias("place"))
    head = pages.select(F.concat(F.lit("# "), "url").alias("line"), F.col("page_id").alias("place"))
    plain = pages.select(F.concat(F.lit("- "), "host", F.lit(" - again")).alias("line"), (F.col("page_id") + 1).alias("place"))
    return records.domains(bold.union(head).union(plain))


# --- captures and streams ----------------------------------------------------

STAMP = "strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.' || lpad(cast(user_id % 1000 as varchar), 3, '0') || 'Z'"


@query(f"""
with a as (select 'annotation_' || event_type || '_' || replace(left({STAMP}, 19), ':', '-') || '.json' as name, event_type as type, {STAMP} as timestamp, props from events)
select name, arg_max(type, (timestamp, props)) as type, max(timestamp) as timestamp from a group by name""")
def annotation_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("."), F.lpad((F.col("user_id") % 1000).cast("string"), 3, "0"), F.lit("Z"))
    label = F.concat(F.lit('{"type": "'), "event_type", F.lit('"}'))
    captures = table(spark, sf_dir, "events").select(F.col("props").alias("html"), label.alias("label"), F.lit(None).cast("string").alias("url"), stamp.alias("timestamp"))
    return capture.latest(capture.annotations(captures).withColumn("batch", F.lit(0).cast("long"))).select("name", "type", "timestamp")


@query("select event_type as type, count(*) as n from events group by event_type")
def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/events.parquet"
    rows = capture.stream_table(spark, path, spark.read.parquet(path).schema)
    captures = rows.select(F.col("props").alias("html"), F.concat(F.lit('{"type": "'), "event_type", F.lit('"}')).alias("label"), F.lit(None).cast("string").alias("url"), F.col("ts").cast("string").alias("timestamp"))
    return capture.drained(capture.running_counts(captures), "stream_counts")


@query(r"""
select lang, cast(sum(length(text)) as bigint) as chars, cast(sum(len(regexp_extract_all(text, '\p{L}{1,6}|\p{N}|[^\p{L}\p{N}\s\x0B]'))) as bigint) as tokens from documents group by lang""")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.groupBy("lang").agg(F.sum(F.length("text").cast("long")).alias("chars"), F.sum(tokens.approximate(F.col("text"))).alias("tokens"))


def vocabulary() -> tokens.Ranks:
    """Counts by a public vocabulary: byte-level BPE of 50,256 tokens."""
    import public_tokenizers

    return tokens.Ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query()
def vocabulary_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Characters and tokens by language: of the vocabulary, as the approximation says, and the ratio of the two."""
    texts = pages_of(spark, sf_dir).select(F.lit("page").alias("kind"), page_lang(F.col("url")).alias("lang"), F.col("html").alias("text"))
    texts = texts.unionByName(spread(table(spark, sf_dir, "documents")).select(F.lit("document").alias("kind"), "lang", "text"))
    counted = texts.select("kind", "lang", F.length("text").cast("long").alias("chars"), vocabulary()(F.col("text")).alias("tokens"), tokens.approximate(F.col("text")).alias("approximate"))
    sums = counted.groupBy("kind", "lang").agg(*[F.sum(c).alias(c) for c in ("chars", "tokens", "approximate")])
    return sums.withColumn("ratio", F.round(F.try_divide("approximate", "tokens"), 4))


@query()
def vocabulary_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``budget_tally`` by the vocabulary."""
    return dataset.budget_tally(_examples(spark, sf_dir), count=vocabulary())


@query(f"""
with a as (select 'annotation_' || event_type || '_' || replace(left({STAMP}, 19), ':', '-') || '.json' as name, event_type as type, {STAMP} as timestamp, props from events)
select name, arg_max(type, (timestamp, props)) as type, max(timestamp) as timestamp from a group by name""")
def captures_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as captures through the stream that saves them, and read back."""
    path, folder = f"{sf_dir}/events.parquet", scratch.folder(spark, "captures")
    rows = capture.stream_table(spark, path, spark.read.parquet(path).schema)
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("."), F.lpad((F.col("user_id") % 1000).cast("string"), 3, "0"), F.lit("Z"))
    captures = rows.select(F.col("props").alias("html"), F.concat(F.lit('{"type": "'), "event_type", F.lit('"}')).alias("label"), F.lit(None).cast("string").alias("url"), stamp.alias("timestamp"))
    capture.save(captures, f"{folder}/rows", f"{folder}/log").trigger(availableNow=True).start().awaitTermination()
    return capture.saved(spark, f"{folder}/rows").select("name", "type", "timestamp")


@query("select user_id % 100 as host, count(distinct user_id) as n from events group by host")
def captured_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user once, from a stream of events that all lie within the watermark."""
    path = f"{sf_dir}/events.parquet"
    rows = capture.stream_table(spark, path, spark.read.parquet(path).schema).select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    folder = scratch.folder(spark, "once")
    once = capture.once(rows, "user_id", "ts", "60 days")
    once.writeStream.format("parquet").option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/log").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/rows").groupBy((F.col("user_id") % 100).alias("host")).agg(F.count(F.lit(1)).alias("n"))


# --- sources and sinks -------------------------------------------------------

RAW = """case event_id % 8 when 0 then '{"example_html": "<p>' || user_id || '</p>", "expected_json": {"type": "' || event_type || '"}}' when 1 then '{"example_html": ' when 2 then '{"expected_json": {"type": "x"}}' when 3 then '{"example_html": "x"}'
  when 4 then '{"example_html": "x", "expected_json": "type"}' when 5 then '{"example_html": null, "expected_json": {"type": null}}' when 6 then '[1]' else '{"example_html": "x", "expected_json": {}}' end"""
FILE = "'annotation_' || case event_id % 4 when 0 then 'recipe' when 1 then 'job_posting' when 2 then 'event' else 'person' end || '_' || event_id || '.json'"


@query(f"""
with r as (select {RAW} as raw from events), s as (select raw, case when not json_valid(raw) then 'not JSON' when json_type(raw) <> 'OBJECT' then 'not an object' when not json_exists(raw, '$.example_html') then 'no example_html'
  when not json_exists(raw, '$.expected_json') then 'no expected_json' when json_type(raw, '$.expected_json') <> 'OBJECT' then 'expected_json is not an object' when not json_exists(raw, '$.expected_json.type') then 'no type' end as reason from r)
select reason, case when reason is null then json_extract_string(raw, '$.expected_json.type') end as type, count(*) as n from s group by all""")
def annotation_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = records.validated(table(spark, sf_dir, "events").select(F.expr(RAW).alias("raw")))
    return rows.groupBy("reason", F.when(F.col("reason").isNull(), F.col("type")).alias("type")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""
with r as (select {FILE} as file, {RAW} as raw from events), s as (select case when contains(file, 'recipe') then 'recipe' when contains(file, 'job_posting') then 'job_posting' when contains(file, 'event') then 'event' end as type_by_name, case when json_valid(raw) then json_extract_string(raw, '$.expected_json.type') end as own from r)
select type_by_name, own is distinct from type_by_name as disagrees, count(*) as n from s where type_by_name is not null group by all""")
def named_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.expr(FILE).alias("file"), F.expr(RAW).alias("raw"))
    return records.typed_by_name(rows).groupBy("type_by_name", "disagrees").agg(F.count(F.lit(1)).alias("n"))


@query(f"select event_type as type, count(*) as n from events where event_id % 8 = 0 group by event_type union all select null, count(*) from events where event_id % 8 = 5 having count(*) > 0")
def annotation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by type of what can be read, over lines that partly can't."""
    folder = scratch.folder(spark, "annotations")
    sinks.write_lines(table(spark, sf_dir, "events").select(F.expr(RAW).alias("raw")), F.col("raw"), folder)
    return records.type_counts(records.json_lines(spark, folder, strict=False))


@query(f"select page_id, md5(html) as html_md5, case page_id % 3 {_TYPES} end as type, md5(html) is not null as valid from pages")
def golden_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Golden records written as JSON lines, read back strictly and validated."""
    folder = scratch.folder(spark, "golden")
    kind = F.element_at(F.array(*[F.lit(k) for k in registry.PROMPTS]), (F.col("page_id") % 3 + 1).cast("int"))
    label = F.concat(F.lit('{"type": "'), kind, F.lit('", "page": '), F.col("page_id").cast("string"), F.lit("}"))
    sinks.write_lines(table(spark, sf_dir, "pages").withColumn("label", label), sinks.golden_line(F.col("html"), F.col("label")), folder)
    rows = records.validated(records.json_lines(spark, folder))
    return rows.select(F.get_json_object("expected_json", "$.page").cast("long").alias("page_id"), digest(F.col("example_html")).alias("html_md5"), "type", F.col("reason").isNull().alias("valid"))


@query(rf"""
with c as ({_CHAT}), t as (select md5(user_text) as user_md5, md5(answer) as answer_md5, len(regexp_extract_all(user_text, '\p{{L}}{{1,6}}|\p{{N}}|[^\p{{L}}\p{{N}}\s\x0B]')) + len(regexp_extract_all(answer, '\p{{L}}{{1,6}}|\p{{N}}|[^\p{{L}}\p{{N}}\s\x0B]')) + 10 as n from c)
select user_md5, answer_md5, count(*) as n from t where n <= 24000 group by all""")
def converted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file of golden lines converted to chat lines within the budget, and read back."""
    source, target = scratch.folder(spark, "golden"), scratch.folder(spark, "converted")
    kind = F.element_at(F.array(*[F.lit(k) for k in registry.PROMPTS]), (F.col("page_id") % 3 + 1).cast("int"))
    label = F.concat(F.lit('{"type":"'), kind, F.lit('", "url":"'), "url", F.lit('"}'))
    sinks.write_lines(pages_of(spark, sf_dir).withColumn("label", label), sinks.golden_line(F.col("html"), F.col("label")), source)
    dataset.convert(spark, source, target)
    back = records.json_lines(spark, target, strict=False).select(F.from_json("raw", "messages array<struct<role: string, content: string>>").alias("x")).select("x.messages")
    part = lambda i, name: digest(F.get("messages", F.lit(i))["content"]).alias(name)
    return back.groupBy(part(0, "user_md5"), part(1, "answer_md5")).agg(F.count(F.lit(1)).alias("n"))


@query(f"with c as ({_CHAT}) select page_id, md5(user_text) as user_md5, md5(answer) as answer_md5 from c")
def chat_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat examples written as JSON lines and read back; the line holds no lineage, so the page comes from its url's row."""
    folder = scratch.folder(spark, "chat")
    examples = _examples(spark, sf_dir)
    sinks.write_lines(examples, sinks.chat_line(F.col("messages")), folder)
    back = records.json_lines(spark, folder).select(F.from_json("raw", "messages array<struct<role: string, content: string>>").alias("x")).select("x.messages")
    part = lambda i, name: digest(F.get("messages", F.lit(i))["content"]).alias(name)
    read = back.select(part(0, "user_md5"), part(1, "answer_md5"))
    ids = examples.select("page_id", part(0, "own_user"), part(1, "own_answer"))
    return ids.join(read, (F.col("own_user") == F.col("user_md5")) & (F.col("own_answer") == F.col("answer_md5")), "left").select("page_id", "user_md5", "answer_md5")


@query("select quality, toxic, count(*) as n, cast(sum(doc_id) as bigint) as ids from labels group by all")
def csv_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch.folder(spark, "csv")
    sinks.write_csv(table(spark, sf_dir, "labels"), folder)
    back = spark.read.csv(folder, header=True, schema="doc_id long, quality int, toxic int")
    return back.groupBy("quality", "toxic").agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("ids"))


@query("select event_type, count(*) as n, round(avg(value), 4) as mean from events group by event_type")
def json_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch.folder(spark, "report")
    made = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 4).alias("mean"))
    sinks.write_report(made, folder)
    return spark.read.schema(made.schema).json(folder)


@query(f"with s as ({SPLIT.format(cols='doc_id, lang', by='lang', t='documents')}) select split, lang, count(*) as n, count(distinct doc_id) as ids from s group by all")
def split_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split as folders, read back: each row is in one part, and all rows are there."""
    folder = scratch.folder(spark, "splits")
    sinks.write_splits(dataset.stratified_split(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", "lang"), folder)
    return spark.read.parquet(folder).groupBy("split", "lang").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("ids"))


@query(f"select {HOST} as host, count(*) as n, count(distinct url) as urls from pages group by host")
def url_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch.folder(spark, "urls")
    sinks.write_lines(table(spark, sf_dir, "pages"), F.concat(F.lit(" "), "url", F.lit(" ")), folder)
    return records.url_list(spark, folder).groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("url").alias("urls"))


@query(f"with p as (select {HOST} as host, row_number() over (order by page_id) - 1 as place from pages) select 'https://' || host as url, cast(min(place) as bigint) as place from p group by host")
def domain_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bullets in the order of the pages, in many files that follow each other, read back with their places."""
    folder = scratch.folder(spark, "domains")
    pages = table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("- **"), text.host(F.col("url")), F.lit("/a** (note)")).alias("line"))
    sinks.write_lines(pages, F.col("line"), folder, order="page_id")
    return records.domain_list(spark, folder)


@query("select row_number() over (order by event_id) - 1 as place, event_id, json_extract_string(props, '$.k') as k from events")
def ordered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON lines in the order of their ids, in many files, read back strictly with the place of each line."""
    folder = scratch.folder(spark, "ordered")
    events = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit('{"id": '), F.col("event_id").cast("string"), F.lit(', "props": '), "props", F.lit("}")).alias("line"))
    sinks.write_lines(events, F.col("line"), folder, order="event_id")
    back = records.lines(spark, folder)
    return back.select("place", F.get_json_object("raw", "$.id").cast("long").alias("event_id"), F.get_json_object("raw", "$.props.k").alias("k"))


@query(f"""
with a as (select case page_id % 3 {_TYPES} end as type, page_id % 2 as run from pages)
select type, count(*) as n, count(*) filter (run = 1) as n_new from a group by type""")
def annotation_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for each page's annotation, scanned in two runs: half of the files come between them, and the second run reads these alone."""
    folder, state = scratch.folder(spark, "annotation-files"), scratch.folder(spark, "scan")
    kind = F.element_at(F.array(*[F.lit(k) for k in registry.PROMPTS]), (F.col("page_id") % 3 + 1).cast("int"))
    raw = F.concat(F.lit('{\n  "example_html": "<p>",\n  "expected_json": {\n    "type": "'), kind, F.lit('"\n  }\n}'))
    # a folder holds few enough files for the driver to know their names; every second one comes in the second run
    n = -(-table(spark, sf_dir, "pages").count() // (2 * records.SCAN_FILES))
    shard = F.pmod(F.xxhash64("page_id"), F.lit(max(n, 1))).alias("shard")
    rows = pages_of(spark, sf_dir).select("page_id", raw.alias("value"), shard)  # dealt: files are written one after another in a task
    for half in (0, 1):
        # tasks move their own files into place (version 2): the driver would move them all, one by one
        out = rows.filter(F.col("page_id") % 2 == half).select("value", "shard").write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        out.partitionBy("shard").option("maxRecordsPerFile", 1).text(folder)
        shards = rows.filter(F.col("page_id") % 2 <= half).select("shard").distinct().collect()  # those there are
        found = records.scan_new(spark, folder, state, names="part-*", parts=[f"shard={x.shard}" for x in shards])
        if not half:
            first = scratch.kept(found.groupBy("part").agg(F.max("batch").alias("last")), "first-run")  # a row for each folder
    new = F.col("last").isNull() | (F.col("batch") > F.col("last"))
    runs = found.filter("reason is null").join(F.broadcast(first), "part", "left")
    return runs.groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.count_if(new).alias("n_new"))


@query("""
with s as ({split}), t as (select * from s where split = 'test' order by doc_id limit 40) select doc_id, lang from t""".format(split=SPLIT.format(cols="doc_id, lang", by="lang", t="documents")))
def published_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty rows of the test split of a published table; the other splits' files aren't read."""
    folder = scratch.folder(spark, "published")
    sinks.write_splits(dataset.stratified_split(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", "lang"), folder)
    return records.published(spark, folder, "test", limit=40, order="doc_id").select("doc_id", "lang")


# --- gates, filters, small functions -----------------------------------------


@query(f"""
with e as (select case when event_id % 5 = 0 then '  ' else event_type end as html, case when event_id % 7 = 0 then '' else event_type end as kind, {LABEL} as raw, props from events)
select trim(html) <> '' and json_valid(props) and kind <> '' as saveable, contains(raw, '"TODO"') as todo, count(*) as n from e group by all""")
def editor_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    html, kind = F.when(F.col("event_id") % 5 == 0, "  ").otherwise(F.col("event_type")), F.when(F.col("event_id") % 7 == 0, "").otherwise(F.col("event_type"))
    rows = table(spark, sf_dir, "events").select(text.saveable(html, F.col("props"), kind).alias("saveable"), text.has_open_todo(F.expr(LABEL)).alias("todo"))
    return rows.groupBy("saveable", "todo").agg(F.count(F.lit(1)).alias("n"))


@query(f"""select event_type, count(*) as n from events where contains({LABEL}, '"note": "x"') group by event_type""")
def labels_with_note(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").filter(text.holds(F.expr(LABEL), '"note": "x"'))
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(r"""select doc_id, lang from documents where len(regexp_extract_all(text, '\p{L}{1,6}|\p{N}|[^\p{L}\p{N}\s\x0B]')) between 200 and 8000""")
def token_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset.within_tokens(table(spark, sf_dir, "documents"), "text", 200, 8_000).select("doc_id", "lang")


@query("select doc_id, n_chars from documents order by doc_id limit 50")
def first_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset.first_rows(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id", 50)


@query(rf"""
with c as ({_CHAT}), t as (select cast(len(regexp_extract_all(user_text, '\p{{L}}{{1,6}}|\p{{N}}|[^\p{{L}}\p{{N}}\s\x0B]')) + len(regexp_extract_all(answer, '\p{{L}}{{1,6}}|\p{{N}}|[^\p{{L}}\p{{N}}\s\x0B]')) + 10 as bigint) as n from c)
select count(*) as n, count(*) filter (n <= 24000) as kept, count(*) filter (n > 24000) as dropped, count(*) filter (n <= 24000 and n > 4096) as over_trained from t""")
def budget_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset.budget_tally(_examples(spark, sf_dir))


@query("""
with t as (select conv_id, turn, case when turn % 3 = 1 then '' else text end as x from conversations)
select conv_id, count(*) filter (x <> '') as n, md5(coalesce(string_agg(x, chr(10) || chr(10) || '<!-- FRAGMENT SEPARATOR -->' || chr(10) || chr(10) order by turn) filter (x <> ''), '')) as fragments_md5 from t group by conv_id""")
def fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.struct("turn", F.when(F.col("turn") % 3 == 1, "").otherwise(F.col("text")).alias("x")).alias("t"))
    parts = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t")).select("conv_id", text.without_blanks(F.col("t.x")).alias("parts"))
    return parts.select("conv_id", F.size("parts").cast("long").alias("n"), digest(text.joined_fragments(F.col("parts"))).alias("fragments_md5"))


@query("select conv_id, turn, md5(case when length(text) > 100 then left(text, 100) || '...' else text end) as preview_md5 from conversations")
def previews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", digest(text.preview(F.col("text"))).alias("preview_md5"))


@query("select 'run-' || strftime(ts, '%Y%m%d-%H%M%S') as name, count(*) as n from events group by name")
def run_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy(text.run_name("run-", F.col("ts")).alias("name")).agg(F.count(F.lit(1)).alias("n"))


@query("select l_quantity, round_even(l_quantity / 4, 1) as tenths, round_even(l_quantity / 4, 0) as whole, count(*) as n from lineitem group by l_quantity")
def rounded_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("l_quantity")
    counts = table(spark, sf_dir, "lineitem").groupBy("l_quantity").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("l_quantity", text.half_even(q / 4, 1).alias("tenths"), text.half_even(q / 4).alias("whole"), "n")


@query("""
with j as (select event_id, json_extract_string(props, '$.k') as k from events)
select event_id, md5('{"a": [1, {"k": ' || k || '}], "é": "x"}') as compact_md5,
  md5('{' || chr(10) || '  "a": [' || chr(10) || '    1,' || chr(10) || '    {' || chr(10) || '      "k": ' || k || chr(10) || '    }' || chr(10) || '  ],' || chr(10) || '  "é": "x"' || chr(10) || '}') as pretty_md5 from j""")
def rendered_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit('{"a":[1,'), "props", F.lit('],"\\u00e9":  "x"}'))
    return table(spark, sf_dir, "events").select("event_id", digest(rendering.compact_json(raw)).alias("compact_md5"), digest(rendering.pretty_json(raw)).alias("pretty_md5"))


@query(r"""
select lang, count(*) as n, cast(sum(case when trim(regexp_replace(regexp_replace(text, '[^\p{L}]', '', 'g'), '\s', '', 'g')) = '' then 0 else 1 end) as bigint) as lettered, round(avg(100.0 * (length(text) - length(replace(text, ' ', ''))) / nullif(length(text), 0)), 4) as spaces_pct from documents group by lang""")
def space_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    share = text.percent_less(F.length("text"), F.length(F.replace("text", F.lit(" "), F.lit(""))))
    return docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("text").rlike(r"\p{L}")).alias("lettered"), F.round(F.avg(share), 4).alias("spaces_pct"))
