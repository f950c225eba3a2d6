"""Profiles and reports: sizes, tokens, completeness, quality flags, consistency."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html_tree
from ..functions.kinds import SIMPLE, struct
from ..functions.text import complete, percent_less
from ..functions.tokens import approximate, approximate_count
from ..sources import registry, scratch
from . import quantiles


@F.pandas_udf(struct(html_tree.PROFILE))
def html_profile(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    names = [x.split()[0] for x in html_tree.PROFILE.split(", ")]
    for texts in batches:
        yield pd.DataFrame([html_tree.profile(t) for t in texts], columns=names)


@F.pandas_udf(struct(html_tree.OVERVIEW))
def html_overview(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        yield pd.DataFrame([html_tree.overview(t) for t in texts], columns=[x.split()[0] for x in html_tree.OVERVIEW.split(", ")])


@F.pandas_udf(SIMPLE["array<string>"])
def html_tags(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([html_tree.tag_names(t) for t in texts], dtype="object")


@F.pandas_udf(struct(", ".join(f"{x}_{y} long" for x in html_tree.LEVELS for y in ("chars", "tokens"))))
def html_level_counts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """Characters and approximate tokens of each level; the cleaned texts stay in Python."""
    names = [f"{x}_{y}" for x in html_tree.LEVELS for y in ("chars", "tokens")]
    for texts in batches:
        made = [[None] * len(names) if t is None else [n for x in (t, *html_tree.cleaned(t)) for n in (len(x), approximate_count(x))] for t in texts]
        yield pd.DataFrame(made, columns=names, dtype="Int64")


@F.pandas_udf(struct("minimal string, moderate string, aggressive string"))
def html_levels(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        yield pd.DataFrame([html_tree.cleaned(t) for t in texts], columns=list(html_tree.LEVELS[1:]))


def profiled(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages with the columns of the profile; each page is parsed once. Filter before, not after."""
    made = pages.select(F.struct("*").alias("row"), html_profile.asNondeterministic()(F.col(html)).alias("profile"))
    return made.select("row.*", "profile.*")


def _long(rows: DataFrame, by: dict[str, Column], values: list[str]) -> DataFrame:
    """The columns of ``by``, variable and value (double) of each value of each row."""
    each = [F.struct(F.lit(v).alias("variable"), F.col(v).cast("double").alias("value")) for v in values]
    return rows.select(*[c.alias(n) for n, c in by.items()], F.explode(F.array(*each)).alias("x")).select(*by, "x.variable", "x.value")


def size_summary(rows: DataFrame, by: str) -> DataFrame:
    """Sizes, tags, words and depth of profiled rows by group, to one decimal."""
    one = lambda c, name: F.round(c, 1).alias(name)
    measures = {"html_size": "size", "tag_count": "tags", "word_count": "words"}
    means = rows.groupBy(F.col(by).alias("g")).agg(
        F.count(F.lit(1)).alias("n"), one(F.avg("html_size"), "size_mean"), F.min("html_size").alias("size_min"), F.max("html_size").alias("size_max"), one(F.avg("tag_count"), "tags_mean"),
        one(F.avg("word_count"), "words_mean"), one(F.avg("nesting_depth"), "depth_mean"), F.max("nesting_depth").alias("depth_max"),
    )
    middle = _medians(_long(rows, {"g": F.col(by)}, list(measures)), ["g"])
    middle = middle.groupBy(F.col("g").alias("mg")).agg(*[one(F.max(F.when(F.col("variable") == m, F.col("median"))), f"{x}_median") for m, x in measures.items()])
    joined = means.join(middle, F.col("g").eqNullSafe(F.col("mg")))
    return joined.select(F.col("g").alias(by), "n", "size_mean", "size_median", "size_min", "size_max", "tags_mean", "tags_median", "words_mean", "words_median", "depth_mean", "depth_max")


def _medians(long: DataFrame, by: list[str]) -> DataFrame:
    """The columns of ``by``, variable, median of _long rows."""
    counts = quantiles.counted(long, {x: F.col(x) for x in (*by, "variable")}, F.col("value"))
    return quantiles.quantiles(counts, [*by, "variable"], [0.5]).select(*by, "variable", F.get("q", F.lit(0)).alias("median"))


def _tally(rows: DataFrame, by: dict[str, Column], values: list[str]) -> DataFrame:
    """The columns of ``by``, variable, v (null too), c: how often each value occurs, written once. All statistics come from these counts, so rows are read once."""
    long = _long(rows, by, values).withColumnRenamed("value", "v")
    return scratch.kept(long.groupBy(*by, "variable", "v").agg(F.count(F.lit(1)).alias("c")), "tally")


def _weighted_mean() -> Column:
    return F.try_divide(F.sum(F.col("v") * F.col("c")), F.sum(F.when(F.col("v").isNotNull(), F.col("c"))))


def grouped_stats(rows: DataFrame, by: str, values: list[str]) -> DataFrame:
    """Mean, median, min, max of each value by group and over all (null group)."""
    tally = _tally(rows, {"g": F.col(by)}, values)
    totals = tally.groupBy("variable", "v").agg(F.sum("c").alias("c")).select(F.lit(None).cast(rows.schema[by].dataType).alias("g"), "variable", "v", "c", F.lit(1).alias("total"))
    both = tally.withColumn("total", F.lit(0)).unionByName(totals)
    plain = both.groupBy("g", "total", "variable").agg(F.sum("c").alias("n"), F.round(_weighted_mean(), 4).alias("mean"), F.min("v").alias("min"), F.max("v").alias("max"))
    middle = quantiles.quantiles(both.filter("v is not null"), ["g", "variable", "total"], [0.5]).select(F.col("g").alias("mg"), F.col("variable").alias("mv"), F.col("total").alias("mt"), F.get("q", F.lit(0)).alias("median"))
    joined = plain.join(middle, F.col("g").eqNullSafe(F.col("mg")) & (F.col("variable") == F.col("mv")) & (F.col("total") == F.col("mt")), "left")
    of = lambda v, x: F.max(F.when(F.col("variable") == v, F.col(x)))
    kind = lambda v, x: rows.schema[v].dataType if x in ("min", "max") else "double"
    wide = joined.groupBy("g", "total").agg(F.max("n").alias("n"), *[of(v, x).cast(kind(v, x)).alias(f"{v}_{x}") for v in values for x in ("mean", "median", "min", "max")])
    return wide.select(F.col("g").alias(by), F.col("total").alias("is_total"), "n", *[f"{v}_{x}" for v in values for x in ("mean", "median", "min", "max")])


def overall(rows: DataFrame, value: str) -> DataFrame:
    """Count, sum, mean, max, p95 (interpolated) and max rounded up to a thousand."""
    v = F.col(value)
    means = rows.agg(F.count(v).alias("n"), F.sum(v).alias("total"), F.round(F.avg(v), 4).alias("mean"), F.max(v).alias("max"), (F.ceil(F.max(v) / 1000) * 1000).cast("long").alias("max_to_thousand"))
    p95 = quantiles.quantiles(quantiles.counted(rows, {}, v), [], [0.95]).select(F.round(F.get("q", F.lit(0)), 4).alias("p95"))
    return means.join(F.broadcast(p95)).select("n", "total", "mean", "max", "p95", "max_to_thousand")  # one row each


def described(rows: DataFrame, values: list[str]) -> DataFrame:
    """variable, count, mean, std, min, quartiles (interpolated), max; one row for each value."""
    tally = _tally(rows, {}, values)
    there = F.sum(F.when(F.col("v").isNotNull(), F.col("c")).otherwise(0))
    means = tally.groupBy(F.col("variable").alias("name")).agg(there.alias("count"), _weighted_mean().alias("mean"), F.min("v").alias("min"), F.max("v").alias("max"))
    off = F.col("v") - F.col("mean")
    spread = tally.join(F.broadcast(means), F.col("variable") == F.col("name")).groupBy("name", "count", "mean", "min", "max").agg(F.sqrt(F.try_divide(F.sum(off * off * F.col("c")), F.nullif(F.col("count"), F.lit(1)) - 1)).alias("std"))  # a row for each value
    found = quantiles.quantiles(tally.filter("v is not null"), ["variable"], [0.25, 0.5, 0.75])
    q = [F.round(F.get("q", F.lit(i)), 4).alias(n) for i, n in enumerate(("q25", "q50", "q75"))]
    return spread.join(found, F.col("name") == F.col("variable"), "left").select(F.col("name").alias("variable"), "count", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), "min", *q, "max")


def box_plot(rows: DataFrame, by: str, value: str) -> DataFrame:
    """Least, quartiles and greatest of each group; groups without a value have no row."""
    five = quantiles.quantiles(quantiles.counted(rows, {by: F.col(by)}, F.col(value)), [by], [0.0, 0.25, 0.5, 0.75, 1.0])
    return five.select(by, *[F.round(F.get("q", F.lit(i)), 4).alias(n) for i, n in enumerate(("low", "q1", "middle", "q3", "high"))])


def histogram(rows: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """bin, n for equal bins from the least to the greatest value, which falls into the last; empty bins have no row."""
    low, high = rows.agg(F.min(value).cast("double"), F.max(value).cast("double")).first()
    if low is None:
        return rows.sparkSession.createDataFrame([], "bin int, n long")
    width = (high - low) / bins or 1.0
    place = F.least(F.floor((F.col(value) - low) / width), F.lit(bins - 1)).cast("int")
    return rows.filter(F.col(value).isNotNull()).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def zero_filled(rows: DataFrame, dimension: DataFrame, by: str) -> DataFrame:
    """n for each member of a dimension, 0 where there are no rows; other values don't count."""
    counts = rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    return dimension.join(counts, by, "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


def option_labels(counts: DataFrame, by: str, target: int = registry.TARGET) -> DataFrame:
    """counts(by, n) with a label such as ``[Complete] recipe (12/10)``."""
    text = F.concat(by, F.lit(" ("), F.col("n").cast("string"), F.lit(f"/{target})"))
    return counts.withColumn("label", F.when(F.col("n") >= target, F.concat(F.lit("[Complete] "), text)).otherwise(text))


def label_fields(rows: DataFrame, by: str, raw: str) -> DataFrame:
    """by, field, is_complete for each top-level field of each label (JSON text). A label that isn't JSON has no fields."""
    view = rows.select(F.col(by).alias(by), F.try_parse_json(raw).alias("v"))
    fields = view.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col("v").outer()))
    return fields.select(by, F.col("key").alias("field"), complete(F.try_variant_get("value", "$", "string")).alias("is_complete"))


def completeness(rows: DataFrame, by: str, raw: str) -> DataFrame:
    """For each type and field: occurrences, coverage_pct (complete out of all rows of the type), completeness_pct (out of the occurrences)."""
    totals = rows.groupBy(by).agg(F.count(F.lit(1)).alias("total"))
    fields = label_fields(rows, by, raw).groupBy(by, "field").agg(F.count(F.lit(1)).alias("present"), F.count_if("is_complete").alias("done"))
    return fields.join(totals, by).select(by, "field", "present", "total", F.round(F.col("done") * 100.0 / F.col("total"), 4).alias("coverage_pct"), F.round(F.col("done") * 100.0 / F.col("present"), 4).alias("completeness_pct"))


def quality_flags(rows: DataFrame, raw: str = "expected_json") -> DataFrame:
    """type and the flags and counts that apply to it, null where they don't. A flag asks for a value that isn't null, empty, false or an empty list; a label that isn't JSON has none."""
    v = F.try_parse_json(raw)
    text = lambda f: F.try_variant_get(v, f"$.{f}", "string")
    there = lambda f: F.coalesce(~text(f).isin("", "[]", "{}", "false", "0"), F.lit(False))
    named = lambda f: there(f) & (text(f) != "TODO")
    count = lambda f: F.coalesce(F.size(F.try_variant_get(v, f"$.{f}", "array<variant>")), F.lit(0))
    of = lambda kind, x: F.when(F.col("type") == kind, x)
    either = lambda a, b: F.when(F.col("type").isin("job_posting", "event"), F.when(F.col("type") == "job_posting", a).otherwise(b))
    return rows.select(
        "type", of("recipe", there("ingredients")).alias("has_ingredients"), of("recipe", count("ingredients")).alias("ingredient_count"), of("recipe", there("instructions")).alias("has_instructions"), of("recipe", count("instructions")).alias("instruction_count"),
        of("recipe", there("cook_time") | there("prep_time")).alias("has_timing"), of("recipe", there("rating")).alias("has_rating"), either(named("title"), there("title")).alias("has_title"), of("job_posting", there("company")).alias("has_company"),
        of("event", named("datetime")).alias("has_datetime"), either(there("location"), there("location")).alias("has_location"), of("event", there("price")).alias("has_price"), either(there("description"), there("description")).alias("has_description"),
        of("job_posting", F.length(F.coalesce(text("description"), F.lit("")))).alias("description_length"),
    )


def quality_summary(flags: DataFrame) -> DataFrame:
    """type, metric, n, mean (share for a flag), median of quality_flags; metrics that don't apply have no row."""
    names = [c for c in flags.columns if c != "type"]
    long = flags.select("type", *[F.col(c).cast("double").alias(c) for c in names]).unpivot("type", names, "metric", "value").filter("value is not null")
    means = long.groupBy("type", "metric").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 4).alias("mean"))
    counts = quantiles.counted(long, {"of_type": F.col("type"), "of_metric": F.col("metric")}, F.col("value"))
    middle = quantiles.quantiles(counts, ["of_type", "of_metric"], [0.5])
    same = F.col("type").eqNullSafe(F.col("of_type")) & (F.col("metric") == F.col("of_metric"))
    return means.join(middle, same).select("type", "metric", "n", "mean", F.get("q", F.lit(0)).alias("median"))


def canonical(raw: Column) -> Column:
    """JSON with sorted keys: equal for equal values, whatever the order of keys. Null for what isn't JSON."""
    return F.try_parse_json(raw).cast("string")


def unreadable(rows: DataFrame, raw: str) -> DataFrame:
    """n rows, and n_unreadable: labels that aren't JSON, which the other reports pass over."""
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.try_parse_json(raw).isNull()).alias("n_unreadable"))


def consistent_groups(rows: DataFrame, by: str, raw: str) -> DataFrame:
    """by, n, consistent: whether all labels of a group are equal. Minima and maxima are enough, so a large group is summed up before it meets."""
    text = canonical(F.col(raw))
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"), (F.min(text).eqNullSafe(F.max(text)) & (F.count(text) == F.count(F.lit(1)))).alias("consistent"))


def consistency(rows: DataFrame, by: str, raw: str) -> DataFrame:
    """Rows in consistent groups out of all rows."""
    return consistent_groups(rows, by, raw).agg(F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(F.col("consistent"), F.col("n"))), F.lit(0)).alias("consistent_rows"), F.count(F.lit(1)).alias("groups"))


def upper_median(rows: DataFrame, value: str) -> DataFrame:
    """min, max, mean and the element at n div 2 of the sorted values: the discrete median from above."""
    v = F.col(value)
    upper = quantiles.quantiles(quantiles.counted(rows, {}, v), [], [0.5], upper=True).select(F.get("q", F.lit(0)).alias("upper_median"))
    return rows.agg(F.min(v).alias("min"), F.max(v).alias("max"), F.round(F.avg(v), 4).alias("mean")).join(F.broadcast(upper))  # one row each


def unlike_original(rows: DataFrame, base: str, variation: str, raw: str) -> DataFrame:
    """base, n_unlike: variations whose label differs from that of variation 0 of their base. Originals are summed up before they meet their variations."""
    text = canonical(F.col(raw))
    view = rows.select(F.col(base).alias("base"), F.col(variation).alias("variation"), text.alias("text"))
    first = view.filter(F.col("variation") == 0).groupBy("base").agg(F.min("text").alias("first"))
    return view.join(first, "base").groupBy("base").agg(F.count_if(~F.col("text").eqNullSafe(F.col("first"))).alias("n_unlike")).withColumnRenamed("base", base)


def validation_tally(rows: DataFrame, html: str, raw: str, required: list[str]) -> DataFrame:
    """n, html_ok (not blank), json_ok (parses), keys_ok (an object with all required keys)."""
    v = F.try_parse_json(raw)
    keys = F.coalesce(F.json_object_keys(F.when(F.schema_of_variant(v).startswith("OBJECT"), F.col(raw))), F.array().cast("array<string>"))
    complete_keys = F.size(F.array_except(F.array(*[F.lit(k) for k in required]), keys)) == 0
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(F.trim(html), F.lit("")) != "").alias("html_ok"), F.count_if(v.isNotNull()).alias("json_ok"), F.count_if(v.isNotNull() & complete_keys).alias("keys_ok"))


def token_levels(pages: DataFrame, key: str, html: str = "html", json: str | None = None, count=approximate) -> DataFrame:
    """key and, for each level of cleaning, chars, tokens, percent less than the original, and label tokens per html token."""
    label = count(F.col(json)) if json else F.lit(None).cast("long")
    if count is approximate:
        counted = pages.select(F.col(key).alias("id"), label.alias("label"), html_level_counts.asNondeterministic()(F.col(html)).alias("c"))
        out = counted.select(F.col("id").alias(key), "c.*", F.col("label").alias("json_tokens"))
    else:
        made = pages.select(F.col(key).alias("id"), F.col(html).alias("original"), label.alias("label"), html_levels.asNondeterministic()(F.col(html)).alias("c"))
        texts = {"original": F.col("original"), **{x: F.col(f"c.{x}") for x in html_tree.LEVELS[1:]}}
        out = made.select(F.col("id").alias(key), *[c for name, t in texts.items() for c in (F.length(t).cast("long").alias(f"{name}_chars"), count(t).alias(f"{name}_tokens"))], F.col("label").alias("json_tokens"))
    return out.withColumns({f"{x}_reduction_pct": percent_less(F.col("original_tokens"), F.col(f"{x}_tokens")) for x in html_tree.LEVELS[1:]} | {f"{x}_snr": F.try_divide(F.col("json_tokens").cast("double"), F.col(f"{x}_tokens")) for x in html_tree.LEVELS})


def level_stats(levels: DataFrame) -> DataFrame:
    """level, n, mean, median, min, max of tokens, and the mean reduction."""
    long = levels.select(F.explode(F.array(*[F.struct(F.lit(x).alias("level"), F.col(f"{x}_tokens").alias("tokens"), (F.col(f"{x}_reduction_pct") if x != "original" else F.lit(None).cast("double")).alias("less")) for x in html_tree.LEVELS])).alias("x")).select("x.*")
    means = long.groupBy("level").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("tokens"), 4).alias("tokens_mean"), F.min("tokens").alias("tokens_min"), F.max("tokens").alias("tokens_max"), F.round(F.avg("less"), 4).alias("reduction_mean"))
    middle = _medians(_long(levels, {}, [f"{x}_tokens" for x in html_tree.LEVELS]), []).select(F.regexp_replace("variable", "_tokens$", "").alias("of"), "median")
    return means.join(middle, F.col("level") == F.col("of"), "left").select("level", "n", "tokens_mean", F.col("median").alias("tokens_median"), "tokens_min", "tokens_max", "reduction_mean")


def sample_means(pages: DataFrame, key: str, html: str = "html", limit: int = 50) -> DataFrame:
    """n, original_mean and moderate_mean of tokens, and the mean reduction, of the first rows by key; others are not parsed."""
    levels = token_levels(pages.select(key, html).orderBy(key).limit(limit), key, html)
    return levels.agg(F.count(F.lit(1)).alias("n"), *[F.round(F.avg(f"{x}_tokens"), 4).alias(f"{x}_mean") for x in ("original", "moderate")], F.round(F.avg("moderate_reduction_pct"), 4).alias("reduction_mean"))


def context_fit(levels: DataFrame) -> DataFrame:
    """context_window, level, fits: rows whose tokens fit. One pass: a count for each of the few windows and levels."""
    names = [(w, x) for w in registry.CONTEXT_WINDOWS for x in html_tree.LEVELS]
    counts = levels.agg(*[F.count_if(F.col(f"{x}_tokens") <= w).alias(f"{x}_{w}") for w, x in names])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(w).alias("context_window"), F.lit(x).alias("level"), F.col(f"{x}_{w}").alias("fits")) for w, x in names])).alias("r")).select("r.*")


def signal_to_noise(levels: DataFrame) -> DataFrame:
    """level, snr, inverse: the mean of the ratios and its inverse (not the mean of inverses)."""
    long = levels.select(F.explode(F.array(*[F.struct(F.lit(x).alias("level"), F.col(f"{x}_snr").alias("snr")) for x in html_tree.LEVELS])).alias("r")).select("r.*")
    return long.groupBy("level").agg(F.round(F.avg("snr"), 6).alias("snr"), F.round(F.try_divide(F.lit(1.0), F.avg("snr")), 6).alias("inverse"))


def top_tags(pages: DataFrame, k: int = 15, html: str = "html") -> DataFrame:
    """tag, n of the k most frequent tags; ties by name."""
    tags = pages.select(F.explode(html_tags(F.col(html))).alias("tag"))
    return tags.groupBy("tag").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "tag").limit(k)
