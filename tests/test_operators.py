import hashlib
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.operators import dataset as d
from tagloom.operators import evaluate as e
from tagloom.operators import quantiles as q
from tagloom.operators import reports as r
from tagloom.operators.order import numbered
from tagloom.sources import records, registry, sinks
from tagloom.sources.tables import spread, table

FILES = {
    "annotation_recipe_1": '{"example_html": "<p>é</p>", "expected_json": {"type": "recipe", "b": 1.5, "a": null}}',
    "annotation_event_2": '{"example_html": null, "expected_json": {"type": null}}',
    "annotation_event_3": '{"example_html": "x", "expected_json": {"type": "person"}}',
    "annotation_bad_json": '{"example_html": ',
    "annotation_no_html": '{"expected_json": {"type": "x"}}',
    "annotation_no_label": '{"example_html": "x"}',
    "annotation_text_label": '{"example_html": "x", "expected_json": "type"}',
    "annotation_no_type": '{"example_html": "x", "expected_json": {}}',
    "annotation_list": "[1]",
    "other": "{}",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("annotations")
    for name, text in FILES.items():
        (path / f"{name}.json").write_text(text)
    return f"file://{path}"


def test_annotations(spark, folder):
    rows = records.annotation_files(spark, folder)
    assert rows.count() == len(FILES) - 1
    good = {x.file: x for x in records.valid(rows).collect()}
    assert set(good) == {"annotation_recipe_1.json", "annotation_event_2.json", "annotation_event_3.json"}
    assert good["annotation_recipe_1.json"].type == "recipe" and good["annotation_event_2.json"].type is None
    assert {x.file: x.reason for x in records.rejects(rows).collect()} == {
        "annotation_bad_json.json": "not JSON", "annotation_no_html.json": "no example_html", "annotation_no_label.json": "no expected_json",
        "annotation_text_label.json": "expected_json is not an object", "annotation_no_type.json": "no type", "annotation_list.json": "not an object",
    }
    named = {x.file: (x.type_by_name, x.disagrees) for x in records.typed_by_name(rows).collect()}
    assert named["annotation_recipe_1.json"] == ("recipe", False) and named["annotation_event_3.json"] == ("event", True) and len(named) == 3


def test_lines_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(2, 'a "q"\n é😀', '{"type": "x", "n": 1.50}'), (1, "", "{}")], "i int, example_html string, expected_json string")
    sinks.write_lines(df, sinks.golden_line(F.col("example_html"), F.col("expected_json")), f"{tmp_path}/out", order="i")
    back = [json.loads(x.raw) for x in records.json_lines(spark, f"{tmp_path}/out").collect()]
    assert back == [{"example_html": "", "expected_json": {}}, {"example_html": 'a "q"\n é😀', "expected_json": {"type": "x", "n": 1.5}}]
    (tmp_path / "bad.jsonl").write_text('{"a": 1}\n\n{"b": 2}\n')
    with pytest.raises(Exception, match="not a line of JSON"):
        records.json_lines(spark, f"{tmp_path}/bad.jsonl").collect()
    assert records.json_lines(spark, f"{tmp_path}/bad.jsonl", strict=False).count() == 3


def test_other_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "train", None), (2, "test", "x,y")], "i int, split string, s string")
    sinks.write_splits(df, f"{tmp_path}/splits")
    assert spark.read.parquet(f"{tmp_path}/splits/split=train").count() == 1
    sinks.write_csv(df, f"{tmp_path}/csv")
    assert spark.read.csv(f"{tmp_path}/csv", header=True).columns == ["i", "split", "s"]
    sinks.write_report(df, f"{tmp_path}/json")
    assert any('"s":null' in x.value for x in spark.read.text(f"{tmp_path}/json").collect())


def test_domain_list(spark, tmp_path):
    text = "# Title\n\n**Note: a.b**\n- **one.com/path** - first\n- two.org - second\n  - **three.net** (x) **four.io**\n- one.com again\n- nodot\n* five.de\n- **one.com** - again\n"
    (tmp_path / "list.md").write_text(text)
    got = records.domain_list(spark, f"{tmp_path}/list.md").orderBy("place").collect()
    assert [x.url for x in got] == ["https://one.com", "https://two.org", "https://three.net"]
    (tmp_path / "urls.txt").write_text("https://a.org/x\n\nhttp://b.org\n")
    assert [x.host for x in records.url_list(spark, f"{tmp_path}/urls.txt").collect()] == ["a.org", "b.org"]


def shared_out(counts, total, seed):
    """Largest remainders in plain Python."""
    n = sum(counts.values())
    parts = {k: c * total // n if n else 0 for k, c in counts.items()}
    name = lambda k: "" if k is None else str(k)
    order = sorted(counts, key=lambda k: (-(counts[k] * total % n if n else 0), hashlib.md5(f"{seed}:{name(k)}".encode()).hexdigest(), name(k)))
    for k in order[: total - sum(parts.values())]:
        parts[k] += 1
    return parts


@pytest.mark.parametrize("few", [0, 10_000])
@pytest.mark.parametrize("sizes", [{"c": 2, None: 7}, {"c": 3, "d": 10, None: 11}, {"c": 1000, "d": 2, "e": 37}, {f"k{i}": 9 for i in range(100)}])
def test_split_sizes(spark, sizes, few, monkeypatch):
    monkeypatch.setattr(d, "FEW_CLASSES", few)
    rows = spark.createDataFrame([(i, k, "x") for i, k in enumerate(k for k, n in sizes.items() for _ in range(n))], "id long, type string, train string")
    out = d.stratified_split(rows.repartition(3), "id", "type")
    got = {(x.type, x.split): x.c for x in out.groupBy("type", "split").agg(F.count("*").alias("c")).collect()}
    n = sum(sizes.values())
    train = shared_out(sizes, n * 8 // 10, 42)
    left = {k: c - train[k] for k, c in sizes.items()}
    val = shared_out(left, sum(left.values()) // 2, 43)
    assert {(k, s): c for k in sizes for s, c in zip(d.SPLITS, (train[k], val[k], left[k] - val[k]), strict=True) if c} == got
    assert [sum(c for (_, s), c in got.items() if s == name) for name in d.SPLITS] == [n * 8 // 10, (n - n * 8 // 10) // 2, n - n * 8 // 10 - (n - n * 8 // 10) // 2]
    assert {x.id: x.split for x in out.collect()} == {x.id: x.split for x in d.stratified_split(rows.coalesce(1), "id", "type").collect()}


def test_small_classes(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id long, type string")
    assert [x.type for x in d.small_classes(rows, "type").collect()] == ["b"]
    with pytest.raises(Exception, match="fewer than 2 rows"):
        d.stratified_split(rows, "id", "type").collect()
    assert d.stratified_split(rows, "id", "type", least=1).count() == 3
    assert d.stratified_split(rows.limit(0), "id", "type").count() == 0


def test_numbered(spark):
    rows = spark.createDataFrame([(i * 7 % 100 if i % 9 else None, i, "x") for i in range(100)], "k int, place int, n string").repartition(5)
    got = sorted((x.place, x.row.k, x.row.place, x.n) for x in numbered(rows, F.col("k"), F.col("place")).collect())
    assert [x[0] for x in got] == list(range(100)) and {x[3] for x in got} == {100}
    want = sorted(((r.k, r.place) for r in rows.collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    assert [x[1:3] for x in got] == want
    down = sorted((x.place, x.row.k, x.row.place) for x in numbered(rows, F.col("k"), F.col("place"), descending=True).collect())
    assert [x[1:] for x in down] == sorted(want, key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))
    assert numbered(rows.limit(0), F.col("k")).count() == 0


def test_columns_of_any_name_stay(spark):
    rows = spark.createDataFrame([(i, "<div><p>x</p></div>", i + 5, "m", "f") for i in range(3)], "id long, example_html string, __range int, __v string, first string")
    out = d.with_quota(rows, "id", 6)
    assert out.columns == [*rows.columns, "ordinal", "variation_id"] and {(x.id, x["__range"], x["__v"], x["first"]) for x in out.collect()} == {(i, i + 5, "m", "f") for i in range(3)}
    made = d.variations(out, "id")
    assert made.columns == [*out.columns, "metadata"] and {x["__v"] for x in made.collect()} == {"m"}
    with pytest.raises(ValueError, match="clash"):
        d.with_quota(rows.withColumn("ordinal", F.lit(1)), "id", 6)
    with pytest.raises(ValueError, match="clash"):
        d.variations(out.withColumn("metadata", F.lit(1)), "id")
    assert d.variations(out.withColumn("metadata", F.lit(1)), "id", metadata="lineage").columns[-2:] == ["metadata", "lineage"]
    odd = spark.createDataFrame([(1, "<p>x", "a", "b")], "page_id long, html string, __p string, profile string")
    assert r.profiled(odd).first()["profile"] == "b" and r.profiled(odd).columns[:4] == odd.columns
    pairs = spark.createDataFrame([("a", "a", 1, "z")], "prediction string, reference string, __s int, edits string")
    assert e.scored(pairs).first()["edits"] == "z"
    notes = spark.createDataFrame([(1, 0, "{}", "q"), (1, 1, "[]", "q")], "base int, variation int, text string, first string")
    assert r.unlike_original(notes, "base", "variation", "text").first().n_unlike == 1


def test_malformed_labels(spark):
    rows = spark.createDataFrame([("recipe", "{"), ("recipe", '{"ingredients": ["a"]}'), ("recipe", None)], "type string, expected_json string")
    assert [tuple(x) for x in r.completeness(rows, "type", "expected_json").collect()] == [("recipe", "ingredients", 1, 3, round(100 / 3, 4), 100.0)]
    assert r.quality_summary(r.quality_flags(rows)).filter("metric = 'has_ingredients'").first().n == 3
    assert tuple(r.consistency(rows, "type", "expected_json").first()) == (3, 0, 1)
    assert tuple(r.unreadable(rows, "expected_json").first()) == (3, 2)


@pytest.mark.parametrize("side", ["references", "base", "tuned"])
def test_pairs_are_one_to_one(spark, side):
    refs = spark.createDataFrame([(1, "a"), (2, "b")], "example_idx int, reference string")
    preds = spark.createDataFrame([(1, "a"), (2, "b")], "example_idx int, prediction string")
    three = {"references": refs, "base": preds, "tuned": preds}
    assert e.samples(*three.values()).count() == 2
    twice = three | {side: three[side].union(three[side].filter("example_idx = 1"))}
    for call in (e.comparison, e.samples):
        with pytest.raises(Exception, match="several rows for example 1"):
            call(*twice.values()).collect()
    gone = three | {side: three[side].filter("example_idx = 2")}
    with pytest.raises(Exception, match="no pair for example 1"):
        e.samples(*gone.values()).collect()


@pytest.mark.parametrize(("n", "target"), [(1, 5), (3, 3), (4, 2), (3, 11), (7, 100), (0, 5)])
def test_quota(spark, n, target):
    rows = spark.range(n).withColumn("html", F.lit("<p>")).repartition(3)
    out = sorted(((x.id, x.ordinal, x.variation_id) for x in d.with_quota(rows, "id", target).collect()))
    want, v = [], 0
    missing = max(target - n, 0)
    for i in range(n):
        want.append((i, 0, None))
        for k in range(missing // n + (i < missing % n)):
            want.append((i, k + 1, v))
            v += 1
    assert out == want


def test_variations(spark):
    page = "<html><head></head><body><div><p>x</p></div></body></html>"
    rows = spark.createDataFrame([(i, page) for i in range(3)], "id long, example_html string")
    out = d.variations(d.with_quota(rows, "id", 12), "id")
    got = {(x.id, x.ordinal): (x.example_html, x.metadata) for x in out.collect()}
    assert len(got) == 12 and all((m is None) == (o == 0) for (_, o), (_, m) in got.items())
    assert all(h == page for (_, o), (h, _) in got.items() if o == 0)
    again = {(x.id, x.ordinal): (x.example_html, x.metadata) for x in d.variations(d.with_quota(rows.coalesce(1), "id", 12), "id").collect()}
    assert got == again


def test_chat(spark):
    rows = spark.createDataFrame([(1, "event", "<p>", "{}")], "id int, type string, example_html string, expected_json string")
    made = d.chat_examples(rows, registry.prompts(spark))
    m = made.first().messages
    assert m[0].content == f"{registry.INSTRUCTION}\n\nHTML:\n<p>\n\n{registry.PROMPTS['event']}" and m[1].content == "{}"
    cut = d.from_chat(made.drop("prompt"), registry.prompts(spark)).first()
    assert (cut.html, cut.answer) == ("<p>", "{}") and cut.html_and_prompt.startswith("<p>\n\nReturn")
    assert d.within_budget(made).count() == 1 and d.within_budget(made, 10).count() == 0
    with pytest.raises(Exception, match="unknown type: person"):
        d.chat_examples(rows.withColumn("type", F.lit("person")), registry.prompts(spark)).collect()
    assert made.select(d.one_text(F.col("messages"), "[", "]")).first()[0].startswith("[user\n")


def test_hosts(spark):
    rows = spark.createDataFrame([(f"h{i % 3}", f"u{i}") for i in range(50)] + [("solo", "s")], "host string, url string")
    got = d.few_of_each_host(rows, "host", "url").groupBy("host").count().collect()
    assert {x.host: x["count"] for x in got} == {"h0": 2, "h1": 2, "h2": 2, "solo": 1}


def test_completeness_denominators(spark):
    raws = ['{"type": "r", "a": "x", "b": "TODO"}', '{"type": "r", "a": null}', '{"type": "r", "b": ["TODO"]}']
    rows = spark.createDataFrame([("r", x) for x in raws], "type string, raw string")
    got = {x.field: (x.present, x.total, round(x.coverage_pct, 1), x.completeness_pct) for x in r.completeness(rows, "type", "raw").collect()}
    assert got["a"] == (2, 3, 33.3, 50.0) and got["b"] == (2, 3, 33.3, 50.0)


def test_consistency(spark):
    rows = spark.createDataFrame([(1, '{"a":1,"b":2}'), (1, '{"b":2,"a":1}'), (2, "{}"), (2, '{"a":1}'), (3, "{}")], "base int, raw string")
    x = r.consistency(rows, "base", "raw").first()
    assert (x["rows"], x.consistent_rows, x.groups) == (5, 3, 3)


def test_statistics(spark):
    rows = spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "v int")
    x = r.described(rows, ["v"]).first()
    assert (x.q25, x.q50, x.q75, x["count"]) == (1.75, 2.5, 3.25, 4)
    assert r.upper_median(rows, "v").first().upper_median == 3
    assert {x.bin: x.n for x in r.histogram(rows, "v", 3).collect()} == {0: 1, 1: 1, 2: 2}
    assert r.histogram(rows.filter("v > 9"), "v").count() == 0


def test_label_quality(spark):
    rows = spark.createDataFrame([("recipe", '{"type":"recipe","ingredients":["a","b"],"instructions":[],"cook_time":"5"}'), ("job_posting", '{"title":"TODO","company":"","description":"abc"}')], "type string, expected_json string")
    got = {x.type: x for x in r.quality_flags(rows).collect()}
    assert (got["recipe"].has_ingredients, got["recipe"].ingredient_count, got["recipe"].has_instructions, got["recipe"].has_timing, got["recipe"].has_title) == (True, 2, False, True, None)
    assert (got["job_posting"].has_title, got["job_posting"].has_company, got["job_posting"].description_length) == (False, False, 3)
    assert r.quality_summary(r.quality_flags(rows)).filter("metric = 'ingredient_count'").first().mean == 2


def test_evaluation(spark):
    refs = spark.createDataFrame([(0, "a b c"), (1, "")], "example_idx int, reference string")
    preds = spark.createDataFrame([(0, "a b c"), (1, None)], "example_idx int, prediction string")
    worse = spark.createDataFrame([(0, "a"), (1, "x")], "example_idx int, prediction string")
    best = {x.metric: x.value for x in e.averaged(e.scored(e.paired(preds, refs))).collect()}
    assert best == {"rouge1": 0.5, "rouge2": 0.5, "rougeL": 0.5, "levenshtein_normalized": 1.0, "levenshtein_avg": 0.0}
    both = {x.metric: x for x in e.compared(e.averaged(e.scored(e.paired(worse, refs))), e.averaged(e.scored(e.paired(preds, refs)))).collect()}
    assert both["levenshtein_avg"].improvement_pct == 100 and both["rouge1"].improvement_pct == 100 and both["rouge2"].improvement_pct == 0
    with pytest.raises(Exception, match="no pair for example"):
        e.paired(preds.limit(1), refs).collect()
    at_once = {x.metric: x for x in e.comparison(refs, worse, preds).collect()}
    assert set(at_once) == set(e.METRICS) and all((at_once[m].base, at_once[m].finetuned, at_once[m].improvement_pct) == (both[m].base, both[m].finetuned, both[m].improvement_pct) for m in both)
    assert {(x.base, x.finetuned, x.improvement_pct) for x in e.comparison(refs.limit(0), worse.limit(0), preds.limit(0)).collect()} == {(0.0, 0.0, 0.0)}
    for short in ((refs, worse, preds.limit(1)), (refs, worse.limit(1), preds), (refs.limit(1), worse, preds)):
        with pytest.raises(Exception, match="no pair for example"):
            e.comparison(*short).collect()
    assert {x.value for x in e.averaged(e.scored(e.paired(preds, refs), stemmed=False).filter("false")).collect()} == {0.0}
    assert e.samples(refs, worse, preds).filter("example_idx = 1").first().finetuned_prediction == ""


def test_token_levels(spark):
    pages = spark.createDataFrame([(1, "<div class='a'><script>x y z</script><p>hello</p></div>", "{}"), (2, "", "{}")], "page_id int, html string, label string")
    got = {x.page_id: x for x in r.token_levels(pages, "page_id", json="label").collect()}
    assert got[1].original_tokens > got[1].minimal_tokens > got[1].moderate_tokens > 0 and got[2].minimal_reduction_pct is None and got[2].original_snr is None
    fit = {(x.context_window, x.level): x.fits for x in r.context_fit(r.token_levels(pages, "page_id")).collect()}
    assert len(fit) == 24 and fit[1024, "original"] == 2


def test_grid_and_validation(spark):
    rows = spark.createDataFrame([(1, "<p>", '{"type": "a", "n": 1}'), (2, " ", "{")], "id long, example_html string, expected_json string")
    grid = d.variation_grid(rows, "id", 3)
    assert sorted((x.base_id, x.ordinal, x.variation_id) for x in grid.collect()) == [(b, o, o or None) for b in (1, 2) for o in range(3)]
    assert tuple(r.validation_tally(rows, "example_html", "expected_json", ["type"]).first()) == (2, 1, 1, 1)
    assert tuple(r.validation_tally(rows, "example_html", "expected_json", ["type", "x"]).first()) == (2, 1, 1, 0)
    pairs = spark.createDataFrame([(1, 0, '{"a":1,"b":2}'), (1, 1, '{"b":2,"a":1}'), (1, 2, '{"a":2}'), (2, 0, "{}")], "base_id int, variation_id int, raw string")
    assert {x.base_id: x.n_unlike for x in r.unlike_original(pairs, "base_id", "variation_id", "raw").collect()} == {1: 1, 2: 0}


def test_chat_lines(spark):
    df = spark.createDataFrame([([("user", "é\n"), ("assistant", None)],)], "messages array<struct<role: string, content: string>>")
    assert json.loads(df.select(sinks.chat_line(F.col("messages"))).first()[0]) == {"messages": [{"role": "user", "content": "é\n"}, {"role": "assistant", "content": None}]}


def test_exploratory_query_makes_the_whole_grid(spark, tmp_path):
    from tagloom.plans import queries

    spark.createDataFrame([(1, "u", "<div><p>a</p></div>"), (2, "u", None)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.QUERIES["exploratory_variations"](spark, str(tmp_path)).collect()
    assert sorted((x.base_id, x.ordinal) for x in got) == [(b, o) for b in (1, 2) for o in range(100)]


def test_sample_means_are_of_the_first_rows(spark):
    rows = [(i, f"<div><script>x</script><p>{'word ' * i}</p></div>") for i in range(1, 81)]
    pages = spark.createDataFrame(rows[::-1], "page_id long, html string").repartition(3)
    first = r.token_levels(pages.filter("page_id <= 50"), "page_id").collect()
    got = r.sample_means(pages, "page_id").first()
    assert got.n == 50 and got.original_mean == round(sum(x.original_tokens for x in first) / 50, 4) and got.moderate_mean == round(sum(x.moderate_tokens for x in first) / 50, 4)
    assert abs(got.reduction_mean - sum(x.moderate_reduction_pct for x in first) / 50) < 1e-3
    assert r.sample_means(pages.limit(0), "page_id").first().n == 0


def test_null_keys_stay_in_the_split(spark):
    rows = spark.createDataFrame([(None, "c", 1), (1, "c", 2), (2, "c", 3), (None, None, 4), (None, "c", 5)], "id long, type string, draw int").withColumn("range", F.lit("x"))
    out = d.stratified_split(rows, "id", "type", least=1)
    assert out.columns == ["id", "type", "draw", "range", "split"] and sorted(x.draw for x in out.collect()) == [1, 2, 3, 4, 5]
    assert d.few_of_each_host(rows.withColumn("u", F.lit("u")), "type", "u", 1).columns == ["id", "type", "draw", "range", "u"]


def test_quantiles_are_the_sorted_values(spark):
    rng = random.Random(4)
    rows = [("hot", float(rng.choice((1, 1, 1, 2, 7)))) for _ in range(3000)] + [("wide", rng.random() * 1e6 - 5e5) for _ in range(2000)] + [(None, 3.0), ("one", -1.0), ("two", 1.0), ("two", 2.0), ("two", None), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.95, 1.0]
    got = {x.g: x for x in q.quantiles(q.counted(df, {"g": F.col("g")}, F.col("v")), ["g"], probabilities).collect()}
    assert set(got) == {"hot", "wide", None, "one", "two"}
    for g, x in got.items():
        values = [v for k, v in rows if k == g and v is not None]
        assert x.size == len(values) and np.allclose(x.q, np.quantile(values, probabilities), rtol=1e-12, atol=1e-9)
    every = [v for _, v in rows if v is not None]
    assert np.allclose(q.quantiles(q.counted(df, {}, F.col("v")), [], probabilities).first().q, np.quantile(every, probabilities))
    assert q.quantiles(q.counted(df, {}, F.col("v")), [], [0.5], upper=True).first().q == [sorted(every)[len(every) // 2]]
    nothing = df.filter("v > 1e9")
    assert r.upper_median(nothing, "v").first().upper_median is None and r.overall(nothing, "v").first().n == 0 and r.box_plot(nothing, "g", "v").count() == 0


def test_statistics_of_groups(spark):
    rows = spark.createDataFrame([("a", 1, 5), ("a", 2, None), ("a", 4, 7), (None, 9, 1)], "g string, v int, w int")
    got = {(x.g, x.is_total): x for x in r.grouped_stats(rows, "g", ["v", "w"]).collect()}
    assert {k: (x.n, x.v_median, x.w_median, x.w_mean) for k, x in got.items()} == {("a", 0): (3, 2.0, 6.0, 6.0), (None, 0): (1, 9.0, 1.0, 1.0), (None, 1): (4, 3.0, 5.0, 4.3333)}


def test_budgets_and_limits(spark):
    rows = spark.createDataFrame([([("user", "a " * n)],) for n in (1, 10, 100)], "messages array<struct<role: string, content: string>>")
    assert tuple(d.budget_tally(rows, 15, 10).first()) == (3, 2, 1, 1)
    assert {x.n_tokens for x in d.within_budget(rows, 15).collect()} == {6, 15}
    texts = spark.createDataFrame([(3, "a"), (1, "a b c"), (2, None)], "i int, text string")
    assert [x.i for x in d.within_tokens(texts, "text", 2, 3).collect()] == [1]
    assert [x.i for x in d.first_rows(texts, "i", 2).collect()] == [1, 2]


def test_convert(spark, tmp_path):
    golden = [{"example_html": "<p>é</p>", "expected_json": {"type": "event", "title": "ü", "n": [1]}}, {"example_html": "x " * 500, "expected_json": {"type": "recipe"}}]
    (tmp_path / "golden.jsonl").write_text("\n".join(json.dumps(x, ensure_ascii=False) for x in golden))
    d.convert(spark, f"{tmp_path}/golden.jsonl", f"{tmp_path}/chat", limit=300)
    (line,) = [json.loads(x.raw)["messages"] for x in records.json_lines(spark, f"{tmp_path}/chat").collect()]
    assert line[0]["content"] == f"{registry.INSTRUCTION}\n\nHTML:\n<p>é</p>\n\n{registry.PROMPTS['event']}"
    assert line[1] == {"role": "assistant", "content": json.dumps(golden[0]["expected_json"], ensure_ascii=False, indent=2)}


def test_level_counts_are_those_of_the_texts(spark):
    pages = spark.createDataFrame([(1, "<div class='a'><script>x</script><p>héllo  42</p><img src=a><a href=b></a></div>"), (2, None), (3, "")], "page_id long, html string")
    fast = {x.page_id: x for x in r.token_levels(pages, "page_id").collect()}
    slow = {x.page_id: x for x in r.token_levels(pages, "page_id", count=lambda c: r.approximate(c)).collect()}
    assert fast[1] == slow[1] and fast[3] == slow[3] and fast[2].original_tokens is None


def test_small_tables_are_spread(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(1000).selectExpr("id", "cast(id % 7 as string) as x")
    rows.coalesce(1).write.parquet(f"{tmp_path}/one.parquet")
    rows.repartition(4 * cores).write.parquet(f"{tmp_path}/many.parquet")
    dealt = spread(table(spark, str(tmp_path), "one"))
    assert dealt.rdd.getNumPartitions() == cores and sorted(r.id for r in dealt.collect()) == list(range(1000))
    many = spread(table(spark, str(tmp_path), "many"))
    assert "Repartition" not in many._jdf.queryExecution().optimizedPlan().toString()
    rows.limit(0).write.parquet(f"{tmp_path}/none.parquet")
    assert spread(table(spark, str(tmp_path), "none")).count() == 0


def test_ranges_are_found_by_halving(spark):
    cuts = sorted([1.0] * 40 + [float(x) for x in range(q.RANGES - 41)])
    values = [-1.0, 0.0, 0.5, 1.0, 1.5, 40.0, 85.5, 86.0, 87.0, 1e9]
    made = spark.createDataFrame([(cuts, v) for v in values], "c array<double>, v double").select("v", q.range_of(F.col("c"), F.col("v")).alias("n"))
    assert {r.v: r.n for r in made.collect()} == {v: sum(c < v for c in cuts) for v in values}


def test_lines_of_many_files(spark, tmp_path):
    """Numbers of lines whose files are read in many parts, against the files themselves."""
    rng = random.Random(1)
    want = []
    for f in "cab":
        rows = [f"{f}{i}" + "x" * rng.randrange(200) for i in range(rng.randrange(300, 900))]
        (tmp_path / f"{f}.txt").write_text("\n".join(rows) + "\n" * (f == "a"))
    (tmp_path / "d.txt").write_text("")
    for f in "abc":
        want += [(f"{f}.txt", i, x) for i, x in enumerate((tmp_path / f"{f}.txt").read_text().splitlines(), 1)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in (before, "5000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = sorted((x.place, x.file.rpartition("/")[2], x.line, x.raw) for x in records.lines(spark, f"file://{tmp_path}").collect())
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        assert [x[0] for x in got] == list(range(len(want))) and [x[1:] for x in got] == want


def test_strict_lines_name_the_line(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a": 1}\n' * 41 + "{\n" + '{"a": 2}\n')
    with pytest.raises(Exception, match=r"line 42 of file:.*a\.jsonl: not a line of JSON: \{"):
        records.json_lines(spark, f"{tmp_path}/a.jsonl").collect()
    assert records.json_lines(spark, f"{tmp_path}/a.jsonl", strict=False).count() == 43
    (tmp_path / "b.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    with pytest.raises(Exception, match="line 2 of"):
        records.json_lines(spark, f"{tmp_path}/b.jsonl").collect()


def test_ordered_files_follow_each_other(spark, tmp_path):
    rows = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"), F.col("id").alias("value")).repartition(7)
    sinks.write_lines(rows, F.col("k").cast("string"), f"{tmp_path}/out", order="k")
    files = sorted((tmp_path / "out").glob("part-*"))
    assert len(files) > 1 and "".join(f.read_text() for f in files).split() == [str(i) for i in range(1000)]
    assert [x.raw for x in records.lines(spark, f"{tmp_path}/out").orderBy("place").collect()] == [str(i) for i in range(1000)]


def test_scans_read_new_files_alone(spark, tmp_path):
    (folder := tmp_path / "in").mkdir()
    put = lambda name, kind: (folder / f"annotation_{name}.json").write_text(json.dumps({"example_html": "x", "expected_json": {"type": kind}}, indent=2))
    put("1", "recipe"), put("2", "event")
    (folder / "other.json").write_text("{}")
    scan = lambda: records.scan_new(spark, f"file://{folder}", f"file://{tmp_path}/state")
    assert sorted((x.file, x.type, x.batch) for x in scan().collect()) == [("annotation_1.json", "recipe", 0), ("annotation_2.json", "event", 0)]
    (folder / "annotation_1.json").write_text("{")  # read before: not again
    (folder / "annotation_4.json").write_text("{")
    put("3", "event")
    assert sorted((x.file, x.type, x.reason, x.batch) for x in scan().collect() if x.batch) == [("annotation_3.json", "event", None, 1), ("annotation_4.json", None, "not JSON", 1)]
    assert scan().count() == 4 and scan().agg(F.max("batch")).first()[0] == 1


def test_published_rows(spark, tmp_path):
    sinks.write_splits(spark.range(20).select("id", F.when(F.col("id") % 2 == 0, "test").otherwise("train").alias("split")), f"{tmp_path}/t")
    assert sorted(x.id for x in records.published(spark, f"{tmp_path}/t", "test", 3, "id").collect()) == [0, 2, 4]
    assert records.published(spark, f"{tmp_path}/t", "train").count() == 10
    with pytest.raises(ValueError):
        records.published(spark, f"{tmp_path}/t", "test", 3)


def test_python_gets_small_batches_of_tables(spark, tmp_path):
    import pandas as pd

    from tagloom.sources import tables

    @F.pandas_udf("long")
    def size(texts: pd.Series) -> pd.Series:
        return pd.Series([int(texts.str.len().sum())] * len(texts))

    spark.range(200).select(F.repeat(F.lit("x"), 100_000).alias("html")).coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    assert tables.table(spark, str(tmp_path), "pages").select(F.max(size("html"))).first()[0] < 2 * tables.BATCH_BYTES
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    d.variations(spark.createDataFrame([(1, "<p>", None)], "id int, example_html string, variation_id long"), "id")
    assert spark.read.parquet(f"{tmp_path}/pages.parquet").select(F.max(size("html"))).first()[0] < 2 * tables.BATCH_BYTES


def test_a_scan_of_many_files_leaves_few(spark, tmp_path):
    (folder := tmp_path / "in").mkdir()
    for i in range(200):
        (folder / f"annotation_{i}.json").write_text('{"example_html": "x", "expected_json": {"type": "event"}}')
    assert records.scan_new(spark, f"file://{folder}", f"file://{tmp_path}/state").count() == 200
    assert len(list((tmp_path / "state" / "found" / "batch=0").glob("*.parquet"))) <= spark.sparkContext.defaultParallelism


def test_scans_are_bounded(spark, tmp_path, monkeypatch):
    """The driver plans a batch as a whole, and knows the names of one folder at a time."""
    monkeypatch.setattr(records, "SCAN_FILES", 50)
    for part, n in (("2024-05", 120), ("k=v 1", 7)):
        (tmp_path / "in" / part).mkdir(parents=True)
        for i in range(n):
            (tmp_path / "in" / part / f"annotation_{i}.json").write_text('{"example_html": "x", "expected_json": {"type": "event"}}')
    before = {k: spark.conf.get(k) for k in records.SCAN_SETTINGS}
    flat = records.scan_new(spark, f"file://{tmp_path}/in/2024-05", f"file://{tmp_path}/flat").groupBy("batch").count().collect()
    assert {x.batch: x["count"] for x in flat} == {0: 50, 1: 50, 2: 20}
    scan = lambda: sorted(map(tuple, records.scan_new(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/state", parts=["2024-05", "k=v 1"]).groupBy("part", "batch").count().collect()))
    first = [("2024-05", 0, 50), ("2024-05", 1, 50), ("2024-05", 2, 20), ("k=v 1", 0, 7)]
    assert scan() == first
    (tmp_path / "in" / "k=v 1" / "annotation_7.json").write_text("{")
    assert scan() == [*first, ("k=v 1", 1, 1)]
    assert {k: spark.conf.get(k) for k in records.SCAN_SETTINGS} == before


def test_annotation_scan_in_many_folders(spark, monkeypatch):
    from tagloom.plans import queries

    monkeypatch.setattr(records, "SCAN_FILES", 5)
    ids = [x.page_id for x in table(spark, "/root/testdata/sf0.001", "pages").select("page_id").collect()]
    kinds = list(registry.PROMPTS)
    got = {x.type: (x.n, x.n_new) for x in queries.QUERIES["annotation_scan"](spark, "/root/testdata/sf0.001").collect()}
    assert got == {k: (sum(i % 3 == at for i in ids), sum(i % 3 == at and i % 2 == 1 for i in ids)) for at, k in enumerate(kinds)}
