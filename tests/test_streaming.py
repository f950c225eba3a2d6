import json
import random

from pyspark.sql import functions as F

from tagloom.streaming import capture


def put(folder, name, rows):
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def row(kind, stamp, html="<p>", **more):
    return {"html": html, "label": json.dumps({"type": kind, **more}), "url": "u", "timestamp": stamp}


def test_saves_are_upserts_and_counts_follow(spark, tmp_path):
    (inbox := tmp_path / "in").mkdir()
    put(inbox, "a.json", [row("event", "2024-01-01T00:00:00.1Z"), row("event", "2024-01-01T00:00:00.9Z", n=2), row("recipe", "2024-01-01T00:00:01.0Z"), row("event", "x", html=" "), {"html": "x", "label": "{"}])

    def run():
        q = capture.save(capture.payloads(spark, f"file://{inbox}"), f"file://{tmp_path}/saved", f"file://{tmp_path}/check").trigger(availableNow=True).start()
        q.awaitTermination()
        return {r.name: r.expected_json for r in capture.saved(spark, f"file://{tmp_path}/saved").collect()}

    first = run()
    assert set(first) == {"annotation_event_2024-01-01T00-00-00.json", "annotation_recipe_2024-01-01T00-00-01.json"}
    assert json.loads(first["annotation_event_2024-01-01T00-00-00.json"])["n"] == 2
    put(inbox, "b.json", [row("event", "2024-01-01T00:00:00.95Z", n=3)])
    assert json.loads(run()["annotation_event_2024-01-01T00-00-00.json"])["n"] == 3
    counts = capture.drained(capture.running_counts(capture.payloads(spark, f"file://{inbox}")), "saves")
    assert {r.type: r.n for r in counts.collect()} == {"event": 3, "recipe": 1}


def test_each_key_once(spark, tmp_path):
    (inbox := tmp_path / "in").mkdir()
    put(inbox, "a.json", [{"k": 1, "ts": "2024-01-01T00:00:00"}, {"k": 1, "ts": "2024-01-01T00:00:01"}, {"k": 2, "ts": "2024-01-01T00:00:02"}])
    rows = spark.readStream.schema("k int, ts timestamp").json(f"file://{inbox}")
    q = capture.once(rows, "k", "ts").writeStream.format("memory").queryName("once").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.k for r in spark.table("once").select(F.col("k")).collect()) == [1, 2]


def annotated(spark, rows):
    return spark.createDataFrame([(n, "t", h, "{}", s) for n, h, s in rows], "name string, type string, example_html string, expected_json string, timestamp string")


def test_store_keeps_the_last_save_of_each_name(spark, tmp_path):
    """Against a dictionary: late, repeated and equal saves, batches that run again, merges between."""
    rng = random.Random(1)
    store, last = capture.Store(spark, f"file://{tmp_path}/store"), {}
    batches = []
    for number in range(9):
        rows = [(f"n{rng.randrange(12)}", f"{number}-{i}", f"2024-01-01T00:00:0{rng.randrange(9)}") for i in range(rng.randrange(1, 9))]
        batches.append(rows)
        store.add(annotated(spark, rows), number)
        if number in (2, 6):
            store.add(annotated(spark, rows), number)  # runs again at once
        for name, html, stamp in sorted(rows, key=lambda x: (x[2], x[1])):
            last[name] = (stamp, html)
        assert {x.name: (x.timestamp, x.example_html) for x in store.rows().collect()} == last
    upto, parts = store.parts()
    assert upto >= 0
    store.add(annotated(spark, batches[0]), 0)  # long merged
    assert store.parts() == (upto, parts) and {x.name: (x.timestamp, x.example_html) for x in store.rows().collect()} == last
    store.merge()
    assert len(store.parts()[1]) == 1 and store.spark.read.parquet(f"{store.folder}/{store.parts()[1][0]}").count() == len(last)
    assert {x.name: (x.timestamp, x.example_html) for x in store.rows().collect()} == last


def test_store_of_nothing_and_half_written_folders(spark, tmp_path):
    store = capture.Store(spark, f"file://{tmp_path}/store")
    assert store.rows().count() == 0
    store.merge()
    store.add(annotated(spark, [("a", "1", "x")]), 0)
    (tmp_path / "store/base/upto=7").mkdir(parents=True)  # a merge that was lost before its end
    (tmp_path / "store/new/batch=5").mkdir()
    assert [x.example_html for x in store.rows().collect()] == ["1"]
    store.add(annotated(spark, [("a", "2", "x")]), 1)
    assert [x.example_html for x in store.rows().collect()] == ["2"]


def test_store_reads_the_live_rows(spark, tmp_path):
    """However often names are saved again, what a read opens stays a small multiple of the live rows."""
    store = capture.Store(spark, f"file://{tmp_path}/store")
    for number in range(12):
        store.add(annotated(spark, [(f"n{i}", "x" * 500, str(number)) for i in range(40)]), number)
    assert sum(spark.read.parquet(f"{store.folder}/{p}").count() for p in store.parts()[1]) <= 80
    assert len(list((tmp_path / "store/new").glob("batch=*"))) <= 3 and len(list((tmp_path / "store/base").glob("upto=*"))) <= 2
