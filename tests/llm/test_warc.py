import base64
import hashlib
import io

import pytest
import zstandard

from tagloom.llm import warc

PAGES = [(1, "http://a/\r\nx", "<p>é</p>", 0), (2, None, "<p>é</p>", 0), (3, "u", None, 0), (4, "u", "", 0), (5, "u", "x" * 5000, 0), (5, "u", "x" * 5000, 0), (None, "u", "x" * 5000, 0), (0, "u", "x" * 5000, 0), (9, "u", "\r\n\r\nWARC/1.1\r\n", 0)]
SCHEMA = "page_id long, url string, html string, digest int"


def brute(pages, least=0):
    first = {}
    for p, _, h, _ in pages:
        if p is not None and len((h or "").encode()) >= least:
            first[h or ""] = min(first.get(h or "", p), p)
    out = []
    for p, _, h, _ in pages:
        raw = (h or "").encode()
        to = first.get(h or "", p)
        revisit = p is not None and to is not None and to < p
        out.append((p, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("spec", [warc.Spec(), warc.Spec(frame_bytes=100, bundle_bytes=200), warc.Spec(min_payload=1)])
def test_records_come_back(spark, spec):
    pages = spark.createDataFrame(PAGES, SCHEMA).repartition(2)
    assert sorted((tuple(r) for r in warc.archived(spark, pages, spec).collect()), key=str) == brute(PAGES, spec.min_payload)


def test_bundles_are_plain_zstandard_and_seekable(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, SCHEMA).coalesce(1)
    index = warc.write(pages, f"file://{tmp_path}", warc.Spec(frame_bytes=100))
    (bundle,) = {r.bundle for r in index.collect()}
    data = open(bundle, "rb").read()
    whole = b"".join(iter(lambda r=zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True): r.read(1 << 16), b""))
    assert whole.count(b"WARC-Type: ") == len(PAGES)
    wanted = spark.createDataFrame([(5,), (9,), (77,)], "page_id long")
    got = warc.fetch(index, wanted).collect()
    assert sorted(r.page_id for r in got) == [5, 5, 9]
    for r in got:
        head, block, end = warc.parse(bytes(r.record))
        assert warc.facts(head, block)[0] == r.page_id and end == len(r.record)


def test_bundles_as_rows(spark, tmp_path, monkeypatch):
    """Where the folder isn't a mounted path the index table holds the bundles."""
    pages = spark.createDataFrame(PAGES, SCHEMA)
    assert warc.mounted(spark, f"file:{tmp_path}/a") == warc.mounted(spark, f"{tmp_path}/a") == f"{tmp_path}/a"
    folder = f"{tmp_path}/store"
    monkeypatch.setattr(warc, "mounted", lambda *_: None)
    index = warc.write(pages, folder)
    assert index.filter("data is not null").count() > 0
    assert sorted((tuple(r) for r in warc.read(index).collect()), key=str) == brute(PAGES)
    assert warc.fetch(index, spark.createDataFrame([(9,)], "page_id long")).count() == 1


def test_damage_shows(spark):
    good = warc.record(1, "u", b"abc", None, warc.Spec())
    head, block, _ = warc.parse(good)
    with pytest.raises(ValueError):
        warc.facts(head, block[:-1] + b"x")
    with pytest.raises(ValueError):
        warc.parse(good[:-3] + b"xxx")
    assert warc.archived(spark, spark.createDataFrame([], SCHEMA)).count() == 0
