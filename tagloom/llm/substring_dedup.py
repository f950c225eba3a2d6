"""Removal of word windows that an earlier document already has, by level-wise doubling.

Levels are window lengths: ``first`` words, then twice as many, and so on below
the full length. A level looks at one window for each full window: the one with
the smallest hash inside it (equal full windows choose equal ones, so none is
missed). Only full windows whose choice occurs in two documents or more go on
to the next level; the loop ends as soon as none survives. Longer windows than
the full one decide nothing, so there the doubling ends.

At the full length consecutive survivors that share their last choice are a
run, and a run is compared as a whole first: where a smaller document has the
same run, all its windows repeat. Of each different run one stands for all, and
only runs that met another run under one choice are opened into windows.

Texts are laid out once in buckets by a row number, so each level joins its
survivors with them without moving texts; rows that share an id are told apart.
No step brings the rows of one window together: minima and maxima are summed up
before they meet, and are joined back in skewed partitions that Spark can split.

Edge cases: null and empty texts have no words and lose none; texts with fewer
words than the length lose none; repeats within one document, or among rows
with one id, don't count; a null id has no smaller and removes nothing
elsewhere. Windows are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, discard, mapped, saved, shared_table
from .hashing import WordHasher, spans, windows


@dataclass(frozen=True)
class Spec:
    #: Words in a window.
    length: int = 50
    #: Words in a window of the first level.
    first: int = 13


def levels(spec: Spec) -> list[int]:
    """Window lengths below the full one."""
    out = [min(spec.first, spec.length)]
    while out[-1] * 2 < spec.length:
        out.append(out[-1] * 2)
    return out


def choices(words: np.ndarray, length: int, part: int) -> np.ndarray:
    """For each full window, the start of the window of ``part`` words in it with the smallest hash, the first of equals; and all their hashes."""
    hashes = windows(words, part)
    full = max(0, len(words) - length + 1)
    place = np.empty(full, np.int64)
    if full:
        view = np.lib.stride_tricks.sliding_window_view(hashes, length - part + 1)
        for i in range(0, full, 65_536):
            place[i : i + 65_536] = view[i : i + 65_536].argmin(1) + np.arange(i, min(full, i + 65_536))
    return hashes, place


def surviving(words: np.ndarray, length: int, sizes: list[int], known: list[list[int]]) -> tuple[np.ndarray, np.ndarray | None]:
    """Starts of the full windows whose choices at each of the first levels are known, and the hash of their last choice."""
    starts, last = np.arange(max(0, len(words) - length + 1)), None
    for part, hits in zip(sizes, known, strict=True):
        hashes, place = choices(words, length, part)
        last = hashes[place[starts]].view(np.int64)
        kept = np.isin(last, np.array(hits, np.int64))
        starts, last = starts[kept], last[kept]
    return starts, last


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values) if values else np.empty(0, np.int64), kind))


def _level(docs: DataFrame, spec: Spec, done: int) -> DataFrame:
    """(w, doc, rid): the choices at level ``done`` of the full windows that survived those before, once for each row. docs has rid, doc, text and known (hashes of each level so far)."""
    sizes = levels(spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for b in batches:
            found, rids, ids = [], [], []
            for rid, doc, text, known in zip(*(c.to_pylist() for c in b.columns), strict=True):
                words = hasher.of(text)
                starts, _ = surviving(words, spec.length, sizes[:done], known)
                if len(starts):
                    hashes, place = choices(words, spec.length, sizes[done])
                    found.append(np.unique(hashes[place[starts]].view(np.int64)))
                    rids.append(np.full(len(found[-1]), rid, np.int64))
                    ids.append(np.full(len(found[-1]), doc, np.int64))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (found, ids, rids)], ["w", "doc", "rid"])

    return docs.select("rid", "doc", "text", "known").transform(mapped, run, "w long, doc long, rid long")


def _repeated(rows: DataFrame) -> DataFrame:
    """rid, hits: the hashes of each row that two documents have."""
    often = rows.groupBy("w").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).filter("least < most").select("w")
    return rows.join(often, "w").groupBy("rid").agg(F.collect_list("w").alias("hits"))


RUNS = "r long, w long, doc long, rid long, n int, starts array<int>"


def _runs(docs: DataFrame, spec: Spec) -> DataFrame:
    """The different runs of each row: hash of their words, last choice, number of full windows, and where they start."""
    sizes = levels(spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for b in batches:
            flat: list[tuple] = []
            starts_of: list[np.ndarray] = []
            for rid, doc, text, known in zip(*(c.to_pylist() for c in b.columns), strict=True):
                words = hasher.of(text)
                starts, last = surviving(words, spec.length, sizes, known)
                if not len(starts):
                    continue
                _, place = choices(words, spec.length, sizes[-1])
                place = place[starts]
                first = np.flatnonzero(np.concatenate(([True], (starts[1:] != starts[:-1] + 1) | (place[1:] != place[:-1]))))
                n = np.diff(np.append(first, len(starts)))
                at = starts[first]
                hashes = spans(words, at, at + n - 1 + spec.length).view(np.int64)
                order = np.argsort(hashes, kind="stable")
                cuts = np.flatnonzero(np.concatenate(([True], hashes[order][1:] != hashes[order][:-1])))
                heads = order[cuts]
                flat += zip(hashes[heads].tolist(), last[first[heads]].tolist(), [doc] * len(heads), [rid] * len(heads), n[heads].tolist(), strict=True)
                starts_of += np.split(at[order].astype(np.int32), cuts[1:])
            if flat:
                columns = [pa.array([x[i] for x in flat], pa.int64() if i < 4 else pa.int32()) for i in range(5)]
                yield pa.RecordBatch.from_arrays([*columns, _lists(starts_of, pa.int32())], ["r", "w", "doc", "rid", "n", "starts"])

    return docs.select("rid", "doc", "text", "known").transform(mapped, run, RUNS)


def _opened(docs: DataFrame, spec: Spec) -> DataFrame:
    """(w, r, doc, at): the full windows of the wanted runs, array<struct<r, start, n>>."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for b in batches:
            out = []
            for doc, text, wanted in zip(*(c.to_pylist() for c in b.columns), strict=True):
                full = windows(hasher.of(text), spec.length).view(np.int64)
                for x in wanted:
                    n = x["n"]
                    out.append((full[x["start"] : x["start"] + n], np.full(n, x["r"], np.int64), np.full(n, doc, np.int64), np.arange(n)))
            if out:
                columns = [np.concatenate([x[i] for x in out]) for i in range(4)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns[:3]), pa.array(columns[3], pa.int32())], ["w", "r", "doc", "at"])

    return docs.select("doc", "text", "wanted").transform(mapped, run, "w long, r long, doc long, at int")


MARKS = "array<struct<starts: array<int>, n: int, at: array<int>>>"


def repeats(store: DataFrame, spec: Spec = Spec()) -> DataFrame:
    """rid, marks (see ``MARKS``) of the rows of store(rid, doc, text) that lose words. A mark names windows by the starts of equal runs and, within each, places; all ``n`` if ``at`` is null."""
    if not 1 <= spec.first or not 2 <= spec.length:
        raise ValueError("the length must be 2 at least, the first level's 1")
    spark, docs = store.sparkSession, store.filter("doc is not null and text is not null").select("rid", "doc", "text")
    none = F.array().cast("array<array<bigint>>")
    known, old = docs.withColumn("known", none), None
    lists = None
    for done in range(len(levels(spec))):
        rows, path = saved(_level(known, spec, done), "level")
        hits = _repeated(rows)
        if lists is not None:
            hits = hits.join(lists, "rid").select("rid", F.concat("known", F.array("hits")).alias("known"))
        else:
            hits = hits.select("rid", F.array("hits").alias("known"))
        lists, new = saved(hits, "survivors")
        for x in (path, old):
            if x:
                discard(spark, x)
        old = new
        if lists.isEmpty():
            return lists.select("rid", F.lit(None).cast(MARKS).alias("marks"))
        known = docs.join(lists, "rid")

    runs, runs_at = saved(_runs(known, spec), "runs")
    discard(spark, old)
    least, least_at = saved(runs.groupBy("r").agg(F.min("doc").alias("least"), F.first("w").alias("w")), "least")
    # Runs that meet a different run of another document under one choice, each at one place.
    met = least.groupBy("w").agg(F.min("least").alias("low"), F.max("least").alias("high")).filter("low < high").select("w")
    wanted = runs.join(least.join(met, "w", "left_semi").select("r", "least"), "r").filter("doc = least")
    wanted = wanted.select("r", F.struct("rid", F.get("starts", F.lit(0)).alias("start"), "n").alias("x")).groupBy("r").agg(F.first("x").alias("x"))
    wanted = wanted.groupBy("x.rid").agg(F.collect_list(F.struct("r", "x.start", "x.n")).alias("wanted"))
    each, each_at = saved(_opened(docs.join(wanted, "rid"), spec), "windows")
    first = each.groupBy("w").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).filter("low < high").select("w", "low")
    parts = each.join(first, "w").filter("doc > low").groupBy("r").agg(F.collect_list("at").alias("at"))
    judged = least.select("r", "least").join(parts, "r", "left")
    marks = runs.join(judged, "r").filter("doc > least or at is not null")
    marks = marks.groupBy("rid").agg(F.collect_list(F.struct("starts", "n", F.when(F.col("doc") == F.col("least"), F.col("at")).alias("at"))).alias("marks"))
    marks, _ = saved(marks, "marks")
    for x in (runs_at, least_at, each_at):
        discard(spark, x)
    return marks


def _removed(n: int, marks: list[dict] | None, length: int) -> np.ndarray:
    """Whether each of n words is covered by a marked window."""
    step = np.zeros(n + 1, np.int32)
    for m in marks or ():
        starts = np.array(m["starts"], np.int64)
        if m["at"] is None:
            np.add.at(step, starts, 1)
            np.add.at(step, starts + m["n"] - 1 + length, -1)
        else:
            each = (starts[:, None] + np.array(m["at"], np.int64)).ravel()
            np.add.at(step, each, 1)
            np.add.at(step, each + length, -1)
    return np.cumsum(step[:-1]) > 0


def _marked(docs: DataFrame, spec: Spec, key: str, text: str) -> DataFrame:
    """rid, c0, c1, ... (the columns of docs, text as a string) and marks."""
    at = docs.columns.index(text)
    columns = [F.col(f"`{c}`").cast("string").alias(f"c{i}") if i == at else F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    store = shared_table(docs.select(*columns, F.col(f"`{key}`").cast("long").alias("doc")), "texts")
    marks = repeats(store.select("rid", "doc", F.col(f"c{at}").alias("text")), spec)
    return store.drop("doc").join(marks, "rid", "left")


def digests(docs: DataFrame, spec: Spec = Spec(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, gone, kept = [], [], []
            for t, marks in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                words = WORD.findall(t or "")
                off = _removed(len(words), marks, spec.length)
                left = [w for w, x in zip(words, off.tolist(), strict=True) if not x] if marks else words
                n.append(len(words))
                gone.append(int(off.sum()))
                kept.append(hashlib.sha256(" ".join(left).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    picked = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    marked = _marked(picked, spec, "doc_id", "text").select("c0", "c1", "marks")
    return marked.transform(mapped, run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def without_repeats(docs: DataFrame, spec: Spec = Spec(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with repeated words cut out of ``text``: a stretch of removed words goes with the white space after it, all else stays as it is. Documents left without a word go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t, marks in zip(b.column(at).to_pylist(), b.column(b.num_columns - 1).to_pylist(), strict=True):
                if t and marks:
                    places = [m.start() for m in WORD.finditer(t)]
                    off = _removed(len(places), marks, spec.length).tolist()
                    ends = [*places[1:], len(t)]
                    t = None if all(off) else t[: places[0]] + "".join(t[i:j] for i, j, x in zip(places, ends, off, strict=True) if not x)
                out.append((t, not (marks and t is None)))
            columns = list(b.columns[:-1])
            columns[at] = pa.array([t for t, _ in out], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array([x for _, x in out], pa.bool_()))

    names, at = docs.columns, docs.columns.index(text)
    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name == text else f.dataType, True) for f in docs.schema.fields])
    return _marked(docs, spec, key, text).drop("rid").transform(mapped, run, schema)
