"""Alignment of the tokens of two tokenizers: groups, links, and corpus-wide counts of linked id pairs.

Both tokenizers cut one byte string. The ends of their tokens, merged, cut it into pieces; each piece lies in one token of
A and one of B, so the pieces are exactly the links. A group ends where both have an end.

The corpus-wide counts are a cogroup of postings. A task that encodes documents also lays down, for each id of A that its
documents hold, one row with the linked ids of B, the documents and the multiplicities. These rows are shuffled by the id
of A, sorted by it (Spark spills what doesn't fit) and read as a stream: an id's pairs are counted, their maximum taken and
what each document gets from them is summed, all in one place. The parts of a document are added up in a last shuffle.

An id with more than ``run`` postings is split by documents. So that each part knows the whole counts, these are summed
before (map-side) and sent to the parts ahead of their postings: at most one number for each id of B. Memory is
bounded by ``run``, by what the documents of one Arrow batch hold, and by the sizes of the two vocabularies.

Edge cases: texts that are null or empty, or whose tokens don't spell space + text, have no tokens: zeros and no groups.
Every row counts as a document, repeated ids and texts too. A null id stays null. An empty table gives an empty one.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, mapped, written

# The pattern that cuts text into words for byte-level BPE vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Runs of white space from this length on are too deep for the pattern's recursion; such texts take the other library.
LONG_SPACE = re.compile(r"\s{10000}")
SPACE_MARK = "▁"
#: Postings of an id that are read together.
RUN = 1_000_000
#: Characters of text that are aligned together.
ALIGN_CHARS = 500_000


def byte_letters() -> dict[str, int]:
    """Letter to byte of byte-level vocabularies: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """Byte-level BPE from a tokenizers file: ids of texts and the bytes of each id.

    Where each merge makes the id that follows the last one and each token encodes to itself, merging any neighbours by
    the id that they make is the same as following the list of merges; then the faster of two libraries is used.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        model, letters = made["model"], byte_letters()
        vocab = {t: i for t, i in model["vocab"].items() if all(c in letters for c in t)}
        self.size = max([*model["vocab"].values(), *(t["id"] for t in made["added_tokens"])]) + 1
        self.bytes = [None] * self.size
        for t, i in vocab.items():
            self.bytes[i] = bytes(letters[c] for c in t)
        merged = [vocab.get("".join(m if isinstance(m, list) else m.split(" ")), -1) for m in model["merges"]]
        ordered = all(a < b for a, b in zip(merged, merged[1:], strict=False)) and merged[:1] >= [256] and made["normalizer"] is None
        own = ordered and all([x.id for x in self.slow.model.tokenize(t)] == [i] for t, i in vocab.items())
        self.fast = tiktoken.Encoding("byte_level", pat_str=PATTERN, mergeable_ranks={self.bytes[i]: i for i in vocab.values()}, special_tokens={}) if own else None

    def spelt(self, ids: list[int]) -> bytes | None:
        return self.fast.decode_bytes(ids) if self.fast else spelt(self.bytes, ids)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.fast.encode_ordinary(t) if self.fast and not LONG_SPACE.search(t) else self.slow.encode(t, add_special_tokens=False).ids for t in texts]


class Pieces:
    """SentencePiece model: ids of texts and the bytes of each id."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.library.get_piece_size()
        self.bytes = [self._bytes(i) for i in range(self.size)]

    def _bytes(self, i: int) -> bytes | None:
        piece = self.library.id_to_piece(i)
        if self.library.is_control(i) or self.library.is_unknown(i):
            return None
        return bytes([int(piece[3:5], 16)]) if self.library.is_byte(i) else piece.replace(SPACE_MARK, " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.library.encode(t) for t in texts]


@functools.lru_cache(maxsize=4)
def loaded(kind: type, path: str):
    """One model of each file in a worker."""
    return kind(path)


def flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids behind each other, and how many each text has."""
    n = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum())), n


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = loaded(ByteLevel, path_a), loaded(Pieces, path_b)
        self.len_a, self.len_b = (np.array([len(x or b"") for x in m.bytes], np.int64) for m in (self.a, self.b))
        # an id and what follows it in the text of the groups, in eight bytes: A's "," or "|", B's "," or ";"
        shown = [f"{i}{s}".encode() for size, ends in ((self.a.size, ",|"), (self.b.size, ",;")) for s in ends for i in range(size)]
        self.shown, self.shown_len = np.array(shown, "S8").view(np.uint64), np.array([len(x) for x in shown], np.int64)

    def encoded(self, texts: list[str | None]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and B; none where the text is null or empty, or a tokenizer doesn't give back space + text."""
        found = [i for i, t in enumerate(texts) if t]
        ids_a, ids_b = [[] for _ in texts], [[] for _ in texts]
        whole = [" " + texts[i] for i in found]
        for i, t, a, b in zip(found, whole, self.a.encode(whole), self.b.encode([t[1:] for t in whole]), strict=True):
            raw = t.encode()
            if self.a.spelt(a) == raw and spelt(self.b.bytes, b) == raw:
                ids_a[i], ids_b[i] = a, b
        return ids_a, ids_b

    def aligned(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[bytes], tuple[np.ndarray, ...]]:
        """n_a, n_b, n_groups, n_links of the texts; their groups as text; of all, sorted, the distinct (id of A, place of the text, id of B) and how often each is linked."""
        (a, n_a), (b, n_b) = map(flat, self.encoded(texts))
        end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        pieces = np.concatenate((end_a, end_b))  # texts follow each other, and each ends for both at once
        pieces.sort(kind="stable")
        pieces = pieces[fresh(pieces)]
        of_a, of_b = np.searchsorted(end_a, pieces), np.searchsorted(end_b, pieces)
        is_a, is_b = end_a[of_a] == pieces, end_b[of_b] == pieces
        closes_a, closes_b = is_b[is_a], is_a[is_b]
        doc_a = np.repeat(np.arange(len(texts)), n_a)
        doc = doc_a[of_a]
        group_a, group_b = (np.cumsum(c) - c for c in (closes_a, closes_b))
        # a token's place among those of both, group by group, A's before B's
        order = np.empty(len(a) + len(b), np.int64)
        up_to_a = np.concatenate((np.flatnonzero(closes_a) + 1, [0]))  # tokens of A up to the end of a group
        before_b = np.concatenate(([0], np.flatnonzero(closes_b) + 1))  # tokens of B before a group
        order[np.arange(len(a)) + before_b[group_a]] = a + self.a.size * closes_a
        order[np.arange(len(b)) + up_to_a[group_b]] = 2 * self.a.size + b + self.b.size * closes_b
        long = self.shown_len[order]
        letters = self.shown[order].view(np.uint8).reshape(-1, 8)[np.arange(8) < long[:, None]].tobytes()
        at = np.concatenate(([0], np.cumsum(long)))[np.concatenate(([0], np.cumsum(n_a + n_b)))].tolist()
        groups = [letters[x : y - 1] if y > x else b"" for x, y in zip(at, at[1:], strict=False)]
        key = (a[of_a] * max(1, len(texts)) + doc) * self.b.size + b[of_b]
        key.sort()
        start = np.flatnonzero(fresh(key))
        left, linked = np.divmod(key[start], self.b.size)
        id_a, place = np.divmod(left, max(1, len(texts)))
        numbers = [n_a, n_b, np.bincount(doc_a[closes_a], minlength=len(texts)), np.bincount(doc, minlength=len(texts))]
        return numbers, groups, (id_a, place, linked, np.diff(np.concatenate((start, [len(key)]))))


def fresh(x: np.ndarray) -> np.ndarray:
    """Where a sorted array has another value than before."""
    return np.concatenate((np.ones(min(1, len(x)), bool), x[1:] != x[:-1]))


def spelt(table: list[bytes | None], ids: list[int]) -> bytes | None:
    try:
        return b"".join(map(table.__getitem__, ids))
    except TypeError:  # an id without bytes
        return None


#: One table, written in one pass: rows of documents (id_a null) and rows of postings (n_a null).
LAID = "doc_id long, at long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, id_a int, ids_b array<int>, places array<int>, times array<int>"


def laid_out(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Each document's own numbers, and the postings of each id of A: (id of B, row number at + place, multiplicity) of a batch of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)
        schema = pa.schema([("doc_id", pa.int64()), ("at", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.string()), ("id_a", pa.int32()), *((c, pa.list_(pa.int32())) for c in ("ids_b", "places", "times"))])
        for batch in batches:
            texts, row = batch.column(2).to_pylist(), batch.column(1).to_numpy()
            for start, end in chunks(texts, ALIGN_CHARS):
                numbers, groups, (a, place, b, times) = aligner.aligned(texts[start:end])
                sha = [hashlib.sha256(g).hexdigest() if g else "" for g in groups]
                n = end - start
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, n), pa.array(row[start:end]), *(pa.array(x, pa.int64()) for x in numbers), pa.array(sha, pa.string()), pa.nulls(n, pa.int32()), *(pa.nulls(n, pa.list_(pa.int32())) for _ in range(3))], schema=schema)
                if len(a):
                    cuts = np.flatnonzero(np.diff(a)) + 1
                    edges = pa.array(np.concatenate(([0], cuts, [len(a)])).astype(np.int32))
                    n = len(cuts) + 1
                    lists = (pa.ListArray.from_arrays(edges, pa.array(x.astype(np.int32))) for x in (b, row[start:end][place] - row[start], times))
                    yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.array(np.full(n, row[start])), *(pa.nulls(n, pa.int64()) for _ in range(4)), pa.nulls(n, pa.string()), pa.array(a[np.concatenate(([0], cuts))].astype(np.int32)), *lists], schema=schema)

    picked = docs.select(F.col("doc_id").cast("long"), F.monotonically_increasing_id().alias("at"), F.col("text").cast("string"))
    return picked.transform(mapped, run, LAID)


def shares(part: np.ndarray, b: np.ndarray, row: np.ndarray, times: np.ndarray, known: dict[int, tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, links that are their id's best, sum of counts) of each document in some whole parts; the postings of a part come document by document.

    known: ids of B and whole counts of an id that is split.
    """
    order = np.lexsort((b, part))
    pair = fresh(part[order] << 32 | b[order])
    start = np.flatnonzero(pair)
    count = np.diff(np.concatenate((start, [len(b)])))
    of_part, of_b = part[order][start], b[order][start]
    first = np.flatnonzero(fresh(of_part))
    best = np.maximum.reduceat(count, first)
    for i, p in enumerate(of_part[first].tolist()):
        if p in known:
            ids, whole = known[p]
            here = slice(first[i], first[i + 1] if i + 1 < len(first) else len(of_b))
            count[here] = whole[np.searchsorted(ids, of_b[here])]
            best[i] = whole.max()
    is_best = count == np.repeat(best, np.diff(np.concatenate((first, [len(of_b)]))))
    of = np.empty(len(b), np.int64)
    of[order] = np.cumsum(pair) - 1
    own = np.flatnonzero(fresh(part) | fresh(row))
    return row[own], np.add.reduceat(times * is_best[of], own), np.add.reduceat(times * count[of], own)


def contributions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads (id_a, part, at, ids_b, places, times, counts) in order of id and part, whole counts first; gives sums by document row."""
    kept: list[tuple[np.ndarray, ...]] = []
    size = number = 0
    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    last = None

    def done() -> Iterator[pa.RecordBatch]:
        nonlocal size
        if kept:
            rows, n_best, total = shares(*(np.concatenate(x) for x in zip(*kept, strict=True)), known)
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(n_best), pa.array(total)], ["at", "n_best", "count_sum"])
        kept.clear()
        known.clear()
        size = 0

    for batch in batches:
        ids, parts, at = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        lists = [batch.column(i) for i in range(3, 7)]
        edges = [c.offsets.to_numpy() for c in lists]
        values = [c.values.to_numpy(zero_copy_only=False) for c in lists]
        counts_there = lists[3].is_valid().to_numpy(zero_copy_only=False)
        for i in range(batch.num_rows):
            if (ids[i], parts[i]) != last:
                last = (ids[i], parts[i])
                if size >= RUN // 4:
                    yield from done()
                number += 1
            b = values[0][edges[0][i] : edges[0][i + 1]]
            if counts_there[i]:
                known[number] = (b, values[3][edges[3][i] : edges[3][i + 1]])
                continue
            places, times = (v[e[i] : e[i + 1]] for v, e in zip(values[1:3], edges[1:3], strict=True))
            kept.append((np.full(len(b), number), b, at[i] + places, times.astype(np.int64)))
            size += len(b)
    yield from done()


def corpus_counts(laid: DataFrame, run: int = RUN) -> DataFrame:
    """(at, n_best, count_sum) of every document row that has links."""
    spark = laid.sparkSession
    postings = laid.filter(F.col("id_a").isNotNull()).select("id_a", "at", "ids_b", "places", "times")
    load = postings.groupBy("id_a").agg(F.sum(F.size("ids_b")).alias("n")).collect()  # a row for each id of A: bounded by its vocabulary
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    limit = max(1, min(run, max(run // 100, sum(r.n for r in load) // (4 * parts))))  # and no id is more than a part of a task
    split = spark.createDataFrame([(r.id_a, -(-r.n // limit)) for r in load if r.n > limit], "id_a int, n_parts long")
    dealt = postings.join(F.broadcast(split), "id_a", "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("at"), "n_parts"), F.lit(0)))
    whole = postings.join(F.broadcast(split), "id_a").select("id_a", "n_parts", F.explode("ids_b").alias("b")).groupBy("id_a", "n_parts", "b").agg(F.count("*").alias("n"))
    whole = whole.groupBy("id_a", "n_parts").agg(F.sort_array(F.collect_list(F.struct("b", "n"))).alias("of"))  # at most one for each id of B
    whole = whole.select("id_a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_parts") - 1)).alias("part"), F.col("of.b").alias("ids_b"), F.col("of.n").alias("counts"))
    none = F.lit(None)
    rows = dealt.select("id_a", "part", "at", "ids_b", "places", "times", none.cast("array<long>").alias("counts")).unionByName(whole.select("id_a", "part", F.lit(-1).cast("long").alias("at"), "ids_b", none.cast("array<int>").alias("places"), none.cast("array<int>").alias("times"), "counts"))
    ordered = rows.repartition(parts, "id_a", "part").sortWithinPartitions("id_a", "part", F.col("counts").isNull(), "at")
    given = ordered.transform(mapped, contributions, "at long, n_best long, count_sum long")
    return given.groupBy("at").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def alignments(docs: DataFrame, path_a: str, path_b: str, run: int = RUN) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row; texts are encoded once, and the postings are written to the shared folder."""
    laid = written(laid_out(docs, path_a, path_b), "alignment")
    own = laid.filter(F.col("id_a").isNull()).select("doc_id", "at", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return own.join(corpus_counts(laid, run), "at", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")


def groups_of(text: str, path_a: str, path_b: str) -> list[tuple[list[int], list[int]]]:
    """The groups of one text: ids of A and of B that cover the same bytes."""
    shown = Aligner(path_a, path_b).aligned([text])[1][0].decode()
    return [tuple([int(i) for i in side.split(",")] for side in group.split("|")) for group in shown.split(";")] if shown else []
