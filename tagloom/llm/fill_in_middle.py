"""Fill-in-the-middle transformation of documents, with boundaries found by big-integer bit operations.

A text is cut into units: a word with the white space before it; white space that ends the text is a unit of its own.
``bytes.translate`` turns its UTF-8 bytes into the bits of one integer (white space or not). A shift and two boolean
operations leave one bit at the last byte of each unit, ``bit_count`` gives the number of units, and recursive halving
finds the k-th of those bits. Units end at code points, as white space is ASCII, so every cut is a valid one.

Edge cases: a null text counts as empty; an empty text, and one that holds a sentinel, stays plain. A null id counts as
the empty text when its hash is taken. Rows with equal ids draw equal numbers, so equal rows give equal results. An
empty table gives an empty one. A text of any length is whole in memory once, as one integer of a bit for each byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, mapped

#: Before the prefix, the suffix and the middle.
SENTINELS = ("<P>", "<S>", "<M>")
SPACE_CLASS = bytes(49 if b == 0x20 or 0x09 <= b <= 0x0D else 48 for b in range(256))  # the digits 1 and 0


def unit_ends(raw: bytes) -> int:
    """An integer whose bit i is set where a unit of the text ends with byte i."""
    if not raw:
        return 0
    last = 1 << (len(raw) - 1)
    space = int(raw.translate(SPACE_CLASS)[::-1], 2)
    return ((space >> 1 | last) & ~space) | (space & last)


def select(bits: int, k: int) -> int:
    """Place of the k-th set bit from below, k from 1. Each step halves the integer, so all steps together cost twice the first."""
    at, width = 0, bits.bit_length()
    while width > 1:
        half = width // 2
        low = bits & ((1 << half) - 1)
        if k <= (n := low.bit_count()):
            bits, width = low, half
        else:
            bits, width, at, k = bits >> half, width - half, at + half, k - n
    return at


def draws(seed: str, key: object) -> tuple[int, int, int, int]:
    """Four 32-bit numbers from the SHA-256 of ``seed:key``."""
    hexed = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return tuple(int(hexed[8 * i : 8 * i + 8], 16) for i in range(4))


def transform(text: str | None, numbers: tuple[int, int, int, int], percent: int, spm_percent: int, sentinels: tuple[str, str, str] = SENTINELS) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, characters of prefix, characters of middle, output) of a text."""
    text = text or ""
    raw = text.encode()
    ends = unit_ends(raw)
    n = ends.bit_count()
    one, two, rate, kind = numbers
    if not text or rate % 100 >= percent or any(s in text for s in sentinels):
        return n, "plain", None, None, text
    first, second = (select(ends, k) + 1 if k else 0 for k in sorted((one % (n + 1), two % (n + 1))))
    prefix, middle, suffix = raw[:first].decode(), raw[first:second].decode(), raw[second:].decode()
    before, after, between = sentinels
    if kind % 100 < spm_percent:
        return n, "spm", len(prefix), len(middle), f"{after}{suffix}{before}{prefix}{between}{middle}"
    return n, "psm", len(prefix), len(middle), f"{before}{prefix}{after}{suffix}{between}{middle}"


def transformed(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: str = "42", percent: int = 50, spm_percent: int = 80, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """``key``, n, form (plain, psm or spm), prefix_chars, middle_chars, output of every row; no row moves to another task.

    ``percent`` of the documents are reordered, ``spm_percent`` of these with the suffix first; other columns don't come back.
    """
    if len(set(sentinels)) < 3 or not all(sentinels):
        raise ValueError("three different sentinels are needed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            for start, end in chunks(texts):
                keys = b.column(0).slice(start, end - start)
                made = [transform(t, draws(seed, k), percent, spm_percent, sentinels) for t, k in zip(texts[start:end], keys.to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([keys, *(pa.array(c, kind) for c, kind in zip(zip(*made, strict=True), (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True))], names)

    names = [key, "n", "form", "prefix_chars", "middle_chars", "output"]
    picked = docs.select(F.col(key), F.col(text).cast("string").alias("text"))
    return picked.transform(mapped, run, f"`{key}` {dict(docs.dtypes)[key]}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text from which an output of this form was made; a sentinel is where it stands first, as the text holds none."""
    before, after, between = (F.lit(s) for s in sentinels)
    part = lambda whole, mark, k: F.split_part(whole, mark, F.lit(k))
    middle = part(output, between, 2)
    psm = F.concat(part(part(output, after, 1), before, 2), middle, part(part(output, between, 1), after, 2))
    spm = F.concat(part(part(output, between, 1), before, 2), middle, part(part(output, before, 1), after, 2))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and digests of the output and of the text restored from it."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    made = transformed(docs.withColumn("doc_id", F.col("doc_id").cast("long")))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))
