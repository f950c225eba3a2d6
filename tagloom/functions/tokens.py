"""Token counts: pluggable, with a documented approximation by default.

``approximate`` counts runs of letters in pieces of at most six characters,
single digits, and single other characters that aren't white space. A vocabulary
file of a byte-level BPE can be plugged in instead; figures of the two don't compare.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .kinds import SIMPLE

APPROXIMATE = r"\p{L}{1,6}|\p{N}|[^\p{L}\p{N}\s]"
#: What a chat template adds to each message.
PER_MESSAGE = 5

#: Vocabularies of a worker, by file and pattern.
_loaded: dict[tuple[str, str], object] = {}
_pattern = None


def approximate_count(text: str) -> int:
    """As ``approximate``, for code that is in Python anyway."""
    global _pattern
    if _pattern is None:
        import regex

        _pattern = regex.compile(r"\p{L}{1,6}|\p{N}|[^\p{L}\p{N}\x09-\x0D\x20]")
    return len(_pattern.findall(text))


def approximate(text: Column) -> Column:
    """Approximate tokens of a text; null for null."""
    return F.regexp_count(text, F.lit(APPROXIMATE)).cast("long")


class Ranks:
    """A counter with the ranks of a vocabulary file (base64 token and rank in each line), loaded once in each worker."""

    def __init__(self, path: str, pattern: str = r"\p{L}+|\p{N}{1,3}|[^\s\p{L}\p{N}]+|\s+"):
        self.path, self.pattern = path, pattern

    def encode(self, text: str) -> list[int]:
        import tiktoken

        if (own := (self.path, self.pattern)) not in _loaded:
            with open(self.path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            _loaded[own] = tiktoken.Encoding(self.path, pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        return _loaded[own].encode_ordinary(text)

    def __call__(self, text: Column) -> Column:
        """Tokens of a text; null for null."""

        @F.pandas_udf(SIMPLE["long"])
        def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                yield pd.Series([None if t is None else len(self.encode(t)) for t in texts], dtype="Int64")

        return count(text)

    def total(self, texts: Column) -> Column:
        """Tokens of all texts of an array together; null texts have none."""

        @F.pandas_udf(SIMPLE["long"])
        def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for lists in batches:
                yield pd.Series([None if x is None else sum(len(self.encode(t)) for t in x if t is not None) for x in lists], dtype="Int64")

        return count(texts)


def of_chat(messages: Column, count: Callable[[Column], Column] = approximate) -> Column:
    """Tokens of messages array<struct<role, content>> as a chat template renders them. ``count`` is a JVM expression, or has ``total`` for whole arrays as Ranks does."""
    if hasattr(count, "total"):
        return count.total(F.transform(messages, lambda m: m["content"])) + F.size(messages) * PER_MESSAGE
    return F.aggregate(messages, F.lit(0).cast("long"), lambda n, m: n + count(m["content"]) + PER_MESSAGE)
