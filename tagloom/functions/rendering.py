"""JSON as text: compact, or with an indent of 2; key order, letters and numbers as they were read."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from .kinds import SIMPLE


def rendered(raw: str | None, indent: int | None) -> str | None:
    """Null for null; text that isn't JSON is an error."""
    return None if raw is None else json.dumps(json.loads(raw), ensure_ascii=False, indent=indent)


@F.pandas_udf(SIMPLE["string"])
def pretty_json(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield texts.map(lambda t: rendered(t, 2), na_action="ignore").astype(object)


@F.pandas_udf(SIMPLE["string"])
def compact_json(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield texts.map(lambda t: rendered(t, None), na_action="ignore").astype(object)
