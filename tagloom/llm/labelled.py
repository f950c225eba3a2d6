"""A bounded sample of labelled documents for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that a classifier learns from, at most: those with the smallest hashes of their id.
SAMPLE_ROWS = 20_000


def sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column | None = None, limit: int = SAMPLE_ROWS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text, label 0 or 1) of at most ``limit`` labelled documents; null labels and ids don't count, a label over 0 is 1.

    The chosen ids have at most ``limit`` rows, so they are broadcast; texts are not shuffled.
    """
    rows = labels.select(F.col(key).cast("long").alias("id"), F.col(label).cast("int").alias("label"))
    rows = rows.filter("id is not null and label is not null")
    if learn is not None:
        rows = rows.filter(learn)
    chosen = rows.groupBy("id").agg(F.max((F.col("label") > 0).cast("int")).alias("label")).orderBy(F.xxhash64("id"), "id").limit(limit)
    texts = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "id")
