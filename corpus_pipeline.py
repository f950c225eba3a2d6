"""The corpus pipeline: quality rules, n-gram Jaccard join, substring dedup, benchmark decontamination, SentencePiece.

Each stage takes (spark, docs, sf_dir) and is written as Parquet and read again
before the next. All but the last return the columns of ``documents``; the last
returns doc_id, n_tokens, ids_sha256, decoded_sha256 of what was kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import decontaminate, ngram_join, quality_rules, sentencepiece_bpe, substring_dedup
from tagloom.llm.common import table, written
from tagloom.llm.queries import piece_model


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return ngram_join.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has; n_chars follows the text."""
    return substring_dedup.without_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text decoded from them."""
    return sentencepiece_bpe.digests(docs, piece_model())


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", benchmark_free),
    ("SentencePiece encoding and decoding", encoded),
]

#: Connected components and SentencePiece are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written before the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage{k}")
    return docs
