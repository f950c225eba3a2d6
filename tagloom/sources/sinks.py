"""Sinks: JSON lines, split tables, CSV, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def golden_line(html: Column, expected_json: Column) -> Column:
    """A golden record as one JSON line; the label's text goes in as it stands, so its numbers and key order stay."""
    return F.concat(F.lit('{"example_html": '), quoted(html), F.lit(', "expected_json": '), expected_json, F.lit("}"))


def quoted(text: Column) -> Column:
    """A JSON string, not ASCII-escaped."""
    listed = F.to_json(F.array(text))
    return listed.substr(F.lit(2), F.length(listed) - 2)


def chat_line(messages: Column) -> Column:
    """A chat example as one JSON line."""
    return F.to_json(F.struct(messages.alias("messages")), {"ignoreNullFields": "false"})


def write_lines(df: DataFrame, line: Column, path: str, order: str | None = None) -> None:
    """One text file for each partition; with ``order`` (a column) the files, in order of their names, hold the lines in that order: each has a range of it."""
    out = df.select(line.alias("value"), *([F.col(order).alias("at")] if order else []))
    if order:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        out = out.repartitionByRange(parts, "at").sortWithinPartitions("at")
    out.select("value").write.mode("overwrite").text(path)


def write_splits(df: DataFrame, path: str, split: str = "split") -> None:
    df.write.mode("overwrite").partitionBy(split).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
