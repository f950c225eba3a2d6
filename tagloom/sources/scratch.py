"""Folders for what a job writes on its way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share; in local mode a temporary one will do."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="tagloom-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(rows: DataFrame, name: str) -> DataFrame:
    """rows written and read again: what several later steps read without making it anew."""
    rows.write.parquet(place := folder(rows.sparkSession, name))
    return rows.sparkSession.read.schema(rows.schema).parquet(place)
