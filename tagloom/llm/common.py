"""What the operators of this subpackage share: storage, words and bounded samples."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import tables

#: Words are runs of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD_BYTES = re.compile(rb"[^\x20\x09-\x0D]+")
SPACES = r"[\x20\x09-\x0D]+"
#: Characters of text that a Python step handles at a time.
CHUNK_CHARS = 1_000_000
#: Bytes of an Arrow batch that Python gets.
BATCH_BYTES = 4_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share. Where it is unset, a fresh local one in local mode; on a cluster that is an error."""
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="tagloom-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: lineage ends here, and a lost executor costs nothing before it."""
    return saved(df, name)[0]


def saved(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As ``written``, with the path."""
    spark = df.sparkSession
    df.write.parquet(path := new_path(spark, name))
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Removes a written table that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """df with a row number ``rid``, written in buckets by it: joins on ``rid`` don't move these rows again, and no bucket is hot.

    The rows are read from files in the shared folder; the catalog keeps no entry.
    """
    spark = df.sparkSession
    parts = min(100_000, max(int(spark.conf.get("spark.sql.shuffle.partitions")), df.rdd.getNumPartitions()))
    numbered, entry = df.withColumn("rid", F.monotonically_increasing_id()), f"tagloom_{uuid.uuid4().hex}"
    numbered.repartition(parts, "rid").write.format("parquet").option("path", new_path(spark, name)).bucketBy(parts, "rid").saveAsTable(entry)
    table = spark.table(entry)
    table.schema  # resolved before the entry goes
    spark.sql(f"DROP TABLE {entry}")
    return table


def give_back() -> None:
    """Returns freed memory to the system; a worker lives on for the tasks of later stages and would keep it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # only some C libraries can
        ctypes.CDLL(None).malloc_trim(0)


def mapped(df: DataFrame, run, schema) -> DataFrame:
    """df.mapInArrow(run, schema) in bounded memory.

    Python gets at most BATCH_BYTES at a time, whatever the length of the texts; this is a setting of df's session,
    which Spark reads when the plan runs. What ``run`` held is given back when its task ends.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(whole, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder; documents and pages that lie in fewer row groups than there are cores are dealt over the cores."""
    rows = tables.table(spark, sf_dir, name)
    return tables.spread(rows) if name in ("documents", "pages") else rows


def chunks(texts: list[str], limit: int = CHUNK_CHARS):
    """(start, end) of successive groups of texts with about ``limit`` characters each; a longer text stands alone."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > start and size + n > limit:
            yield start, i
            start = i
            size = 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def crc_mod(doc_id, mod: int):
    """crc32 of the id as text, modulo ``mod``; null ids count as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(mod)).cast("int")
