"""Tables as they lie in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Bytes of an Arrow batch that Python gets.
BATCH_BYTES = 4_000_000


def in_small_batches(spark: SparkSession) -> None:
    """Python functions of this session get at most BATCH_BYTES of rows at a time, whatever the length of the texts: 10,000 rows, Spark's only bound else, are as large as the texts in them. Spark reads the setting when a plan runs."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    in_small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """rows, dealt over all cores if they lie in fewer row groups than that: one task reads a row group, and parsing texts is dear.

    Tables that are read in more parts than there are cores stay as they are, without a shuffle or a look at their files;
    of others the parts that hold rows are counted, which reads footers alone.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() > cores:
        return rows
    busy = rows.select(F.spark_partition_id().alias("p")).distinct().count()
    return rows if busy >= cores else rows.repartition(cores)
