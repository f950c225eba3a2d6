"""Places of rows in an order, without a task that holds them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import scratch


def numbered(rows: DataFrame, *by: Column, descending: bool = False) -> DataFrame:
    """row (a struct of rows' columns), place (from 0 in the order of ``by``; the first of them may descend), n (of all rows).

    Rows are dealt into ranges of the order, sorted and written with their place in their range; the sizes of the ranges
    before, one number for each range, are added as they are read. Rows that tie have neighbouring places, the same at every
    read. ``by`` should tell rows apart where many tie, as ties lie in one range. Nulls come first, in descending order last.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = rows.select(F.struct("*").alias("row"), *[c.alias(f"by{i}") for i, c in enumerate(by)])
    order = [F.desc(f"by{i}") if descending and not i else F.asc(f"by{i}") for i in range(len(by))]
    part, mark = F.spark_partition_id(), F.monotonically_increasing_id()
    sorted_ = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("row", part.alias("part"), (mark - F.shiftleft(part.cast("long"), 33)).alias("at"))
    kept = scratch.kept(sorted_, "numbered")
    sizes = kept.groupBy("part").agg(F.count(F.lit(1)).alias("size"))  # a row for each range
    starts = sizes.select(F.col("part").alias("of"), F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"), F.sum("size").over(Window.partitionBy()).alias("n"))
    return kept.join(F.broadcast(starts), F.col("part") == F.col("of")).select("row", (F.col("start") + F.col("at")).alias("place"), "n")
