"""Connected components of links, by alternating large and small stars over DataFrames.

Each round is two aggregations with map-side minima and two joins; a hub's rows are one key of these joins,
whose partitions Spark splits from its threshold for skew on (below it a partition is small). The links of a
round are written to the shared folder, and those of the round before removed. Rounds end when every tree is
a star, which is tested on the links themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, mapped, saved


class Forest:
    """Union-find over any hashable members; the root of a set is its smallest member."""

    def __init__(self):
        self.up: dict = {}

    def root(self, x):
        up = self.up
        top = x
        while (y := up.get(top, top)) != top:
            top = y
        while x != top:
            up[x], x = top, up.get(x, x)
        return top

    def join(self, a, b) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        if b < a:
            a, b = b, a
        self.up[b] = a
        return True


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces the links of each batch by stars; a batch has a bounded number of rows."""
    for b in batches:
        forest = Forest()
        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            forest.join(x, y)
        members = list(forest.up)
        yield pa.RecordBatch.from_arrays([pa.array(members, pa.int64()), pa.array([forest.root(x) for x in members], pa.int64())], ["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of links(a, b), both long; root is the smallest node it reaches. Nodes without a link to another have no row."""
    links = links.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b")
    links, path = saved(links.transform(mapped, _contract, "a long, b long").distinct(), "links")
    while True:
        # Done when every tree is a star: each node has one link, and leads to a node that has none.
        ends = links.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("top")).union(links.select("b", F.lit(0), F.lit(1)))
        nodes = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("top").alias("top"))
        if nodes.filter("out > 1 or (out = 1 and top = 1)").isEmpty():
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(links.select("b", "b")).distinct()
        # Large star: all larger neighbours move to the smallest of the neighbourhood.
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: a node and its smaller neighbours move to the smallest of these.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("x")).select("x.*")
        old = path
        links, path = saved(small.filter("a <> b").distinct(), "links")
        discard(links.sparkSession, old)
