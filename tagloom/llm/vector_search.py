"""Exact search for the vectors of largest inner product, with an index of distances to pivots.

A vector x lies in the cell of its nearest pivot p, at the distance r from it; the rows of a cell, sorted by r, are cut into
annuli of a bounded number of rows. For a query q at distance d from p, the triangle inequality gives |q - x| >= |d - r|,
and 2 q.x = |q|^2 + |x|^2 - |q - x|^2, so no vector of an annulus [low, high] with norms up to ``top`` scores more than
half of |q|^2 + top^2 - gap^2, where gap is the distance of d from [low, high]. A query first visits the annulus where
it would itself lie; its k-th best score there is a floor. Then it expands to the annuli whose bound reaches the floor,
and within each to the radii that can. All others are passed over: nothing that is left out can be among the k best.

The index is fitted (the pivots) on a bounded sample and holds every vector; the search is exact whatever the pivots are.
Every pair of a visited annulus and a part of the queries is one group of a cogroup, of a bounded number of rows on both sides.

Edge cases: vectors that are null, hold a null, or a component that is not finite after scaling, take no part; neither do
rows without an id. A vector shorter than others counts as followed by zeros, an empty one as all zeros. Equal rows count
once; a query doesn't find rows of its own id. Of many equal vectors only the k + 1 smallest ids can be among
anybody's k best, so the others are left out before the search. Ties go to the smaller id. Scores are exact integers;
those beyond 64 bits are ordered as they are and given as the largest or least 64-bit integer. Empty tables give none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import mapped, written

#: Rows on which the pivots are fitted: those with the smallest hash of the id.
SAMPLE_ROWS = 4_096
#: Rows of an annulus, a power of two, and about as many queries as meet it in one task.
ANNULUS_ROWS, PART_QUERIES = 32_768, 16_384
#: Scores that are computed together.
TILE = 4_000_000
LONG = 2**63


def whole_numbers(vector: Column, scale: float) -> Column:
    """floor(scale * x) of each component, as doubles."""
    return F.transform(vector.cast("array<double>"), lambda x: F.when(F.abs(x * scale) < 2.0**53, F.floor(x * scale).cast("double")).otherwise(x * scale))


def taking_part(vector: Column) -> Column:
    return F.coalesce(F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))), F.lit(False))


def matrix(vectors: pa.ListArray, width: int = 0) -> np.ndarray:
    """Rows of float64; shorter vectors end with zeros."""
    lengths = np.diff(edges := vectors.offsets.to_numpy())
    values = vectors.values.to_numpy(zero_copy_only=False)[edges[0] : edges[-1]]
    width = max(width, int(lengths.max(initial=0)))
    if len(lengths) and (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(values)) - np.repeat(edges[:-1] - edges[0], lengths)] = values
    return out


def wider(x: np.ndarray, width: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, width - x.shape[1]))) if x.shape[1] < width else x


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    width = max(x.shape[1], pivots.shape[1])
    x, pivots = wider(x, width), wider(pivots, width)
    with np.errstate(over="ignore", invalid="ignore"):
        square = (x * x).sum(1)[:, None] + (pivots * pivots).sum(1) - 2 * (x @ pivots.T)
    return np.sqrt(np.maximum(np.nan_to_num(square, nan=np.inf), 0))


def fit(vectors: DataFrame, n_pivots: int, sample_rows: int = SAMPLE_ROWS, rounds: int = 8) -> np.ndarray:
    """Pivots: means of a bounded sample's clusters; a single zero vector where there is nothing to learn from."""
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("vec").toArrow().column(0).combine_chunks()
    x = matrix(rows) if len(rows) else np.zeros((1, 1))
    pivots = np.unique(x, axis=0)
    pivots = pivots[np.linspace(0, len(pivots) - 1, min(n_pivots, len(pivots))).astype(int)]
    for _ in range(rounds):
        near = distances(x, pivots).argmin(1)
        pivots = np.stack([x[near == j].mean(0) for j in np.unique(near)])
    return pivots


def scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products: float64 where every sum is below 2**53 and so exact, else Python's integers."""
    width = max(queries.shape[1], vectors.shape[1])
    queries, vectors = wider(queries, width), wider(vectors, width)
    if (np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0)) * max(1, width) < 2.0**53:
        return queries @ vectors.T
    whole = lambda m: np.array([[int(v) for v in row] for row in m.tolist()], object).reshape(m.shape)
    return whole(queries) @ whole(vectors).T


def prepared(rows: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """(vec_id, vec) of the rows that take part, equal rows once."""
    made = rows.select(F.col(key).cast("long").alias("vec_id"), whole_numbers(F.col(vector), scale).alias("vec"))
    return made.filter(F.col("vec_id").isNotNull() & taking_part(F.col("vec")))


def keyed(vectors: DataFrame, pivots: np.ndarray, every: bool) -> DataFrame:
    """vectors with their square norm, nearest pivot and distance from it, or (``every``) the distances from all pivots."""

    def run(batches):
        for b in batches:
            x = matrix(b.column(1))
            far = distances(x, pivots)
            near = far.argmin(1) if len(far) else np.empty(0, np.int64)
            columns = [*b.columns, pa.array((x * x).sum(1)), pa.array(near.astype(np.int32)), pa.array(far[np.arange(len(far)), near])]
            if every:
                columns.append(pa.FixedSizeListArray.from_arrays(pa.array(far.ravel()), len(pivots)).cast(pa.list_(pa.float64())))
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["vec_id", "vec", "square", "pivot", "radius"] + ["far"] * every
    return vectors.transform(mapped, run, "vec_id long, vec array<double>, square double, pivot int, radius double" + ", far array<double>" * every)


def index(vectors: DataFrame, pivots: np.ndarray, k: int, annulus: int = ANNULUS_ROWS) -> DataFrame:
    """Every vector (of equal ones the k + 1 smallest ids) by cell and radius, with the number of its annulus, in the shared folder."""
    if annulus & (annulus - 1):
        raise ValueError("the rows of an annulus must be a power of two")
    spark = vectors.sparkSession
    alike = Window.partitionBy("vec").orderBy("vec_id")
    few = vectors.distinct().withColumn("nth", F.row_number().over(alike)).filter(F.col("nth") <= k + 1).drop("nth")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = written(keyed(few, pivots, False), "keyed").repartitionByRange(parts, "pivot", "radius", "vec_id").sortWithinPartitions("pivot", "radius", "vec_id")
    place = F.monotonically_increasing_id()  # counts on within a partition, so that equal quotients are neighbours
    return written(ordered.withColumn("annulus", F.shiftright(place, annulus.bit_length() - 1) * len(pivots) + F.col("pivot")), "index")


def directory(indexed: DataFrame) -> DataFrame:
    """A row for each annulus: its cell, its radii and its largest square norm."""
    return indexed.groupBy("annulus", "pivot").agg(F.min("radius").alias("low"), F.max("radius").alias("high"), F.max("square").alias("top"))


#: Of a visit: what a query found in one annulus.
FOUND = "query_id long, query long, vec_id long, score decimal(38,0)"


def visit(pairs: DataFrame, indexed: DataFrame, k: int, n_parts: int) -> DataFrame:
    """The k best of each query in each annulus that it is paired with, as far as they reach the query's floor.

    pairs: annulus, part, query (row number), vec_id, vec, square, d (distance from the annulus's pivot), floor (or null).
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            q, x = (matrix(t.column("vec").combine_chunks()) for t in (left, right))
            own, query, d, square, floor = (left.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("vec_id", "query", "d", "square", "floor"))
            order = np.argsort(right.column("radius").to_numpy(), kind="stable")
            x, ids = x[order], right.column("vec_id").to_numpy()[order]
            radius, top = right.column("radius").to_numpy()[order], right.column("square").to_numpy().max()
            with np.errstate(invalid="ignore", over="ignore"):
                reach = np.sqrt(np.maximum(square + top - 2 * floor + slack(square + top), 0))
            reach[np.isnan(reach)] = np.inf  # no floor yet
            first, last = np.searchsorted(radius, d - reach), np.searchsorted(radius, d + reach, "right")
            turn = np.argsort(first, kind="stable")  # queries that start together share a tile
            step = max(1, TILE // len(x))
            for at in range(0, len(turn), step):
                these = turn[at : at + step]
                a, b = first[these].min(), last[these].max()
                if a < b:
                    found = scores(q[these], x[a:b])
                    for i, row in zip(these, found, strict=True):
                        out.extend(best(row, ids[a:b], own[i], floor[i], k, query[i]))
        columns = list(zip(*out, strict=True)) or [()] * 4
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.decimal128(38, 0))], ["query_id", "query", "vec_id", "score"])

    rows = indexed.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1)))).select("annulus", "part", "vec_id", "vec", "square", "radius")
    return pairs.groupBy("annulus", "part").cogroup(rows.groupBy("annulus", "part")).applyInArrow(run, FOUND)


def slack(size):
    """What rounding can add to a bound; it only widens the search."""
    return 1e-6 * size + 1e-3


def best(row: np.ndarray, ids: np.ndarray, own: int, floor: float, k: int, query: int) -> list[tuple]:
    """The k largest of the scores that reach the floor (nan: all), ties to the smaller id."""
    from decimal import Decimal

    fine = np.flatnonzero(ids != own) if np.isnan(floor) else np.flatnonzero((ids != own) & (row >= floor))
    if len(fine) > k and row.dtype != object:
        fine = fine[row[fine] >= np.partition(row[fine], len(fine) - k)[len(fine) - k]]
    order = sorted(fine.tolist(), key=lambda j: (-row[j], ids[j]))[:k]
    limit = 10**38 - 1
    return [(int(own), int(query), int(ids[j]), Decimal(max(-limit, min(limit, int(row[j]))))) for j in order]


def ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(indexed: DataFrame, pivots: np.ndarray, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k rows of the index with the largest inner product with each query."""
    spark = indexed.sparkSession
    asked = written(keyed(queries.distinct(), pivots, True).withColumn("query", F.monotonically_increasing_id()), "queries")
    n_parts = max(1, -(-asked.count() // PART_QUERIES))
    part = F.pmod(F.xxhash64("query"), F.lit(n_parts)).cast("int")
    asked = asked.withColumn("part", part)
    places = written(directory(indexed), "directory")
    everywhere = places.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))))

    gap = F.greatest(F.col("low") - F.col("d"), F.col("d") - F.col("high"), F.lit(0.0))
    columns = ["annulus", "part", "query", "vec_id", "vec", "square", "d", "floor"]
    at_home = asked.withColumn("d", F.col("radius")).join(everywhere, ["pivot", "part"]).groupBy("query").agg(F.min_by("annulus", F.struct(gap, "annulus")).alias("annulus"))
    homes = written(at_home, "homes")
    first = asked.withColumn("d", F.col("radius")).withColumn("floor", F.lit(None).cast("double")).join(homes, "query").select(columns)
    found = written(visit(first, indexed, k, n_parts), "found")
    floors = found.groupBy("query").agg(F.count("*").alias("n"), F.min("score").cast("double").alias("least")).filter(F.col("n") >= k).select("query", "least")

    cells = places.groupBy("pivot").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.max("top").alias("top"))  # a row for each pivot
    reaches = F.col("floor").isNull() | ((F.col("square") + F.col("top") - gap * gap) / 2 + slack(F.col("square") + F.col("top")) >= F.col("floor"))
    spread = asked.drop("pivot", "radius").join(floors.withColumnRenamed("least", "floor"), "query", "left")
    spread = spread.select("*", F.posexplode("far").alias("pivot", "d")).drop("far")
    spread = spread.join(F.broadcast(cells), "pivot").filter(reaches).drop("low", "high", "top")
    onward = spread.join(everywhere, ["pivot", "part"]).filter(reaches).join(homes, ["query", "annulus"], "left_anti").select(columns)
    rest = visit(onward, indexed, k, n_parts)
    most, least = (F.lit(str(x)).cast("decimal(38,0)") for x in (LONG - 1, -LONG))
    long = F.least(most, F.greatest(least, F.col("score"))).cast("long")
    return ranked(found.unionByName(rest), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", long.alias("score"))


def top_inner_products(rows: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: float = 256.0, n_pivots: int = 0, annulus: int = ANNULUS_ROWS) -> DataFrame:
    """The k rows with the largest inner product with each query, among all rows but those of the query's own id.

    ``n_pivots``: cells of the index, by default the root of the number of rows over 8, from 4 to 256.
    """
    vectors, asked = (prepared(x, key, vector, scale) for x in (rows, queries))
    n_pivots = n_pivots or int(min(256, max(4, vectors.count() ** 0.5 / 8)))
    pivots = fit(vectors, n_pivots)
    return search(index(vectors, pivots, k, annulus), pivots, asked, k)
