"""Exact quantiles of large groups.

Equal values are counted first. Approximate cuts then deal the distinct values of
a group into ranges; ranks within a range are added to the counts of the ranges
before. So no task holds a group, however large, and the values found are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of a group, a power of two: the range of a value is found by halving.
RANGES = 128


def counted(rows: DataFrame, by: dict[str, Column], value: Column) -> DataFrame:
    """The columns of ``by``, v, c: how often each value (double) occurs in each group; null values don't count."""
    view = rows.select(*[c.alias(n) for n, c in by.items()], value.cast("double").alias("v")).filter("v is not null")
    return view.groupBy(*by, "v").agg(F.count(F.lit(1)).alias("c"))


def range_of(cuts: Column, value: Column) -> Column:
    """How many of the sorted cuts (one less than RANGES) are less than the value."""
    steps = F.array(*[F.lit(RANGES >> k) for k in range(1, RANGES.bit_length())])
    return F.aggregate(steps, F.lit(0), lambda n, step: F.when(F.get(cuts, n + step - 1) < value, n + step).otherwise(n))


def quantiles(counts: DataFrame, by: list[str], probabilities: list[float], upper: bool = False) -> DataFrame:
    """The columns of ``by``, size, and q array<double>: interpolated quantiles of counts(by..., v, c); with ``upper`` instead the element at floor(size * p), from 0."""
    cuts = counts.groupBy(*by).agg(F.percentile_approx("v", [i / RANGES for i in range(1, RANGES)], 1_000).alias("cuts")).select(*[F.col(b).alias(f"cut_{b}") for b in by], "cuts")
    same = lambda right: [F.col(b).eqNullSafe(F.col(f"{right}_{b}")) for b in by] or [F.lit(True)]
    every = lambda conditions: conditions[0] if len(conditions) == 1 else conditions[0] & every(conditions[1:])
    cut = counts.crossJoin(F.broadcast(cuts)) if not by else counts.join(cuts, every(same("cut")))  # without groups: one row of cuts
    ranged = cut.select(*by, "v", "c", range_of(F.col("cuts"), F.col("v")).alias("range"))
    sizes = ranged.groupBy(*by, "range").agg(F.sum("c").alias("s"))
    group = Window.partitionBy(*by)
    starts = sizes.select(
        *[F.col(b).alias(f"start_{b}") for b in by], F.col("range").alias("start_range"),
        F.coalesce(F.sum("s").over(group.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"), F.sum("s").over(group).alias("size"),
    )
    placed = ranged.join(starts, every([F.col("range") == F.col("start_range"), *(same("start") if by else [])]))
    last = placed.select(*by, "v", "size", (F.col("before") + F.sum("c").over(Window.partitionBy(*by, "range").orderBy("v"))).alias("last"))
    at = lambda place: F.min(F.when(F.col("last") > place, F.col("v")))
    found = []
    for i, p in enumerate(probabilities):
        place = F.floor(F.col("size") * F.lit(p)) if upper else (F.col("size") - 1) * F.lit(float(p))
        found += [at(F.floor(place)).alias(f"low{i}"), at(F.ceil(place)).alias(f"high{i}")]
    ends = last.groupBy(*by).agg(F.max("size").alias("size"), *found)
    whole = lambda i, p: F.lit(0.0) if upper else (F.col("size") - 1) * F.lit(float(p)) - F.floor((F.col("size") - 1) * F.lit(float(p)))
    values = [F.col(f"low{i}") + (F.col(f"high{i}") - F.col(f"low{i}")) * whole(i, p) for i, p in enumerate(probabilities)]
    return ends.select(*by, "size", F.array(*values).alias("q"))
