"""Exact order statistics without sorting a whole column in one task.

Input is a table of distinct values with counts. A monotone bucket number splits the values of
each group into ranges. Bucket totals give every bucket its starting rank; only the buckets
that hold a wanted rank are then ordered, each in its own task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

SPLITTERS = 1023  # 2**k - 1, searched in k steps
_SKETCH_ACCURACY = 20_000


def upper_bound(sorted_values: Column, x: Column, size: int) -> Column:
    """How many of the ``size`` = 2**k - 1 sorted values are <= ``x``, by binary search."""
    steps = []
    step = (size + 1) // 2
    while step:
        steps.append(step)
        step //= 2
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda low, s: F.when(
            F.element_at(sorted_values, low + s) <= x, low + s
        ).otherwise(low),
    )


def bucketed(counts: DataFrame, by: str, value: str) -> DataFrame:
    """Add ``_bucket``: a range number with a similar count of distinct values in each range.

    The splitters come from a mergeable sketch. They only balance the work: ranks taken from
    the buckets are exact whatever the splitters are.
    """
    shares = ",".join(f"{i / (SPLITTERS + 1)!r}D" for i in range(1, SPLITTERS + 1))
    points = F.expr(f"array({shares})")
    cuts = counts.groupBy(by).agg(
        F.percentile_approx(value, points, _SKETCH_ACCURACY).alias("_cuts")
    )
    # One row of fixed width per group; a group is a column name here.
    joined = counts.join(F.broadcast(cuts), by)
    return joined.withColumn(
        "_bucket", upper_bound(F.col("_cuts"), F.col(value), SPLITTERS)
    ).drop("_cuts")


def values_at_ranks(
    counts: DataFrame, by: str, value: str, weight: str, ranks: Callable[[Column], Column]
) -> DataFrame:
    """The values at wanted 0-based ranks: ``(by, rank, value, total)``.

    ``counts(by, _bucket, value, weight)`` has distinct values. ``ranks`` turns the total weight
    of a group into a short array of positions.
    """
    group = Window.partitionBy(by)
    starts = (
        counts.groupBy(by, "_bucket")
        .agg(F.sum(weight).alias("_n"))
        .withColumn("_start", F.sum("_n").over(group.orderBy("_bucket")) - F.col("_n"))
        .withColumn("total", F.sum("_n").over(group))
    )
    held = F.filter(
        F.array_distinct(ranks(F.col("total"))),
        lambda r: (F.col("_start") <= r) & (r < F.col("_start") + F.col("_n")),
    )
    wanted = starts.withColumn("_ranks", held).where(F.size("_ranks") > 0).drop("_n")
    # At most one row per wanted rank.
    inside = counts.join(F.broadcast(wanted), [by, "_bucket"])
    in_bucket = Window.partitionBy(by, "_bucket").orderBy(value)
    return (
        inside.withColumn("_upto", F.col("_start") + F.sum(weight).over(in_bucket))
        .withColumn("rank", F.explode("_ranks"))
        .where((F.col("rank") < F.col("_upto")) & (F.col("rank") >= F.col("_upto") - F.col(weight)))
        .select(by, "rank", value, "total")
    )
