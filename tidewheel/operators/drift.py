"""Population stability index with exact quantile edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewheel.functions.numeric import interpolate, is_finite
from tidewheel.operators.quantiles import bucketed, values_at_ranks

# Bin count, smallest share of a bin, and the tolerances of "all close".
BINS = 10
_SMALLEST_SHARE = 1e-6
_CLOSE_ABSOLUTE = 1e-8
_CLOSE_RELATIVE = 1e-5


def _long_form(df: DataFrame, columns: Sequence[str], side: str) -> DataFrame:
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    is_reference = side == "reference"
    return (
        wide.unpivot([], list(columns), "feature", "value")
        .where(is_finite(F.col("value")))
        .select(
            "feature",
            "value",
            F.lit(int(is_reference)).cast("bigint").alias("reference"),
            F.lit(int(not is_reference)).cast("bigint").alias("current"),
        )
    )


def value_counts(
    reference: DataFrame, current: DataFrame | None, columns: Sequence[str]
) -> DataFrame:
    """Occurrences of every finite value on both sides: ``(feature, value, reference, current)``.

    Everything the index needs comes from this table, which is as short as the columns have
    distinct values. `psi` reads it several times: persist it when it is costly to build.
    """
    both = _long_form(reference, columns, "reference")
    if current is not None:
        both = both.unionByName(_long_form(current, columns, "current"))
    return both.groupBy("feature", "value").agg(
        F.sum("reference").alias("reference"), F.sum("current").alias("current")
    )


def quantile_edges(counts: DataFrame) -> DataFrame:
    """Sorted distinct reference quantiles per feature: ``(feature, edges)``."""
    used = counts.where("reference > 0").select("feature", "value", "reference")
    fractions = F.array(*[F.lit(1.0 if i == BINS else i * (1.0 / BINS)) for i in range(BINS + 1)])

    def positions(total: Column) -> Column:
        return F.transform(fractions, lambda p: p * (total - 1))

    def neighbours(total: Column) -> Column:
        around = F.transform(positions(total), lambda p: F.array(F.floor(p), F.ceil(p)))
        return F.flatten(around)

    at_rank = values_at_ranks(
        bucketed(used, "feature", "value"), "feature", "value", "reference", neighbours
    )
    # At most two rows per quantile and feature.
    by_rank = at_rank.groupBy("feature").agg(
        F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("_at"),
        F.max("total").alias("_total"),
    )
    edges = F.transform(
        positions(F.col("_total")),
        lambda p: interpolate(
            F.element_at("_at", F.floor(p)), F.element_at("_at", F.ceil(p)), p - F.floor(p)
        ),
    )
    return by_rank.select("feature", F.array_sort(F.array_distinct(edges)).alias("edges"))


def _reference_shape(counts: DataFrame) -> DataFrame:
    """One row per feature: reference size and range, inner edges, whether it is constant."""
    present = F.when(F.col("reference") > 0, F.col("value"))
    ranges = counts.groupBy("feature").agg(
        F.sum("reference").alias("n_reference"),
        F.min(present).alias("origin"),
        F.max(present).alias("_top"),
    )
    close = _CLOSE_ABSOLUTE + _CLOSE_RELATIVE * F.abs("origin")
    return ranges.join(F.broadcast(quantile_edges(counts)), "feature", "left").select(
        "feature",
        "n_reference",
        "origin",
        close.alias("close"),
        (F.col("_top") - F.col("origin") <= close).alias("constant"),
        F.size("edges").alias("n_edges"),
        F.slice("edges", F.lit(2), F.greatest(F.size("edges") - 2, F.lit(0))).alias("inner"),
    )


def _bin(value: str = "value") -> Column:
    return F.size(F.filter("inner", lambda k: k <= F.col(value)))


def _share(part: str, whole: str) -> Column:
    return F.greatest(F.try_divide(F.col(part), F.col(whole)), F.lit(_SMALLEST_SHARE))


def _term(c: Column, r: Column) -> Column:
    return (c - r) * F.ln(c / r)


def _score(total: Column) -> Column:
    """The index from its sum over bins, with the special cases first. A side without values
    scores 0; against a constant reference any move scores 1."""
    unmoved = (F.abs(F.col("low") - F.col("origin")) <= F.col("close")) & (
        F.abs(F.col("high") - F.col("origin")) <= F.col("close")
    )
    return (
        F.when((F.col("n_reference") == 0) | (F.col("n_current") == 0), 0.0)
        .when(F.col("constant"), F.when(unmoved, 0.0).otherwise(1.0))
        .when(F.col("n_edges") < 2, 0.0)
        .otherwise(total)
    )


def psi(counts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, psi)`` with one row per column, from `value_counts`."""
    present = F.when(F.col("current") > 0, F.col("value"))
    now = counts.groupBy("feature").agg(
        F.sum("current").alias("n_current"), F.min(present).alias("low"), F.max(present).alias("high")
    )
    # One row per feature.
    shape = _reference_shape(counts).join(F.broadcast(now), "feature")
    spread = (
        counts.join(F.broadcast(shape), "feature")
        .groupBy("feature", "n_reference", "n_current", _bin().alias("bin"))
        .agg(F.sum("reference").alias("reference"), F.sum("current").alias("current"))
        .groupBy("feature")
        .agg(
            F.sum(_term(_share("current", "n_current"), _share("reference", "n_reference"))).alias(
                "total"
            )
        )
    )
    names = counts.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    scored = shape.join(spread, "feature").select("feature", _score(F.col("total")).alias("psi"))
    return names.join(scored, "feature", "left").select(
        "feature", F.coalesce("psi", F.lit(0.0)).alias("psi")
    )


def daily_counts(rows: DataFrame, columns: Sequence[str], day: str) -> DataFrame:
    """Occurrences of every finite value per day: ``(day, feature, value, n)``. Days add up, see `folded`."""
    wide = rows.select(day, *[F.col(c).cast("double").alias(c) for c in columns])
    long = wide.unpivot([day], list(columns), "feature", "value").where(is_finite(F.col("value")))
    return long.groupBy(day, "feature", "value").agg(F.count(F.lit(1)).alias("n"))


def folded(daily: DataFrame) -> DataFrame:
    """`value_counts` of a reference from its days."""
    none = F.lit(0).cast("bigint").alias("current")
    return daily.groupBy("feature", "value").agg(F.sum("n").alias("reference"), none)


def reference_state(counts: DataFrame) -> DataFrame:
    """All that the index needs of a reference, one row per feature: size, range, inner edges, the share
    of each bin, and the sum over bins of a window without values."""
    shape = _reference_shape(counts)
    reference = (
        counts.where("reference > 0")
        .join(F.broadcast(shape), "feature")
        .groupBy("feature", "n_reference", _bin().alias("bin"))
        .agg(F.sum("reference").alias("reference"))
        .select("feature", "bin", _share("reference", "n_reference").alias("r"))
    )
    # At most one entry per bin.
    bins = reference.groupBy("feature").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "r"))).alias("shares"),
        F.sum(_term(F.lit(_SMALLEST_SHARE), F.col("r"))).alias("vacant"),
    )
    return shape.join(bins, "feature")


def psi_per_window(
    state: DataFrame, current: DataFrame, columns: Sequence[str], first: str, last: str
) -> DataFrame:
    """The index of many overlapping windows at once: ``(window, feature, psi)``.

    ``state`` is the stored `reference_state`; each row of ``current`` belongs to the windows
    numbered ``first`` to ``last``. Rows are counted per range and bin before these short counts
    are copied to the windows. The bins a window leaves empty enter through a constant: the sum
    is that of an empty window plus a correction per filled bin.
    """
    smallest = F.lit(_SMALLEST_SHARE)
    long = current.select(
        first, last, *[F.col(c).cast("double").alias(c) for c in columns]
    ).unpivot([first, last], list(columns), "feature", "value")
    # The state has one row per feature.
    panes = (
        long.where(is_finite(F.col("value")))
        .join(F.broadcast(state.select("feature", "inner")), "feature")
        .groupBy(first, last, "feature", _bin().alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
        )
    )
    filled = (
        panes.withColumn("window", F.explode(F.sequence(first, last)))
        .groupBy("window", "feature", "bin")
        .agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
        .withColumn("n_current", F.sum("n").over(Window.partitionBy("window", "feature")))
        .join(F.broadcast(state.select("feature", "shares")), "feature")
    )
    r = F.coalesce(F.element_at("shares", F.col("bin")), smallest)
    correction = _term(_share("n", "n_current"), r) - _term(smallest, r)
    return (
        filled.groupBy("window", "feature")
        .agg(
            F.sum(correction).alias("correction"),
            F.max("n_current").alias("n_current"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
        )
        .join(F.broadcast(state.drop("inner", "shares")), "feature")
        .select(
            "window", "feature", _score(F.col("vacant") + F.col("correction")).alias("psi")
        )
    )


def psi_from_state(state: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, psi)`` with one row per column, from a stored `reference_state`: only ``current`` is
    counted."""
    one = current.select(*columns, F.lit(0).alias("_first"), F.lit(0).alias("_last"))
    scored = psi_per_window(state, one, columns, "_first", "_last").select("feature", "psi")
    names = state.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    return names.join(F.broadcast(scored), "feature", "left").select(
        "feature", F.coalesce("psi", F.lit(0.0)).alias("psi")
    )
