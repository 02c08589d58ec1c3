"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def is_finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def bounded_count(raw: Column, capacity: Column) -> Column:
    """Round half to even, then keep the value within ``0..capacity``; NULL stays NULL."""
    rounded = F.greatest(F.lit(0.0), F.least(capacity.cast("double"), F.bround(raw)))
    return F.when(raw.isNotNull() & capacity.isNotNull(), rounded.cast("bigint"))


def interpolate(low: Column, high: Column, weight: Column) -> Column:
    """Point between two neighbours, computed from the nearer one."""
    step = high - low
    return F.when(weight < 0.5, low + step * weight).otherwise(high - step * (1 - weight))


def ratio_or_zero(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))
