"""What a feature row must satisfy, stated once for the data tests and for monitoring."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def rules() -> dict[str, Column]:
    """A condition per column; NULL where a value is missing."""
    capacity = F.col("capacity")
    return {
        "capacity": capacity > 0,
        "available_bikes": F.col("available_bikes").between(F.lit(0), capacity),
        "available_docks": F.col("available_docks").between(F.lit(0), capacity),
        "availability_ratio": F.col("availability_ratio").between(0, 1),
    }


def kept() -> Column:
    """All rules at once: false if any is broken, NULL if none is but one cannot be told."""
    return reduce(lambda a, b: a & b, rules().values())
