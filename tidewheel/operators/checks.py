"""Data tests. Each yields its failing rows or counts; a summary turns them into a verdict."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from tidewheel.operators import bounds

# Columns that may not be NULL, per table.
NOT_NULL = {
    "staged": (
        "station_id",
        "event_timestamp",
        "available_bikes",
        "available_docks",
        "capacity",
    ),
    "history": (
        "station_id",
        "event_timestamp",
        "feature_observed_at",
        "hour_utc",
        "day_of_week",
        "available_bikes",
        "available_docks",
        "capacity",
        "availability_ratio",
    ),
}

class ChecksFailed(RuntimeError):
    """At least one data test found failing rows."""


def duplicate_keys(
    df: DataFrame, keys: Sequence[str] = ("station_id", "event_timestamp")
) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def null_counts(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """One row per column with its number of NULLs, from a single pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(
        *[
            F.struct(F.lit(f"not_null_{table}_{c}").alias("check"), F.col(c).alias("failing_rows"))
            for c in columns
        ]
    )
    return counts.select(F.inline(pairs))


def out_of_bounds(history: DataFrame) -> DataFrame:
    """Feature rows that break a physical bound."""
    return history.where(~bounds.kept())


def _counted(name: str, failing: DataFrame) -> DataFrame:
    return failing.agg(F.count(F.lit(1)).alias("failing_rows")).select(
        F.lit(name).alias("check"), "failing_rows"
    )


def run_checks(
    staged: DataFrame, history: DataFrame, extra: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """All data tests as ``(check, failing_rows, status)``. ``extra`` maps a name to failing rows."""
    results = null_counts(staged, NOT_NULL["staged"], "staged")
    results = results.unionByName(null_counts(history, NOT_NULL["history"], "history"))
    results = results.unionByName(_counted("unique_station_timestamp", duplicate_keys(history)))
    results = results.unionByName(_counted("feature_bounds", out_of_bounds(history)))
    for name, failing in (extra or {}).items():
        results = results.unionByName(_counted(name, failing))
    status = F.when(F.col("failing_rows") > 0, "fail").otherwise("pass")
    return results.withColumn("status", status)


def summarize(results: DataFrame) -> DataFrame:
    """Number of checks per status; a missing status counts as unknown."""
    return results.groupBy(F.coalesce("status", F.lit("unknown")).alias("status")).agg(
        F.count(F.lit(1)).alias("checks")
    )


def require_passed(results: DataFrame) -> None:
    """Raise if any check failed. The result table has one short row per check."""
    failed = [r["check"] for r in results.where("status <> 'pass'").orderBy("check").collect()]
    if failed:
        raise ChecksFailed(f"failed checks: {', '.join(failed)}")
