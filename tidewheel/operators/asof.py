"""As-of joins by key and time.

All joins here share one plan. Points lie on whole seconds, as station times do; probes may lie
anywhere. Points collapse to one per (key, second) and probes to distinct (key, second) pairs,
both with map-side combining, so no pair of key and time span holds more rows than seconds.
Time is cut into slices a few tolerances wide, so that a key with a large share of the rows is
sorted by many tasks; a point is copied into the neighbouring slice only if a probe there could
reach it. Running windows inside a slice carry the last point at or before each probed second
and the first point after it. These join back to the rows on (key, second) with a fresh shuffle
on both sides, where adaptive execution can split a crowded second, and the exact times decide.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidewheel.functions import clock

_MICROS = 1_000_000
_SLICE_TOLERANCES = 8


def _is_timestamp(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.TimestampType)


def _micros(df: DataFrame, column: str) -> Column:
    """Microseconds of a TIMESTAMP column, or of a column of epoch seconds."""
    if _is_timestamp(df, column):
        return F.unix_micros(column)
    return F.col(column).cast("bigint") * _MICROS


def _seconds(df: DataFrame, column: str) -> Column:
    """Epoch seconds of a column of points; a TIMESTAMP with a fraction is an error."""
    if not _is_timestamp(df, column):
        return F.col(column).cast("bigint")
    exact = F.unix_micros(column) % _MICROS == 0
    error = F.raise_error(F.lit(f"{column} must hold whole seconds")).cast("bigint")
    return F.when(F.col(column).isNull() | exact, F.unix_seconds(column)).otherwise(error)


def _match(
    probes: DataFrame, points: DataFrame, by: Sequence[str], back: int, ahead: int
) -> DataFrame:
    """For unique ``probes(by, _s)`` and ``points(by, _s, _point)`` add ``_before``, the last
    point at or before the second, and if ``ahead`` ``_after``, the first one after it, as
    struct(at, point). Points out of reach may be missing or not."""
    width = max(clock.HOUR, _SLICE_TOLERANCES * (back + ahead))
    reached = F.sequence(
        clock.bucket_of(F.col("_s") - ahead, width), clock.bucket_of(F.col("_s") + back, width)
    )
    found = F.struct(F.col("_s").alias("at"), F.col("_point").alias("point"))
    sides = points.select(*by, "_s", F.explode(reached).alias("_slice"), found.alias("_found"))
    asks = probes.select(
        *by, "_s", clock.bucket_of(F.col("_s"), width).alias("_slice"), F.lit(True).alias("_ask")
    )
    both = sides.unionByName(asks, allowMissingColumns=True)
    group = Window.partitionBy(*by, "_slice")
    so_far = (Window.unboundedPreceding, Window.currentRow)
    # A point of the probed second sorts before the probe upward and, as it is not after it,
    # behind the probe downward.
    upward = group.orderBy("_s", F.asc_nulls_first("_ask")).rowsBetween(*so_far)
    downward = group.orderBy(F.desc("_s"), F.asc_nulls_last("_ask")).rowsBetween(*so_far)
    columns = [F.last("_found", ignorenulls=True).over(upward).alias("_before")]
    if ahead:
        columns.append(F.last("_found", ignorenulls=True).over(downward).alias("_after"))
    return both.select("*", *columns).where("_ask").drop("_slice", "_found", "_ask")


def _matched_rows(
    rows: DataFrame, at: Column, points: DataFrame, by: Sequence[str], back: int, ahead: int
) -> DataFrame:
    """``rows`` with ``_us``, their time in microseconds, and the points around it."""
    timed = rows.withColumn("_us", at)
    timed = timed.withColumn("_s", clock.bucket_of(F.col("_us"), _MICROS))
    probes = timed.select(*by, "_s").dropna().distinct()
    sides = _match(probes, points, by, back, ahead)
    return timed.join(sides, [*by, "_s"], "left")


def _points(rows: DataFrame, at: Column, by: Sequence[str], point: Column) -> DataFrame:
    """One point per second: the greatest, so that ties do not depend on row order."""
    return (
        rows.select(*by, at.alias("_s"), point.alias("_point"))
        .dropna(subset=[*by, "_s"])
        .groupBy(*by, "_s")
        .agg(F.max("_point").alias("_point"))
    )


def nearest_asof(
    predictions: DataFrame,
    observations: DataFrame,
    tolerance_seconds: int,
    *,
    by: Sequence[str] = ("station_id",),
    target: str = "target_at",
    observed: str = "last_reported",
    value: str = "num_bikes_available",
    tie_break: str = "event_id",
) -> DataFrame:
    """Give each prediction the observation nearest to its target time, if near enough.

    Adds ``actual_at`` (epoch seconds) and ``actual_available_bikes``, NULL without a match;
    rows in equal rows out. The tolerance is inclusive. Of two equally near observations the
    earlier wins; of several at one instant the one with the greatest ``tie_break``.
    """
    points = _points(
        observations,
        _seconds(observations, observed),
        by,
        F.struct(F.col(tie_break), F.col(value).alias("value")),
    )
    near = _matched_rows(
        predictions,
        _micros(predictions, target),
        points,
        by,
        tolerance_seconds + 1,
        tolerance_seconds + 1,
    )
    reach = tolerance_seconds * _MICROS
    gap_before = F.col("_us") - F.col("_before.at") * _MICROS
    gap_after = F.col("_after.at") * _MICROS - F.col("_us")
    hit = F.when(
        (gap_before <= reach) & (F.col("_after").isNull() | (gap_before <= gap_after)),
        F.col("_before"),
    ).when(gap_after <= reach, F.col("_after"))
    return near.withColumn("_hit", hit).select(
        *predictions.columns,
        F.col("_hit.at").alias("actual_at"),
        F.col("_hit.point.value").alias("actual_available_bikes"),
    )


def point_in_time(
    requests: DataFrame,
    history: DataFrame,
    features: Sequence[str],
    ttl_seconds: int,
    *,
    by: Sequence[str] = ("station_id",),
    at: str = "event_timestamp",
    observed: str = "event_timestamp",
) -> DataFrame:
    """Give each request the newest feature row at or before its time and within the TTL.

    A later row is never used. Features are NULL where nothing qualifies.
    """
    points = _points(history, _seconds(history, observed), by, F.struct(*features))
    near = _matched_rows(requests, _micros(requests, at), points, by, ttl_seconds + 1, 0)
    age = F.col("_us") - F.col("_before.at") * _MICROS
    hit = F.when(age <= ttl_seconds * _MICROS, F.col("_before.point"))
    carried = [c for c in requests.columns if c not in features]
    return near.withColumn("_hit", hit).select(
        *carried, *[F.col(f"_hit.{name}").alias(name) for name in features]
    )
