"""Feature history with exact 15-minute labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidewheel.functions import clock
from tidewheel.operators.upsert import keep_last
from tidewheel.schemas import FEATURE_HISTORY, TARGET_COLUMN

HORIZON_SECONDS = clock.QUARTER_HOUR
_MICROS = 1_000_000
_SLICE = clock.DAY * _MICROS
#: Copies of one row that a task makes at most at a time.
_PART = 10_000
_STAGED = (
    "station_id",
    "event_timestamp",
    "available_bikes",
    "available_docks",
    "capacity",
    "source_name",
)


def dedup_history(observations: DataFrame) -> DataFrame:
    """Keep the newest poll of each (station, reported time)."""
    return keep_last(
        observations, ["station_id", "last_reported"], ["source_updated_at", "event_id"]
    )


def stage_observations(observations: DataFrame, source_name: str) -> DataFrame:
    """Canonical names and types for the feature step."""
    return observations.select(
        F.col("station_id").cast("string").alias("station_id"),
        F.timestamp_seconds(F.col("last_reported").cast("bigint")).alias("event_timestamp"),
        F.col("num_bikes_available").cast("bigint").alias("available_bikes"),
        F.col("num_docks_available").cast("bigint").alias("available_docks"),
        F.col("capacity").cast("bigint").alias("capacity"),
        F.lit(source_name).alias("source_name"),
    )


def feature_history(staged: DataFrame) -> DataFrame:
    """Features per observation, labelled with the next count if it is exactly 15 minutes later.

    Equal rows collapse to one with a count before any ordering, and each station is cut into
    day slices. A slice also gets the rows of the first 15 minutes after it, which is all a
    label can look at, so the next row is found inside the slice and a station with a large
    share of the data is sorted by many tasks. With whole-second times a slice holds at most
    one day of distinct instants. Collapsed rows come back at the end, in parts that go to many tasks; the last of a group of
    equal rows is the one the next observation follows.
    """
    at = F.unix_micros("event_timestamp")
    rows = staged.groupBy(*_STAGED).agg(F.count(F.lit(1)).alias("_copies"))
    own = clock.bucket_of(F.col("_at"), _SLICE)
    first = clock.bucket_of(F.col("_at") - HORIZON_SECONDS * _MICROS, _SLICE)
    sliced = rows.withColumn("_at", at).withColumn(
        "_slice", F.explode_outer(F.sequence(first, own))
    )
    order = ["_at", "available_bikes", "available_docks", "capacity", "source_name"]
    following = Window.partitionBy("station_id", "_slice").orderBy(*order)
    observed = F.unix_seconds("event_timestamp")
    exact = F.col("_next_at") == F.col("_at") + HORIZON_SECONDS * _MICROS
    labelled = (
        sliced.withColumn("_next_at", F.lead("_at").over(following))
        .withColumn("_next_bikes", F.lead("available_bikes").over(following))
        .where(F.col("_slice").eqNullSafe(own))
    )
    # copies are made from numbered parts of bounded size, which are dealt out first
    parts = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_copies") - 1) / _PART))
    dealt = labelled.withColumn("_part", F.explode(parts)).repartition("station_id", "event_timestamp", "_part")
    first_copy = F.col("_part") * _PART
    copies = F.sequence(first_copy + 1, F.least(first_copy + _PART, F.col("_copies")))
    labelled = dealt.withColumn("_copy", F.explode(copies))
    return labelled.select(
        "station_id",
        "event_timestamp",
        observed.alias("feature_observed_at"),
        clock.hour_utc(observed).alias("hour_utc"),
        clock.weekday_utc(observed).alias("day_of_week"),
        "available_bikes",
        "available_docks",
        "capacity",
        F.try_divide(F.col("available_bikes").cast("double"), F.col("capacity")).alias(
            "availability_ratio"
        ),
        F.when(exact & (F.col("_copy") == F.col("_copies")), F.col("_next_bikes"))
        .cast("double")
        .alias(TARGET_COLUMN),
        "source_name",
    ).select(*FEATURE_HISTORY.fieldNames())


def sort_history(observations: DataFrame) -> DataFrame:
    """Order by reported time, then station. The other columns only split ties, so that one
    crowded instant can still be range-partitioned."""
    lead = ["last_reported", "station_id"]
    return observations.orderBy(*lead, *[c for c in observations.columns if c not in lead])


def latest_features(history: DataFrame) -> DataFrame:
    """The newest feature row of each station: the lookup table for scoring."""
    rest = [c for c in history.columns if c not in ("station_id", "event_timestamp")]
    newest = F.max(F.struct("event_timestamp", *rest)).alias("_row")
    return (
        history.where("event_timestamp IS NOT NULL")
        .groupBy("station_id")
        .agg(newest)
        .select("station_id", "_row.*")
        .select(*history.columns)
    )


def history_extent(history: DataFrame, margin_seconds: int = 60) -> DataFrame:
    """First and last event time, widened by a margin on both ends."""
    margin = F.make_dt_interval(secs=F.lit(margin_seconds))
    return history.agg(
        (F.min("event_timestamp") - margin).alias("start_at"),
        (F.max("event_timestamp") + margin).alias("end_at"),
    )
