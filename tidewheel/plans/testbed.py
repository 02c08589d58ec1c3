"""Station-shaped frames derived from the benchmark ``events`` table.

``events.ts`` is a TIMESTAMP_NTZ in UTC. All times are turned into epoch seconds without
touching the session time zone. The frames cover every row of the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewheel.functions import clock
from tidewheel.functions.numeric import bounded_count
from tidewheel.operators.cleaning import arrival_of
from tidewheel.operators.features import feature_history, stage_observations
from tidewheel.session import widened

CAPACITY = 30
ROWS_PER_SNAPSHOT = 500
SYSTEM_ID = "testbed"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table with ``ep``, the event time in epoch seconds."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ep", clock.epoch_of_ntz("ts"))


def envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One station report per event; every twentieth event is delivered a second time."""
    rows = widened(events(spark, sf_dir).drop("value", "props"), "event_id").withColumn(
        "replay",
        F.explode(
            F.when(F.col("event_id") % 20 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
                F.array(F.lit(0))
            )
        ),
    )
    n, user = F.col("event_id"), F.col("user_id")
    bikes = n % (11 + user % 31)
    delay = (
        F.when(F.col("event_type") == "view", n % 900)
        .when(F.col("event_type") == "error", 900 + n % 1200)
        .when(F.col("event_type") == "signup", -(n % 120))
        .otherwise(n % 60)
    )
    number = (user % 50).cast("string")
    return rows.select(
        n.alias("n"),
        F.col("replay").cast("bigint").alias("replay"),
        arrival_of(F.col("replay"), n).alias("arrival"),
        F.concat(F.lit("evt-"), n.cast("string")).alias("event_id"),
        F.when(n % 211 == 0, "").otherwise(F.concat(F.lit("st-"), number)).alias("station_id"),
        F.col("ep").alias("source_updated_at"),
        (F.col("ep") + 5).alias("ingested_at"),
        (F.col("ep") - delay).alias("last_reported"),
        F.when(n % 7 == 0, None)
        .when(n % 97 == 0, F.lit(-1).cast("bigint"))
        .otherwise(bikes)
        .alias("num_bikes_available"),
        F.when(n % 7 == 0, bikes).alias("bikes_available"),
        (10 + user % 31 - bikes).alias("num_docks_available"),
        F.when(n % 13 == 0, 0).otherwise(1).alias("is_installed"),
        F.lit(1).alias("is_renting"),
        F.lit(1).alias("is_returning"),
        F.when(n % 53 != 0, 10 + user % 31).alias("capacity"),
        F.concat(F.lit("Station "), number).alias("name"),
        (F.lit(40.0) + user % 50).alias("lat"),
        (F.lit(-74.0) + user % 50).alias("lon"),
    )


_STATUS = (
    "last_reported",
    "num_bikes_available",
    "bikes_available",
    "num_docks_available",
    "is_installed",
    "is_renting",
    "is_returning",
)
_METADATA = ("capacity", "name", "lat", "lon")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The envelope as decoded topic records: ``record``, ``arrival`` and the row's origin."""
    body = F.struct(
        F.lit(1).alias("schema_version"),
        "event_id",
        F.lit(SYSTEM_ID).alias("system_id"),
        "station_id",
        "source_updated_at",
        "ingested_at",
        F.struct(*_STATUS).alias("status"),
        F.struct(*_METADATA).alias("metadata"),
    )
    return envelope(spark, sf_dir).select(
        "n", "replay", "arrival", F.to_variant_object(body).alias("record")
    )


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot documents of consecutive events, at most `ROWS_PER_SNAPSHOT` events (and their
    repeats) in each. A station has details where any of its reports has a capacity."""
    rows = envelope(spark, sf_dir).withColumn(
        "poll", (clock.floor_to(F.col("n"), ROWS_PER_SNAPSHOT) / ROWS_PER_SNAPSHOT).cast("bigint")
    )
    status = F.struct("arrival", "station_id", *_STATUS)
    details = F.when(F.col("capacity").isNotNull(), F.struct("arrival", "station_id", *_METADATA))
    gathered = rows.groupBy("poll").agg(
        F.max("source_updated_at").alias("last_updated"),
        F.sort_array(F.collect_list(status)).alias("status"),
        F.sort_array(F.collect_list(details)).alias("details"),
    )

    def feed(stations, *extra):
        return F.struct(F.lit("2.3").alias("version"), *extra, F.struct(stations).alias("data"))

    document = F.struct(
        F.lit(SYSTEM_ID).alias("system_id"),
        (F.col("last_updated") + 10).alias("ingested_at"),
        feed(F.col("details").alias("stations")).alias("station_information"),
        feed(F.col("status").alias("stations"), "last_updated").alias("station_status"),
    )
    return gathered.select("poll", F.to_variant_object(document).alias("snapshot"))


def history_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw station history: five stations, one row per occupied quarter hour."""
    station = F.concat(F.lit("st-"), (F.col("user_id") % 5).cast("string"))
    return (
        events(spark, sf_dir)
        .groupBy(
            station.alias("station_id"),
            clock.floor_to(F.col("ep"), clock.QUARTER_HOUR).alias("last_reported"),
        )
        .agg(F.max("value").alias("peak"))
        .select(
            "station_id",
            "last_reported",
            (F.floor("peak") % 31).alias("num_bikes_available"),
            F.lit(CAPACITY).cast("bigint").alias("capacity"),
            (CAPACITY - F.floor("peak") % 31).alias("num_docks_available"),
        )
    )


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_observations(history_rows(spark, sf_dir), "collected")


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_history(staged(spark, sf_dir))


def formula_prediction(df: DataFrame) -> DataFrame:
    """A fixed arithmetic model, for queries that compare against SQL."""
    raw = F.col("available_bikes") * 0.9 + F.col("hour_utc") * 0.25 + 0.5
    return df.withColumn("raw_prediction", raw)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History rows with features but without labels: no window is needed for these."""
    slot = F.col("last_reported")
    bikes = F.col("num_bikes_available")
    return history_rows(spark, sf_dir).select(
        "station_id",
        F.timestamp_seconds(slot).alias("event_timestamp"),
        slot.alias("feature_observed_at"),
        clock.hour_utc(slot).alias("hour_utc"),
        clock.weekday_utc(slot).alias("day_of_week"),
        bikes.alias("available_bikes"),
        F.col("num_docks_available").alias("available_docks"),
        "capacity",
        (bikes / F.col("capacity")).alias("availability_ratio"),
    )


def audits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One prediction per history row, served 1 to 21 minutes after it was observed. One slot in
    ten belongs to an older model version, one in 97 lost its capacity."""
    slot = F.col("feature_observed_at")
    tick = (slot / clock.QUARTER_HOUR).cast("bigint")
    scored = formula_prediction(features(spark, sf_dir))
    capacity = F.col("capacity")
    event = F.concat_ws("-", "station_id", slot)
    return scored.select(
        F.lit(1).alias("schema_version"),
        event.alias("event_id"),
        event.alias("request_id"),
        "station_id",
        F.timestamp_seconds(slot + 60 + (tick % 3) * 600).alias("served_at"),
        F.timestamp_seconds(slot).alias("feature_observed_at"),
        F.timestamp_seconds(slot + clock.QUARTER_HOUR).alias("target_at"),
        F.lit(15).alias("horizon_minutes"),
        F.lit("availability-in-15-minutes").alias("model_name"),
        F.when(tick % 10 == 0, "2").otherwise("3").alias("model_version"),
        F.lit("champion").alias("model_alias"),
        "raw_prediction",
        bounded_count(F.col("raw_prediction"), capacity).alias("predicted_available_bikes_15m"),
        "hour_utc",
        "day_of_week",
        "available_bikes",
        "available_docks",
        F.when(tick % 97 != 0, capacity).alias("capacity"),
        "availability_ratio",
    )


def actuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as an observation of one of the five stations."""
    return events(spark, sf_dir).select(
        F.concat(F.lit("st-"), (F.col("user_id") % 5).cast("string")).alias("station_id"),
        F.col("ep").alias("last_reported"),
        (F.floor("value") % 31).alias("num_bikes_available"),
        "event_id",
    )
