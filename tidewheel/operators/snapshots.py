"""Station snapshots to events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewheel.functions import json_values as jv

SUPPORTED_VERSION = "2.3"  # fixed value: the only feed version read


def feed_version_ok(snapshot: Column) -> Column:
    """Both feeds of the snapshot declare the supported version."""
    ok = F.lit(True)
    for feed in ("station_information", "station_status"):
        raw = jv.member(snapshot, f"$.{feed}.version")
        version = jv.plain_text(jv.json_type(raw), raw)
        ok = ok & F.coalesce(version == SUPPORTED_VERSION, F.lit(False))
    return ok


def guard_version(df: DataFrame, *, snapshot: str = "snapshot", strict: bool = True) -> DataFrame:
    """Fail on an unsupported feed version, or with ``strict=False`` mark it in ``supported``."""
    ok = feed_version_ok(F.col(snapshot))
    if not strict:
        return df.withColumn("supported", ok)
    error = F.raise_error(F.lit(f"Only feed version {SUPPORTED_VERSION} is supported"))
    return df.where(F.when(ok, F.lit(True)).otherwise(error.cast("boolean")))


def _key(station: Column) -> Column:
    """Station id as text; empty when the key is missing."""
    raw = jv.member(station, "$.station_id")
    return F.when(raw.isNull(), F.lit("")).otherwise(F.coalesce(jv.as_text(station, "$.station_id"), F.lit("None")))


def _stations(snapshot: Column, feed: str) -> Column:
    listed = F.try_variant_get(snapshot, f"$.{feed}.data.stations", "array<variant>")
    return F.coalesce(listed, F.array().cast("array<variant>"))


def flatten_snapshot(df: DataFrame, *, snapshot: str = "snapshot") -> DataFrame:
    """One event per reported station of each snapshot: ``event_id``, envelope fields and ``record``.

    Both lists of a snapshot are exploded as one and grouped by snapshot and station, so the work
    grows with the stations and a document with very many is spread over tasks. Of several details
    for a station the last counts; a station without details gets an empty object; a station that
    is reported several times gives several events.
    """
    doc = F.col(snapshot)

    def entries(feed: str, status: bool) -> Column:
        return F.transform(
            _stations(doc, feed),
            lambda s, i: F.struct(
                F.lit(status).alias("status"), _key(s).alias("key"), i.alias("position"), s.alias("value")
            ),
        )

    both = F.concat(entries("station_information", False), entries("station_status", True))
    heads = df.select(
        F.monotonically_increasing_id().alias("_row"),
        jv.as_text(doc, "$.system_id").alias("system_id"),
        jv.strict_long(doc, "$.station_status.last_updated").alias("source_updated_at"),
        jv.strict_long(doc, "$.ingested_at").alias("ingested_at"),
        both.alias("_entries"),
    )
    listed = heads.select("_row", "system_id", "source_updated_at", "ingested_at", F.inline("_entries"))
    head = ["system_id", "source_updated_at", "ingested_at"]
    details = F.max_by(F.when(~F.col("status"), F.col("value")), F.when(~F.col("status"), F.col("position")))
    reports = F.collect_list(F.when(F.col("status"), F.col("value")))  # the reports of one station in one document
    grouped = listed.groupBy("_row", "key").agg(
        *[F.first(c).alias(c) for c in head], details.alias("details"), reports.alias("reports")
    )
    stations = grouped.select(
        F.lit(1).alias("schema_version"),
        "system_id",
        F.col("key").alias("station_id"),
        "source_updated_at",
        "ingested_at",
        F.explode("reports").alias("status"),
        F.coalesce("details", F.parse_json(F.lit("{}"))).alias("metadata"),
    )
    identity = ["schema_version", "system_id", "station_id", "source_updated_at", "status", "metadata"]
    digest = jv.digest_of(F.to_variant_object(F.struct(*identity)))
    events = stations.withColumn("event_id", digest)
    envelope = [*identity[:4], "ingested_at", "status", "metadata", "event_id"]
    return events.select(
        "event_id",
        *identity[:4],
        "ingested_at",
        "status",
        "metadata",
        F.to_variant_object(F.struct(*envelope)).alias("record"),
    )
