"""Recorded station snapshots: reading and landing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewheel.functions import clock, json_values as jv
from tidewheel.operators.cleaning import keep_first
from tidewheel.session import checkpointed
from tidewheel.sources import files

_BOM = "\ufeff"


def _parsed(texts: DataFrame) -> DataFrame:
    body = F.ltrim(F.col("value"), F.lit(_BOM))
    return texts.select(F.try_parse_json(body).alias("snapshot"))


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """One row per snapshot file, as VARIANT. A leading byte-order mark is ignored."""
    return _parsed(spark.read.text(path, wholetext=True))


def stream_snapshots(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """Snapshot files of a folder as they appear."""
    reader = spark.readStream.option("wholetext", True)
    return _parsed(reader.option("maxFilesPerTrigger", files_per_batch).text(path))


def landing_rows(snapshots: DataFrame) -> DataFrame:
    """Partition columns, object name and text of each snapshot.

    The name ends in a digest of the content, so the same snapshot always gets the same name.
    """
    doc = F.col("snapshot")
    polled = jv.strict_long(doc, "$.ingested_at")
    name = F.concat_ws("-", polled, F.substring(jv.digest_of(doc), 1, 16))
    return snapshots.select(
        jv.as_text(doc, "$.system_id").alias("system_id"),
        clock.iso_date(polled).alias("event_date"),
        F.concat(name, F.lit(".json")).alias("object_name"),
        F.to_json(doc).alias("body"),
    )


LANDED = "object_name string, body string, system_id string, event_date string"


def land_snapshots(snapshots: DataFrame, path: str) -> None:
    """Append the snapshots that are not there yet, in one folder per system and UTC date.

    A batch writes a few files of many snapshots. Names come from the content, so landing a snapshot again, in
    this batch or a later one, adds nothing; only the names of the dates it may lie in are looked up.
    """
    spark = snapshots.sparkSession
    rows = checkpointed(keep_first(landing_rows(snapshots), ["system_id", "event_date", "object_name"], ["body"]))
    if files.exists(spark, path):
        days = [r[0] for r in rows.select("event_date").distinct().collect()]  # the dates of one batch
        known = read_landed(spark, path).where(F.col("event_date").isin(days))
        rows = rows.join(known.select("system_id", "event_date", "object_name"), ["system_id", "event_date", "object_name"], "left_anti")
    rows.repartitionByRange("system_id", "event_date", "object_name").write.mode("append").partitionBy(
        "system_id", "event_date"
    ).json(path)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """Landed snapshots: object_name, body, system_id and event_date."""
    return spark.read.schema(LANDED).json(path)
