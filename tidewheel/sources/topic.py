"""Keyed topics: Kafka where its connector is present, recorded files otherwise.

A recorded topic is a folder of JSON lines with the columns of a Kafka record, so both kinds
have the same frame: key, value, partition, offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewheel.config import Settings
from tidewheel.functions.pinning import pinned
from tidewheel.operators.cleaning import arrival_of
from tidewheel.schemas import TOPIC_RECORD


def topic_frame(events: DataFrame, *, key: str = "station_id", record: str = "record") -> DataFrame:
    """Message key and JSON value of each event."""
    return events.select(
        F.col(key).alias("key"), F.to_json(F.col(record)).alias("value")
    )


def publish(messages: DataFrame, servers: str, topic: str) -> None:
    """Send messages to Kafka; the job fails if any of them is not acknowledged by all replicas."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("kafka.acks", "all")
        .option("kafka.enable.idempotence", "true")
        .save()
    )


def kafka_options(settings: Settings, topic: str, *, endless: bool = False) -> dict[str, str]:
    """From the earliest record. With ``source_partitions`` a batch is read in at least so many tasks, however few
    partitions the topic has. An ``endless`` stream closes a batch at ``batch_size`` records or after
    the timeout; one that ends with its input must not wait for records to fill a batch, or it would
    leave the last ones unread."""
    options = {
        "kafka.bootstrap.servers": settings.kafka_bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": str(settings.batch_size),
    }
    if settings.source_partitions:
        options["minPartitions"] = str(settings.source_partitions)
    if endless:
        options["minOffsetsPerTrigger"] = str(settings.batch_size)
        options["maxTriggerDelay"] = f"{settings.batch_timeout_seconds:g}s"
    return options


def stream_kafka(
    spark: SparkSession, settings: Settings, topic: str, *, endless: bool = False
) -> DataFrame:
    """A Kafka topic as a stream; ``endless`` for queries with an interval. Needs the Kafka connector
    on the class path."""
    options = kafka_options(settings, topic, endless=endless)
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "partition",
        "offset",
    )


def stream_recorded(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    """A recorded topic as a stream of files."""
    reader = spark.readStream.schema(TOPIC_RECORD)
    return reader.option("maxFilesPerTrigger", files_per_batch).json(path)


def decode(messages: DataFrame, *, value: str = "value") -> DataFrame:
    """Add ``record`` (VARIANT) and ``arrival`` to messages.

    Text that is not a JSON object stays in the batch, as an object with the raw text and the
    decode error, so that it is profiled and quarantined like any other bad record.
    """
    parsed = pinned(messages, messages.columns, {"_parsed": F.try_parse_json(F.col(value))})
    is_json = F.col("_parsed").isNotNull()
    error = F.when(is_json, F.lit("Event must be a JSON object")).otherwise(
        F.lit("Value is not valid JSON")
    )
    captured = F.to_variant_object(
        F.struct(F.col(value).alias("raw"), error.alias("decode_error"))
    )
    opens = F.col(value).rlike(r"^\s*\{")  # valid JSON that opens a brace is an object
    record = F.when(is_json & opens, F.col("_parsed")).otherwise(captured)
    arrival = arrival_of(F.col("partition"), F.col("offset"))
    return pinned(parsed, messages.columns, {"record": record, "arrival": arrival})
