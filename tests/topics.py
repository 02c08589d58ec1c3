"""Recorded topics for the tests: files with the columns of a Kafka record."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewheel.schemas import TOPIC_RECORD
from tidewheel.sources import files


def record_messages(messages: DataFrame, path: str) -> None:
    """Append messages to a recorded topic, at offsets after those it has."""
    spark = messages.sparkSession
    first = 0
    if files.exists(spark, path):
        last = spark.read.schema(TOPIC_RECORD).json(path).agg(F.max("offset").alias("last"))
        first = (last.first()["last"] or 0) + 1
    # Row number within the task; with the task number it is unique.
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = messages.select(
        F.col("key").cast("string").alias("key"),
        "value",
        F.spark_partition_id().alias("partition"),
        (position + first).alias("offset"),
    )
    placed.write.mode("append").json(path)
