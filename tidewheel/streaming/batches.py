"""Processing of one micro-batch: cleaning, and storing prediction audits.

Spark's checkpoint fixes which records belong to a batch, so a repeated batch sees the same
rows, and its id is a digest of their positions. Each step below writes under that id and the
report comes last: repeating an unfinished batch replaces its own outputs, repeating a finished
one does nothing.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F

from tidewheel.config import Settings
from tidewheel.operators import cleaning, profiling
from tidewheel.operators.profiling import Policy
from tidewheel.operators.upsert import keep_last
from tidewheel.operators.validation import validate_audits
from tidewheel.schemas import AUDIT, OBSERVATION_TABLE
from tidewheel.sources.tables import OBSERVATION_KEY, BatchLog, KeyedTable, day_of, keyed_table
from tidewheel.sources.topic import decode

Planner = Callable[[Row, list[str]], Policy]


def offsets_of(batch: DataFrame) -> list[dict]:
    """First and last offset (inclusive) of each topic partition in the batch."""
    ranges = batch.groupBy("partition").agg(
        F.min("offset").alias("start"), F.max("offset").alias("end")
    )
    return [r.asDict() for r in ranges.orderBy("partition").collect()]


def batch_id_of(reader: str, offsets: list[dict]) -> str:
    """The same id whenever a reader gets the same records of its topic."""
    return hashlib.sha256(json.dumps([reader, offsets]).encode()).hexdigest()[:24]


def _json(value: Row | list[dict]) -> str:
    return json.dumps(value.asDict(recursive=True) if isinstance(value, Row) else value)


@dataclass
class CleaningStore:
    """Where a cleaning job writes. With a ``fmt`` of the catalogue the table needs a name there."""

    spark: SparkSession
    root: str
    fmt: str = "parquet"
    observations_table: str | None = None

    def __post_init__(self) -> None:
        self.observations = keyed_table(
            self.spark,
            self.observations_table or f"{self.root}/observations",
            OBSERVATION_KEY,
            schema=OBSERVATION_TABLE,
            fmt=self.fmt,
        )
        self.accepted = BatchLog(self.spark, f"{self.root}/batches")
        self.quarantine = BatchLog(self.spark, f"{self.root}/quarantine")
        self.reports = BatchLog(self.spark, f"{self.root}/runs")


def clean_one(
    batch: DataFrame,
    store: CleaningStore,
    settings: Settings,
    planner: Planner | None = None,
    reader: str = "clean",
) -> str | None:
    """Profile, choose a policy, clean and store one batch of topic records.

    Returns the batch id, or None for an empty batch.
    """
    decoded = decode(batch).persist(StorageLevel.MEMORY_AND_DISK)
    judged = None
    try:
        offsets = offsets_of(decoded)
        batch_id = batch_id_of(reader, offsets)
        if not offsets or store.reports.has(batch_id):
            return batch_id if offsets else None
        profile = profiling.profile_batch(decoded, settings.stale_seconds)
        row = profile.first()
        policy, attempts = profiling.settle_policy(row, planner, settings.repair_limit)
        judged = cleaning.evaluate(decoded, policy, settings.stale_seconds)
        judged = judged.persist(StorageLevel.MEMORY_AND_DISK)
        taken, refused = Observation(), Observation()
        accepted = cleaning.accepted_rows(judged, counted=taken)
        store.accepted.write(accepted, batch_id)
        store.quarantine.write(cleaning.quarantined_rows(judged, counted=refused), batch_id, "json")
        quality = cleaning.observed_report(row["rows"], taken.get, refused.get)
        stored = batch.sparkSession.read.schema(accepted.schema).parquet(
            store.accepted.folder(batch_id)
        )
        version = store.observations.merge(cleaning.enrich_rows(stored, batch_id), batch_id)
        report = batch.sparkSession.range(1).select(
            F.from_json(F.lit(json.dumps(quality)), cleaning.REPORT).alias("quality"),
            F.from_json(F.lit(_json(row)), profile.schema).alias("profile"),
            F.struct(
                F.lit(policy.allow_bikes_available_alias).alias("allow_bikes_available_alias"),
                F.lit(policy.freshness_grace_seconds).alias("freshness_grace_seconds"),
                F.lit(policy.rationale).alias("rationale"),
            ).alias("plan"),
            F.lit(attempts).alias("attempts"),
            F.lit("fixture" if planner is None else "planner").alias("mode"),
            F.lit(version).cast("bigint").alias("table_version"),
            F.struct(
                F.lit(store.fmt).alias("format"),
                F.lit(store.observations.path).alias("table"),
                F.lit(version).cast("bigint").alias("version"),
                F.lit(store.accepted.folder(batch_id)).alias("accepted"),
                F.lit(store.quarantine.folder(batch_id)).alias("quarantine"),
                F.lit(store.reports.folder(batch_id)).alias("report"),
            ).alias("storage"),
            F.from_json(
                F.lit(_json(offsets)), "array<struct<partition:int,start:bigint,end:bigint>>"
            ).alias("offsets"),
        )
        store.reports.write(report, batch_id, "json")
        return batch_id
    finally:
        if judged is not None:
            judged.unpersist()
        decoded.unpersist()


def audit_table(spark: SparkSession, place: str, fmt: str = "parquet") -> KeyedTable:
    """Prediction audits by the date they were served on."""
    return keyed_table(spark, place, ("event_id",), schema=AUDIT, dated=day_of("served_at"), fmt=fmt)


@dataclass
class AuditStore:
    """Where an audit job writes; see `CleaningStore`."""

    spark: SparkSession
    root: str
    fmt: str = "parquet"
    audits_table: str | None = None

    def __post_init__(self) -> None:
        self.audits = audit_table(
            self.spark, self.audits_table or f"{self.root}/prediction_audits", self.fmt
        )
        self.quarantine = BatchLog(self.spark, f"{self.root}/audit_quarantine")
        self.reports = BatchLog(self.spark, f"{self.root}/audit_runs")


def store_audits(batch: DataFrame, store: AuditStore, reader: str = "audits") -> str | None:
    """Validate one batch of audit messages and merge the valid ones by event id."""
    checked = validate_audits(decode(batch))
    checked = checked.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        offsets = offsets_of(checked)
        batch_id = batch_id_of(reader, offsets)
        if not offsets or store.reports.has(batch_id):
            return batch_id if offsets else None
        valid = keep_last(checked.where("error IS NULL"), ["event_id"], ["arrival"])
        version = store.audits.merge(valid.select(*AUDIT.fieldNames()), batch_id)
        invalid = checked.where("error IS NOT NULL")
        store.quarantine.write(
            invalid.select(F.to_json("record").alias("record"), "error"), batch_id, "json"
        )
        report = checked.agg(
            F.count_if(F.col("error").isNull()).alias("accepted"),
            F.count_if(F.col("error").isNotNull()).alias("quarantined"),
        ).select(
            "*",
            F.lit(store.audits.path).alias("table_uri"),
            F.lit(version).cast("bigint").alias("table_version"),
        )
        store.reports.write(report, batch_id, "json")
        return batch_id
    finally:
        checked.unpersist()
