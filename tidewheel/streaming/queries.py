"""Streaming queries: start one, and it runs until its input is used up or it is stopped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewheel.config import Settings
from tidewheel.sources.topic import topic_frame
from tidewheel.streaming.batches import (
    AuditStore,
    CleaningStore,
    Planner,
    clean_one,
    store_audits,
)


_ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def _run(
    stream: DataFrame,
    step: Callable[[DataFrame], object],
    name: str,
    checkpoint: str,
    interval: str | None,
) -> StreamingQuery:
    writer = (
        stream.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, _: step(batch))
    )
    if interval:
        return writer.trigger(processingTime=interval).start()
    return writer.trigger(availableNow=True).start()


def without_repeats(stream: DataFrame, within: str) -> DataFrame:
    """Topic records without later copies of an event, as far as copies are polled no more than ``within`` apart.

    Keeps the ids of that time as streaming state, which outlives a restart. Records without an id or a time
    of polling pass as they are, to be judged later. A record polled before the watermark is dropped as late, so
    this is an option for feeds that repeat themselves, beside the duplicates that every batch finds.
    """
    body = F.try_parse_json("value")
    read = stream.withColumns(
        {
            "_event": F.try_variant_get(body, "$.event_id", "string"),
            "_at": F.timestamp_seconds(F.try_variant_get(body, "$.ingested_at", "bigint")),
        }
    )
    whole = F.col("_event").isNotNull() & F.col("_at").isNotNull()
    once = read.where(whole).withWatermark("_at", within).dropDuplicatesWithinWatermark(["_event"])
    return once.unionByName(read.where(~whole)).drop("_event", "_at")


def start_cleaning(
    stream: DataFrame,
    store: CleaningStore,
    settings: Settings,
    checkpoint: str,
    *,
    planner: Planner | None = None,
    interval: str | None = None,
    name: str | None = None,
    repeats_within: str | None = None,
) -> StreamingQuery:
    """Clean a topic stream into the observations table. Without ``interval`` the query ends
    when nothing is left to read. Lateness is judged by each record's own times; there is no
    watermark unless ``repeats_within`` asks for `without_repeats`."""
    name = name or settings.group_id
    if repeats_within:
        stream = without_repeats(stream, repeats_within)
    return _run(
        stream,
        lambda batch: clean_one(batch, store, settings, planner, name),
        name,
        checkpoint,
        interval,
    )


def start_audits(
    stream: DataFrame,
    store: AuditStore,
    settings: Settings,
    checkpoint: str,
    *,
    interval: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Store an audit topic stream."""
    name = name or settings.audit_group_id
    return _run(
        stream,
        lambda batch: store_audits(batch, store, name),
        name,
        checkpoint,
        interval,
    )


def start_scoring(
    requests: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    send: Callable[[DataFrame], None],
    checkpoint: str,
    *,
    interval: str | None = None,
    name: str = "scoring",
) -> StreamingQuery:
    """Score a stream of requests and ``send`` an audit message for each that was found.

    ``score`` runs once per micro-batch and looks up the champion and the published features anew, so a
    model or a version of the features that is published while the query runs serves the next batch;
    `tidewheel.plans.jobs.score` does this. A repeated batch sends its messages again, under the same event
    ids.
    """
    return _run(requests, lambda batch: send(audit_messages(score(batch))), name, checkpoint, interval)


def audit_messages(scored: DataFrame) -> DataFrame:
    """Topic messages for the scored rows that were found."""
    fields = [c for c in scored.columns if c != "found"]
    utc = {
        c: F.date_format(F.to_utc_timestamp(c, F.current_timezone()), _ISO_UTC)
        for c in ("served_at", "feature_observed_at", "target_at")
    }
    body = F.struct(*[utc.get(c, F.col(c)).alias(c) for c in fields])
    found = scored.where("found")
    return topic_frame(found.withColumn("record", F.to_variant_object(body)))
