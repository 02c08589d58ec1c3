"""The five jobs: ingest, clean, train, score, monitor.

Cleaning and audit storage are streaming queries, see `tidewheel.streaming.queries`.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from tidewheel.config import Settings
from tidewheel.operators import asof, boosting, checks, drift, features, modeling, monitoring, snapshots
from tidewheel.operators.boosting import BoostedTrees
from tidewheel.schemas import FEATURE_COLUMNS, OBSERVATION_TABLE, TARGET_COLUMN
from tidewheel.session import checkpointed, require_adaptive
from tidewheel.sources import snapshots as landing, tables, topic
from tidewheel.sources.reference import ReferenceStore
from tidewheel.sources.registry import Registry, RunLog
from tidewheel.sources.tables import OBSERVATION_KEY, BatchLog, Published
from tidewheel.streaming.batches import audit_table


class MonitoringFailed(RuntimeError):
    """The monitored model broke a failure rule."""


def ingest(
    snapshot_rows: DataFrame, raw_path: str, send: Callable[[DataFrame], None]
) -> None:
    """Check the feed version, land the raw snapshots, and send one message per station."""
    checked = snapshots.guard_version(snapshot_rows)
    landing.land_snapshots(checked, raw_path)
    send(topic.topic_frame(snapshots.flatten_snapshot(checked)))


class NotServable(RuntimeError):
    """The published features cannot be looked up."""


def build_features(
    spark: SparkSession,
    settings: Settings,
    inputs: dict[str, str],
    history_path: str,
    latest_path: str,
    *,
    dedup: bool = False,
) -> DataFrame:
    """Write the next version of the feature history, test it, then publish it and the latest row per
    station. A history that fails its tests is not published, and readers of the old versions go on.

    Returns the test results. ``dedup`` first keeps the newest poll of each reported time, which
    collected observations may need: an unchanged station is reported again by every poll.
    """
    raw = tables.training_input(spark, settings, inputs)
    staged = features.stage_observations(
        features.dedup_history(raw) if dedup else raw, settings.training_source
    )
    histories, latest = Published(spark, history_path), Published(spark, latest_path)
    version = tables.write_history(features.feature_history(staged), histories)
    history = tables.read_history(spark, histories, version=version)
    results = checks.run_checks(staged, history).persist()
    try:
        checks.require_passed(results)
        rows = [r.asDict() for r in results.collect()]  # one short row per check
    finally:
        results.unpersist()
    number = latest.write(features.latest_features(history).drop(tables.DAY))
    require_lookup(history, latest.read(number))
    histories.publish(version)
    latest.publish(number)
    return spark.createDataFrame(rows, results.schema)


def require_lookup(history: DataFrame, latest: DataFrame) -> None:
    """Every station of the history must be found among the latest features, at its last time and with
    its value. One combining pass per side and one join of a row per station."""
    last = history.groupBy("station_id").agg(F.max("feature_observed_at").alias("last"))
    found = latest.select("station_id", "feature_observed_at", F.col("available_bikes").alias("value"))
    lost = last.join(found, "station_id", "left").where(
        "value IS NULL OR feature_observed_at IS NULL OR feature_observed_at <> last"
    )
    row = lost.select("station_id").first()
    if row is not None or last.isEmpty():
        raise NotServable(f"no latest features of station {row[0] if row else 'any'!r} after the build")


def train(
    spark: SparkSession,
    settings: Settings,
    history_path: str,
    registry: Registry,
    run_id: str,
    model_path: str,
    *,
    iterations: int = modeling.MAX_ITERATIONS,
    runs: RunLog | None = None,
    references: ReferenceStore | None = None,
) -> Row:
    """Train on the oldest labelled rows, score on the newer ones, register, maybe promote.

    ``references`` gets the scored history's state, so that monitoring needs no history; ``runs`` gets the
    record of the run, written last.
    """
    require_adaptive(spark)
    place = Published(spark, history_path)
    history_version = place.version()
    history = tables.read_history(spark, place, version=history_version)
    labelled = history.dropna(subset=[TARGET_COLUMN]).select(
        "station_id", "event_timestamp", TARGET_COLUMN
    )
    training = asof.point_in_time(
        labelled, history, FEATURE_COLUMNS, settings.feature_ttl_seconds
    )
    # stored, as the cutoffs are computed from the same rows
    split = modeling.chrono_split(checkpointed(modeling.require_complete(training)))
    split = split.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = modeling.fit_model(split.where("split = 'train'"), iterations)
        model.save(spark, model_path)
        example = split.where("split = 'train'").select(*FEATURE_COLUMNS).limit(5)
        example.write.mode("overwrite").json(f"{model_path}-example")
        scored = modeling.predict(model, split.where("split <> 'train'"))
        gate = modeling.promotion_gate(modeling.regression_scores(scored)).first()
        sizes = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    finally:
        split.unpersist()
    metrics = {k: float(v) for k, v in gate.asDict().items() if k != "promoted" and v is not None}
    version = registry.register(
        settings.model_name, run_id, model_path, metrics, bool(gate["promoted"])
    )
    if references is not None:
        references.refresh(history, history_version, lambda df: modeling.predict(model, df), version)
    if runs is not None:
        runs.write(
            run_id,
            model_name=settings.model_name,
            model_version=version,
            parameters={
                "algorithm": "boosted trees over quantile bins",
                "iterations": str(iterations),
                "leaves": str(boosting.LEAVES),
                "l2": str(boosting.L2),
                "rate": str(boosting.RATE),
                "target": TARGET_COLUMN,
                "features": ",".join(FEATURE_COLUMNS),
            },
            rows=sizes,
            metrics=metrics,
            source=settings.training_source,
            gate="validation_mae < baseline_validation_mae",
            promoted=bool(gate["promoted"]),
            places={
                "history": place.folder(history_version),
                "model": model_path,
                "example": f"{model_path}-example",
            },
        )
    return Row(run_id=run_id, model_version=version, promoted=bool(gate["promoted"]), **metrics)


def score(
    requests: DataFrame, latest_path: str, settings: Settings, registry: Registry
) -> DataFrame:
    """Score a batch of requests with the champion and the latest features published now. A stream calls it
    per micro-batch, see `tidewheel.streaming.queries.start_scoring`."""
    champion = registry.lookup(settings.model_name, settings.model_alias)
    model = BoostedTrees.load(requests.sparkSession, champion["path"])
    latest = Published(requests.sparkSession, latest_path).read()
    return modeling.score_requests(
        requests,
        latest,
        lambda df: modeling.predict(model, df),
        settings,
        champion["version"],
    )


def monitor(
    spark: SparkSession,
    settings: Settings,
    registry: Registry,
    references: ReferenceStore,
    audits_place: str,
    observations_place: str,
    out: str,
    now: datetime,
) -> Row:
    """Judge the champion over the last window, and store report, station errors and rows.

    The tables are read by the days of the window, and the reference from its stored state: the history is
    neither scored nor counted here.
    """
    require_adaptive(spark)
    champion = registry.lookup(settings.model_name, settings.model_alias)
    audits = audit_table(spark, audits_place, settings.table_format).read()
    observations = tables.keyed_table(
        spark, observations_place, OBSERVATION_KEY, schema=OBSERVATION_TABLE, fmt=settings.table_format
    ).read()
    start = now - timedelta(hours=settings.monitoring_window_hours)
    selected = monitoring.select_window(audits, start, now, champion["version"])
    # Targets lie in the window or, for late predictions, up to the age features may have before it.
    reach = settings.monitoring_label_tolerance_seconds
    earliest = start - timedelta(seconds=settings.feature_ttl_seconds + reach)
    around = monitoring.observed_between(observations, earliest, now + timedelta(seconds=reach))
    joined = asof.nearest_asof(selected, around, reach)
    flagged = checkpointed(monitoring.flag_rows(joined, settings.stale_seconds))
    state = references.state(champion["version"])
    run = now.strftime("%Y%m%dT%H%M%S")
    table = monitoring.metric_table(
        monitoring.window_metrics(flagged, champion["training_test_mae"]),
        drift.psi_from_state(state, flagged, monitoring.DRIFT_COLUMNS),
    )
    report = monitoring.decide(table, settings).select(
        F.lit(settings.model_name).alias("model_name"),
        F.lit(champion["version"]).alias("model_version"),
        F.lit(start).alias("window_start"),
        F.lit(now).alias("window_end"),
        "*",
    )
    BatchLog(spark, f"{out}/monitoring_labeled").write(flagged, run)
    BatchLog(spark, f"{out}/monitoring_station").write(monitoring.station_breakdown(flagged), run)
    reports = BatchLog(spark, f"{out}/monitoring_runs")
    reports.write(report, run)
    return spark.read.parquet(reports.folder(run)).first()


def require_healthy(report: Row) -> None:
    """Turn a failed report into a job failure. The champion is never moved here."""
    if report["status"] == "failed":
        raise MonitoringFailed("; ".join(report["failures"]))
