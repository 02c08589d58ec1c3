"""The five jobs in a row, on the smallest benchmark tables."""

from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.sql import Row, functions as F

from stations import snapshot, station
from tidewheel.config import Settings
from tidewheel.functions import clock
from tidewheel.operators.boosting import BoostedTrees
from tidewheel.plans import jobs, testbed as tb
from tidewheel.schemas import AUDIT
from tidewheel.sources import tables
from tidewheel.sources.reference import ReferenceStore
from tidewheel.sources.registry import Registry, RunLog
from tidewheel.sources.topic import stream_recorded
from tidewheel.streaming.batches import CleaningStore, audit_table
from tidewheel.streaming.queries import start_cleaning
from topics import record_messages

SETTINGS = Settings(monitoring_window_hours=24 * 40, monitoring_label_tolerance_seconds=600)


def test_ingest_and_clean(spark, tmp_path):
    from test_cleaning import json
    docs = [snapshot(station("a"), station("b", on=0)), snapshot(station("a", age=5, bikes=3))]
    parsed = spark.createDataFrame([(json.dumps(d),) for d in docs], "t string").select(
        F.try_parse_json("t").alias("snapshot")
    )
    topic = str(tmp_path / "topic")
    jobs.ingest(parsed, str(tmp_path / "raw"), lambda m: record_messages(m, topic))
    assert spark.read.json(topic).count() == 3
    store = CleaningStore(spark, str(tmp_path / "out"))
    query = start_cleaning(stream_recorded(spark, topic, 100), store, SETTINGS, str(tmp_path / "cp"))
    query.awaitTermination()
    assert store.observations.read().count() == 2


def test_features_training_scoring_monitoring(spark, sf_dir, tmp_path):
    inputs = {"synthetic": str(tmp_path / "raw")}
    tb.history_rows(spark, sf_dir).write.parquet(inputs["synthetic"])
    history, latest = str(tmp_path / "history"), str(tmp_path / "latest")
    results = jobs.build_features(spark, SETTINGS, inputs, history, latest)
    assert {r.status for r in results.collect()} == {"pass"} and results.count() == 16

    registry = Registry(spark, str(tmp_path / "registry"))
    runs, references = RunLog(spark, str(tmp_path / "runs")), ReferenceStore(spark, str(tmp_path / "reference"))
    trained = jobs.train(
        spark, SETTINGS, history, registry, "run-1", str(tmp_path / "model"), iterations=3, runs=runs, references=references
    )
    record = runs.read().first()
    assert (record.run_id, record.model_version, record.promoted) == ("run-1", "1", trained.promoted)
    assert record.parameters["iterations"] == "3" and record.source == "synthetic"
    assert record["rows"]["train"] > record["rows"]["validation"] > 0 and record.metrics["test_mae"] == trained.test_mae
    assert spark.read.parquet(record.places["history"]).count() > 0 and runs.has("run-1") and not runs.has("run-2")
    assert trained.model_version == "1"
    assert trained.promoted == (trained.validation_mae < trained.baseline_validation_mae)
    assert registry.lookup(SETTINGS.model_name, "candidate").path == str(tmp_path / "model")
    registry.register(SETTINGS.model_name, "run-1b", str(tmp_path / "model"), {"test_mae": 9.0}, True)
    model = BoostedTrees.load(spark, str(tmp_path / "model"))
    rows = tables.read_history(spark, history)
    assert references.refresh(rows, 1, lambda df: model.transform(df), "2") > 1

    requests = tb.events(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("request_id"),
        F.concat(F.lit("st-"), (F.col("user_id") % 7).cast("string")).alias("station_id"),
        F.timestamp_seconds("ep").alias("served_at"),
    )
    scored = jobs.score(requests, latest, SETTINGS, registry)
    assert scored.count() == requests.count()
    found = scored.where("found").selectExpr(
        "bool_and(predicted_available_bikes_15m BETWEEN 0 AND capacity) AS ok", "count(*) AS n"
    )
    assert found.first().ok and found.first().n > 0

    audits = audit_table(spark, str(tmp_path / "audits"))
    champion = registry.lookup(SETTINGS.model_name).version
    served = tb.audits(spark, sf_dir).withColumn("model_version", F.lit(champion))
    audits.merge(served.select(*AUDIT.fieldNames()), "b1")
    observed = tables.keyed_table(
        spark, str(tmp_path / "observations"), ("event_id",), dated=clock.iso_date(F.col("last_reported"))
    )
    observed.merge(
        tb.actuals(spark, sf_dir).withColumn("event_id", F.col("event_id").cast("string")), "b1"
    )
    out = str(tmp_path / "monitoring")
    report = jobs.monitor(
        spark, SETTINGS, registry, references, audits.path, observed.path, out,
        datetime(2024, 2, 5, tzinfo=timezone.utc),
    )
    assert report.metrics["sample_count"] == served.count()
    assert report.metrics["training_test_mae"] == 9.0
    assert report.status == "failed"  # some audits lost their capacity
    with pytest.raises(jobs.MonitoringFailed, match="constraints"):
        jobs.require_healthy(report)
    jobs.require_healthy(Row(status="warning", failures=[]))
    assert spark.read.parquet(f"{out}/monitoring_labeled").count() == served.count()
    assert spark.read.parquet(f"{out}/monitoring_station").count() == 5
    assert spark.read.parquet(f"{out}/monitoring_runs").count() == 1


def test_failed_checks_stop_the_build(spark, tmp_path):
    raw = str(tmp_path / "raw")
    spark.sql(
        "SELECT 's' station_id, 1767225600L last_reported, 9 num_bikes_available,"
        " 0 num_docks_available, 5 capacity"
    ).write.parquet(raw)
    with pytest.raises(Exception, match="feature_bounds"):
        jobs.build_features(
            spark, Settings(), {"synthetic": raw}, str(tmp_path / "h"), str(tmp_path / "l")
        )
