from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import Row, functions as F

from tidewheel.config import Settings
from tidewheel.operators import asof, drift, monitoring
from tidewheel.plans import testbed as tb
from tidewheel.schemas import AUDIT

START = datetime(2026, 3, 2, tzinfo=timezone.utc)
EPOCH = int(START.timestamp())


def audit(n, station, minute, bikes, predicted, *, capacity=10, version="3", served_after=1):
    observed = START + timedelta(minutes=minute)
    ratio = bikes / capacity if capacity else None
    return (
        1, f"r{n}", f"r{n}", station, observed + timedelta(minutes=served_after), observed,
        observed + timedelta(minutes=15), 15, "m", version, "champion", float(predicted), predicted,
        0, 3, bikes, (capacity or 10) - bikes, capacity, ratio,
    )


def judge(spark, audits, actuals, settings, training=None, reference=None):
    rows = spark.createDataFrame(audits, AUDIT)
    seen = spark.createDataFrame(
        actuals,
        "event_id string, station_id string, last_reported bigint, num_bikes_available bigint",
    )
    selected = monitoring.select_window(rows, START, START + timedelta(hours=24), "3")
    joined = asof.nearest_asof(selected, seen, settings.monitoring_label_tolerance_seconds)
    flagged = monitoring.flag_rows(joined, settings.stale_seconds)
    counts = drift.value_counts(
        rows if reference is None else reference, flagged, monitoring.DRIFT_COLUMNS
    )
    table = monitoring.metric_table(
        monitoring.window_metrics(flagged, training), drift.psi(counts, monitoring.DRIFT_COLUMNS)
    )
    return monitoring.decide(table, settings).first(), joined


def three(spark):
    audits = [
        audit(1, "north", 30, 3, 11, capacity=20),
        audit(2, "south", 45, 16, 13, capacity=20),
        audit(3, "east", 60, 9, 9, capacity=20),
    ]
    seen = EPOCH + 900
    actuals = [("a", "north", seen + 1_800, 11), ("b", "south", seen + 2_690, 12), ("c", "east", seen + 3_615, 9)]
    return audits, actuals


EASY = Settings(monitoring_min_samples=3, monitoring_psi_warning=3, monitoring_psi_failure=4)


def test_passing_window(spark):
    report, joined = judge(spark, *three(spark), EASY, training=0.5)
    assert (report.status, report.warnings, report.failures) == ("passed", [], [])
    assert report.metrics["production_mae"] == pytest.approx(1 / 3)
    assert report.metrics["persistence_baseline_mae"] == pytest.approx(4.0)
    assert report.metrics["label_coverage"] == 1.0
    assert report.metrics["production_to_training_mae_ratio"] == pytest.approx(2 / 3)
    stations = {r.station_id: (r.samples, r.mae) for r in monitoring.station_breakdown(joined).collect()}
    assert stations == {"north": (1, 0.0), "south": (1, 1.0), "east": (1, 0.0)}


def test_too_few_samples_evaluates_nothing(spark):
    audits, actuals = three(spark)
    audits[0] = audit(1, "north", 30, 3, 11, capacity=0)
    report, _ = judge(spark, audits, actuals, Settings())
    assert (report.status, report.warnings, report.failures) == ("insufficient_data", [], [])
    assert report.metrics["invalid_feature_rate"] == pytest.approx(1 / 3)


def test_window_edges(spark):
    audits = [
        audit(1, "s1", -2, 5, 5),  # served before the start
        audit(2, "s1", 0, 5, 5, version="2"),
        audit(3, "s1", 0, 5, 5),
        audit(4, "s1", 24 * 60 - 15, 5, 5),  # target exactly at the end
        audit(5, "s1", 24 * 60 - 14, 5, 5),  # target after the end
    ]
    rows = spark.createDataFrame(audits, AUDIT)
    kept = monitoring.select_window(rows, START, START + timedelta(hours=24), "3")
    assert {r.event_id for r in kept.collect()} == {"r3", "r4"}


def test_flags(spark):
    audits = [
        audit(1, "s", 0, 5, 5),
        audit(2, "s", 0, 11, 5),
        audit(3, "s", 0, -1, 5),
        audit(4, "s", 0, 5, 5, capacity=None),
        audit(5, "s", 0, 5, 5, served_after=15),
        audit(6, "s", 0, 5, 5, served_after=16),
    ]
    rows = monitoring.flag_rows(spark.createDataFrame(audits, AUDIT), 900).orderBy("event_id")
    flags = [(r.invalid_features, r.stale_features) for r in rows.collect()]
    assert flags == [(False, False), (True, False), (True, False), (True, False), (False, False), (False, True)]


@pytest.mark.parametrize(
    ("change", "status", "warnings", "failures"),
    [
        ({}, "passed", [], []),
        ({"invalid_feature_rate": 0.1}, "failed", [], [monitoring.FAIL_INVALID]),
        ({"label_coverage": 0.89}, "warning", [monitoring.WARN_COVERAGE], []),
        ({"stale_feature_rate": 0.1}, "warning", [monitoring.WARN_STALE], []),
        ({"psi_capacity": 0.1}, "warning", ["psi_capacity exceeded the warning threshold"], []),
        ({"psi_prediction": 0.25}, "failed", [], ["psi_prediction exceeded the failure threshold"]),
        ({"production_mae": 2.0}, "failed", [], [monitoring.FAIL_BASELINE]),
        ({"labeled_count": 99.0}, "warning", [monitoring.WARN_FEW_LABELS], []),
        ({"labeled_count": 99.0, "production_mae": 3.0}, "warning", [monitoring.WARN_FEW_LABELS], []),
        ({"sample_count": 99.0, "invalid_feature_rate": 1.0}, "insufficient_data", [], []),
    ],
)
def test_rules(spark, change, status, warnings, failures):
    metrics = {
        "sample_count": 100.0,
        "labeled_count": 100.0,
        "label_coverage": 1.0,
        "invalid_feature_rate": 0.0,
        "stale_feature_rate": 0.0,
        "production_mae": 1.0,
        "persistence_baseline_mae": 2.0,
        **{f"psi_{c}": 0.0 for c in ("hour_utc", "capacity", "prediction")},
        **change,
    }
    table = spark.createDataFrame([Row(name=k, value=v) for k, v in metrics.items()])
    got = monitoring.decide(table, Settings()).first()
    assert (got.status, got.warnings, got.failures) == (status, warnings, failures)
    assert got.metrics == metrics


def test_empty_window(spark):
    audits, actuals = three(spark)
    old = [audit(1, "s1", -600, 5, 7)]
    report, _ = judge(spark, old, actuals, Settings(monitoring_min_samples=1))
    assert report.status == "insufficient_data"
    assert report.metrics["sample_count"] == 0.0 and report.metrics["label_coverage"] == 0.0
    assert "production_mae" not in report.metrics
    assert all(v == 0.0 for k, v in report.metrics.items() if k.startswith("psi_"))


def test_backfill_equals_one_run_per_window(spark, sf_dir):
    labeled = asof.nearest_asof(tb.audits(spark, sf_dir), tb.actuals(spark, sf_dir), 120)
    flagged = monitoring.flag_rows(labeled.where("model_version = '3'"), 900).persist()
    runs = {r.window_end: r for r in monitoring.backfill_metrics(flagged).collect()}
    ends = sorted(runs)
    for end in (ends[0], ends[11], ends[len(ends) // 2], ends[-1]):
        window = monitoring.select_window(
            flagged, F.timestamp_seconds(F.lit(end - 86_400)), F.timestamp_seconds(F.lit(end)), "3"
        )
        single = monitoring.window_metrics(window).first()
        for name in ("sample_count", "labeled_count", "stale_feature_rate", "production_rmse"):
            assert runs[end][name] == pytest.approx(single[name]), (end, name)
    flagged.unpersist()


def test_backfill_verdicts_equal_one_run_per_window(spark, sf_dir):
    settings = Settings(monitoring_min_samples=5)
    labeled = asof.nearest_asof(tb.audits(spark, sf_dir), tb.actuals(spark, sf_dir), 600)
    flagged = monitoring.flag_rows(labeled.where("model_version = '3'"), 900).persist()
    reference = tb.formula_prediction(tb.features(spark, sf_dir)).persist()
    counts = drift.value_counts(reference, None, monitoring.DRIFT_COLUMNS)
    state = drift.reference_state(counts).persist()
    runs = monitoring.backfill_decisions(flagged, state, settings, 2.0).collect()
    by_end = {r.window_end: r for r in runs}
    ends = sorted(by_end)
    for end in (ends[3], ends[len(ends) // 3], ends[-20]):
        window = monitoring.select_window(
            flagged, F.timestamp_seconds(F.lit(end - 86_400)), F.timestamp_seconds(F.lit(end)), "3"
        )
        both = drift.value_counts(reference, window, monitoring.DRIFT_COLUMNS)
        table = monitoring.metric_table(
            monitoring.window_metrics(window, 2.0), drift.psi(both, monitoring.DRIFT_COLUMNS)
        )
        single = monitoring.decide(table, settings).first()
        got = by_end[end]
        assert (got.status, got.warnings, got.failures) == (
            single.status,
            single.warnings,
            single.failures,
        )
        assert got.metrics == pytest.approx(single.metrics)
    flagged.unpersist()
    reference.unpersist()


def test_backfill_over_gaps_and_lost_capacities(spark, sf_dir):
    """Days without audits give windows without samples; days without capacities invalid features."""
    labeled = asof.nearest_asof(tb.audits(spark, sf_dir), tb.actuals(spark, sf_dir), 120)
    day = F.floor(F.unix_seconds("feature_observed_at") / 86_400) % 10
    rows = labeled.where((F.col("model_version") == "3") & ~day.isin(3, 4, 5))
    rows = rows.withColumn("capacity", F.when(~day.isin(7, 8), F.col("capacity")))
    flagged = monitoring.flag_rows(rows, 900).persist()
    runs = monitoring.backfill_metrics(flagged).collect()
    ends = sorted(r.window_end for r in runs)
    assert ends == list(range(ends[0], ends[-1] + 1, 3600))
    assert {r.sample_count == 0 for r in runs} == {True, False}
    assert any(r.invalid_feature_rate == 1 for r in runs)
    counts = drift.value_counts(tb.formula_prediction(tb.features(spark, sf_dir)), None, monitoring.DRIFT_COLUMNS)
    state = drift.reference_state(counts)
    verdicts = monitoring.backfill_decisions(flagged, state, Settings(monitoring_min_samples=5)).collect()
    assert {r.status for r in verdicts if r.metrics["sample_count"] == 0} == {"insufficient_data"}
    assert all(r.metrics["psi_prediction"] == 0 for r in verdicts if r.metrics["sample_count"] == 0)
    flagged.unpersist()
