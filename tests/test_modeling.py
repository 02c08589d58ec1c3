from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tidewheel.config import Settings
from tidewheel.operators import modeling
from tidewheel.schemas import TARGET_COLUMN
from tidewheel.sources.registry import Registry

START = 1_767_225_600


def timeline(spark, times, stations=2):
    rows = [(f"s{i}", t) for t in times for i in range(stations)]
    frame = spark.createDataFrame(rows, "station_id string, t bigint")
    return frame.select("*", F.timestamp_seconds("t").alias("event_timestamp"))


def test_split_is_disjoint_and_ordered(spark):
    split = modeling.chrono_split(timeline(spark, [START + 900 * i for i in range(20)]))
    ranges = {
        r.split: (r.low, r.high, r.n)
        for r in split.groupBy("split")
        .agg(F.min("t").alias("low"), F.max("t").alias("high"), F.count("*").alias("n"))
        .collect()
    }
    assert [ranges[k][2] for k in ("train", "validation", "test")] == [28, 6, 6]
    assert ranges["train"][1] < ranges["validation"][0]
    assert ranges["validation"][1] < ranges["test"][0]


@pytest.mark.parametrize("count", [10, 11, 13, 47, 301])
def test_split_sizes_follow_the_truncated_shares(spark, count):
    rng = random.Random(count)
    times = rng.sample(range(START, START + 40 * 86_400), count)
    split = modeling.chrono_split(timeline(spark, times, 1))
    train_end = max(1, int(count * 0.70))
    validation_end = max(train_end + 1, int(count * 0.85))
    ordered = sorted(times)
    expected = {t: "train" for t in ordered[:train_end]}
    expected |= {t: "validation" for t in ordered[train_end:validation_end]}
    expected |= {t: "test" for t in ordered[validation_end:]}
    assert {r.t: r.split for r in split.collect()} == expected


def test_too_few_times(spark):
    with pytest.raises(Exception, match="At least 10 distinct timestamps"):
        modeling.chrono_split(timeline(spark, range(START, START + 9))).collect()


def test_scores(spark):
    rows = [("test", 4.0, 5.0, 4), ("test", 6.0, 6.0, 5), ("test", 8.0, 5.0, 7)]
    frame = spark.createDataFrame(
        rows, f"split string, {TARGET_COLUMN} double, raw_prediction double, available_bikes bigint"
    )
    got = modeling.regression_scores(frame).first()
    assert got.mae == pytest.approx(4 / 3)
    assert got.rmse == pytest.approx(math.sqrt(10 / 3))
    assert got.r2 == pytest.approx(1 - 10 / 8)
    assert got.baseline_mae == pytest.approx(2 / 3)


@pytest.mark.parametrize(("mae", "promoted"), [(1.49, True), (1.5, False), (1.51, False)])
def test_gate_is_strict(spark, mae, promoted):
    scores = spark.createDataFrame(
        [("validation", mae, 1.0, 0.5, 1.5), ("test", 2.0, 2.5, 0.4, 3.0)],
        "split string, mae double, rmse double, r2 double, baseline_mae double",
    )
    got = modeling.promotion_gate(scores).first()
    assert got.promoted is promoted
    assert (got.test_mae, got.test_rmse, got.test_r2) == (2.0, 2.5, 0.4)


def test_missing_features_fail_training(spark):
    frame = spark.sql(
        "SELECT 1 hour_utc, 1 day_of_week, 1 available_bikes, 1 available_docks, 2 capacity,"
        " CAST(NULL AS DOUBLE) availability_ratio"
    )
    with pytest.raises(Exception, match="missing training features"):
        modeling.require_complete(frame).collect()


LATEST = (
    "station_id string, feature_observed_at bigint, hour_utc bigint, day_of_week bigint,"
    " available_bikes bigint, available_docks bigint, capacity bigint, availability_ratio double"
)


@pytest.mark.parametrize(
    ("raw", "bounded"), [(25.2, 20), (13.4, 13), (2.5, 2), (3.5, 4), (-0.6, 0), (20.4, 20)]
)
def test_scoring_bounds_and_audit_row(spark, raw, bounded):
    latest = spark.createDataFrame(
        [("s1", START, 8, 2, 12, 8, 20, 0.6), ("s2", START, 8, 2, None, 8, 20, 0.6)], LATEST
    )
    requests = spark.createDataFrame(
        [("q1", "s1", START + 60), ("q2", "s2", START + 60), ("q3", "s3", START + 60)],
        "request_id string, station_id string, t bigint",
    ).withColumn("served_at", F.timestamp_seconds("t"))
    seen = []

    def predictor(df):
        seen.append([c for c in df.columns if c in modeling.FEATURE_COLUMNS])
        return df.withColumn("raw_prediction", F.lit(raw))

    scored = modeling.score_requests(requests, latest, predictor, Settings(), "7")
    rows = {r.request_id: r for r in scored.collect()}
    assert seen[0] == list(modeling.FEATURE_COLUMNS)
    assert rows["q1"].predicted_available_bikes_15m == bounded
    assert (rows["q1"].model_version, rows["q1"].model_alias) == ("7", "champion")
    assert (rows["q1"].target_at - rows["q1"].feature_observed_at).total_seconds() == 900
    assert rows["q1"].found and not rows["q2"].found and not rows["q3"].found
    assert rows["q2"].raw_prediction is None and rows["q2"].predicted_available_bikes_15m is None
    assert rows["q2"].available_docks == 8


def test_registry_moves_the_champion_only_on_promotion(spark, tmp_path):
    registry = Registry(spark, str(tmp_path))
    with pytest.raises(LookupError):
        registry.lookup("m")
    assert registry.register("m", "run-a", "/a", {"test_mae": 2.0}, True) == "1"
    assert registry.register("m", "run-b", "/b", {"other": 1.0}, False) == "2"
    assert registry.register("m", "run-b", "/b", {"other": 1.0}, False) == "2"
    champion = registry.lookup("m")
    assert (champion.version, champion.path, champion.training_test_mae) == ("1", "/a", 2.0)
    candidate = registry.lookup("m", "candidate")
    assert (candidate.version, candidate.training_test_mae) == ("2", None)
    status = {r.version: r.validation_status for r in registry.versions().collect()}
    assert status == {"1": "passed", "2": "failed"}
    for run in range(8):
        registry.register("m", f"run-{run}", "/x", {"test_mae": 1.0}, True)
    assert registry.lookup("m").version == "10"


def test_fitted_model_beats_no_change(spark, sf_dir):
    """What the catalogue query does not compare with SQL: the errors themselves."""
    from tidewheel.plans import testbed as tb

    labelled = tb.history(spark, "/root/testdata/sf0.01").where(F.col(TARGET_COLUMN).isNotNull())
    split = modeling.chrono_split(labelled).persist()
    model = modeling.fit_model(split.where("split = 'train'"))
    assert model.nodes.tree.nunique() == modeling.MAX_ITERATIONS
    assert model.nodes[model.nodes.left < 0].groupby("tree").size().max() <= 31
    scored = modeling.predict(model, split)
    for r in modeling.regression_scores(scored).collect():
        assert math.isfinite(r.r2) and r.mae <= r.rmse < 15
        assert r.mae < r.baseline_mae and (r.split != "train" or r.r2 > 0.2)
    split.unpersist()
