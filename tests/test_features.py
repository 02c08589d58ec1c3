from __future__ import annotations

from datetime import datetime, timezone

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidewheel.operators import checks, features
from tidewheel.schemas import TARGET_COLUMN

START = 1_767_225_600  # 2026-01-01 00:00 UTC, a Thursday


def raw(spark, rows):
    """Rows of (station, seconds after START, bikes, capacity)."""
    full = [(s, START + t, b, c, c - b) for s, t, b, c in rows]
    return spark.createDataFrame(
        full,
        "station_id string, last_reported bigint, num_bikes_available bigint, capacity bigint,"
        " num_docks_available bigint",
    )


def history(spark, rows):
    return features.feature_history(features.stage_observations(raw(spark, rows), "synthetic"))


def test_exact_fifteen_minute_labels(spark):
    rows = history(spark, [("one", 0, 5, 10), ("one", 900, 4, 10), ("one", 2700, 3, 10)])
    got = rows.orderBy("feature_observed_at").collect()
    assert [r.feature_observed_at for r in got] == [1767225600, 1767226500, 1767228300]
    assert [r.hour_utc for r in got] == [0, 0, 0]
    assert [r.day_of_week for r in got] == [3, 3, 3]
    assert [r.availability_ratio for r in got] == [0.5, 0.4, 0.3]
    assert [r[TARGET_COLUMN] for r in got] == [4.0, None, None]
    assert {r.source_name for r in got} == {"synthetic"}


def test_label_across_midnight_and_between_rows(spark):
    day = 86_400
    rows = history(
        spark,
        [
            ("a", day - 900, 1, 9),
            ("a", day, 2, 9),
            ("a", day + 300, 3, 9),  # the next row is not the one 15 minutes later
            ("a", day + 900, 4, 9),
            ("b", day + 900, 8, 9),
        ],
    )
    got = {(r.station_id, r.available_bikes): r[TARGET_COLUMN] for r in rows.collect()}
    assert got == {("a", 1): 2.0, ("a", 2): None, ("a", 3): None, ("a", 4): None, ("b", 8): None}


def test_repeated_rows_survive_and_one_is_labelled(spark):
    rows = history(spark, [("a", 0, 1, 9)] * 50 + [("a", 900, 2, 9)]).collect()
    labels = [r[TARGET_COLUMN] for r in rows if r.available_bikes == 1]
    assert len(labels) == 50 and sorted(x for x in labels if x is not None) == [2.0]
    failing = checks.duplicate_keys(history(spark, [("a", 0, 1, 9)] * 2)).collect()
    assert [r.copies for r in failing] == [2]


def test_labels_match_a_sequential_reading(spark):
    point = st.tuples(st.sampled_from("abc"), st.integers(0, 400).map(lambda k: k * 450))

    @settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(point, min_size=1, max_size=200, unique=True))
    def run(points):
        rows = [(s, t, (i * 7) % 20, 20) for i, (s, t) in enumerate(points)]
        frame = pd.DataFrame(rows, columns=["s", "t", "b", "c"]).sort_values(["s", "t"])
        following = frame.groupby("s")[["t", "b"]].shift(-1)
        expected = {
            (r.s, r.t): float(n.b) if n.t == r.t + 900 else None
            for r, n in zip(frame.itertuples(), following.itertuples())
        }
        got = {
            (r.station_id, r.feature_observed_at - START): r[TARGET_COLUMN]
            for r in history(spark, rows).collect()
        }
        assert got == expected

    run()


def test_calendar_fields_do_not_follow_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        row = history(spark, [("a", 3 * 86_400 + 23 * 3600, 1, 2)]).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert (row.hour_utc, row.day_of_week) == (23, 6)


def test_latest_extent_and_order(spark):
    rows = history(spark, [("a", 0, 1, 9), ("a", 900, 2, 9), ("b", 300, 5, 9)])
    latest = {r.station_id: r.available_bikes for r in features.latest_features(rows).collect()}
    assert latest == {"a": 2, "b": 5}
    extent = features.history_extent(rows).select(
        F.unix_seconds("start_at"), F.unix_seconds("end_at")
    )
    assert tuple(extent.first()) == (START - 60, START + 960)
    ordered = features.sort_history(raw(spark, [("b", 1, 1, 2), ("a", 1, 1, 2), ("c", 0, 1, 2)]))
    assert [r.station_id for r in ordered.collect()] == ["c", "a", "b"]


def test_dedup_history_keeps_the_newest_poll(spark):
    rows = spark.createDataFrame(
        [("a", 1, 10, "x", 1), ("a", 1, 20, "y", 2), ("a", 2, 20, "z", 3)],
        "station_id string, last_reported bigint, source_updated_at bigint, event_id string, v int",
    )
    assert {r.event_id for r in features.dedup_history(rows).collect()} == {"y", "z"}


def test_checks(spark):
    staged = features.stage_observations(
        raw(spark, [("a", 0, 1, 9), ("a", 900, 2, 9)]), "synthetic"
    )
    good = checks.run_checks(staged, features.feature_history(staged))
    assert [(r.status, r.checks) for r in checks.summarize(good).collect()] == [("pass", 16)]
    checks.require_passed(good)

    broken = features.stage_observations(
        raw(spark, [("a", 0, 10, 9), ("b", 0, 0, 0), (None, 0, 1, 9), ("c", 0, 1, 2), ("c", 0, 2, 2)]),
        "synthetic",
    )
    results = checks.run_checks(broken, features.feature_history(broken))
    failing = {r.check: r.failing_rows for r in results.where("failing_rows > 0").collect()}
    assert failing == {
        "not_null_staged_station_id": 1,
        "not_null_history_station_id": 1,
        "not_null_history_availability_ratio": 1,
        "feature_bounds": 2,
        "unique_station_timestamp": 1,
    }
    with pytest.raises(checks.ChecksFailed, match="feature_bounds"):
        checks.require_passed(results)


def test_timestamps_are_instants(spark):
    row = history(spark, [("a", 0, 1, 9)]).select(
        F.unix_micros("event_timestamp").alias("us")
    ).first()
    start = datetime(2026, 1, 1, tzinfo=timezone.utc)
    assert row.us == int(start.timestamp()) * 1_000_000
