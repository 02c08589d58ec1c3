from __future__ import annotations

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from tidewheel.operators import asof

AUDIT = "n bigint, station_id string, target_at bigint"
SEEN = "event_id bigint, station_id string, last_reported bigint, num_bikes_available bigint"


def nearest(spark, audits, seen, tolerance):
    rows = asof.nearest_asof(
        spark.createDataFrame(audits, AUDIT), spark.createDataFrame(seen, SEEN), tolerance
    ).collect()
    assert len(rows) == len(audits)
    return {r.n: (r.actual_at, r.actual_available_bikes) for r in rows}


def test_tolerance_is_inclusive(spark):
    audits, seen = [(1, "a", 1000)], [(1, "a", 1045, 7)]
    assert nearest(spark, audits, seen, 120) == {1: (1045, 7)}
    assert nearest(spark, audits, seen, 45) == {1: (1045, 7)}
    assert nearest(spark, audits, seen, 44) == {1: (None, None)}
    assert nearest(spark, audits, [(1, "a", 1000, 5)], 0) == {1: (1000, 5)}
    assert nearest(spark, audits, seen, 0) == {1: (None, None)}


def test_ties(spark):
    seen = [(1, "a", 990, 1), (2, "a", 1010, 2), (3, "a", 990, 3)]
    # The earlier of two equally near; of two at one instant the greater event id.
    assert nearest(spark, [(1, "a", 1000)], seen, 60) == {1: (990, 3)}
    assert nearest(spark, [(1, "a", 1001)], seen, 60) == {1: (1010, 2)}


def test_rows_without_a_partner_stay(spark):
    audits = [(1, "a", 1000), (2, None, 1000), (3, "a", None), (4, "z", 1000), (5, "a", 1000)]
    got = nearest(spark, audits, [(1, "a", 1000, 9), (2, None, 1000, 8)], 60)
    assert got == {1: (1000, 9), 2: (None, None), 3: (None, None), 4: (None, None), 5: (1000, 9)}


def test_nearest_matches_a_sequential_merge(spark):
    when = st.integers(0, 30_000)

    @settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
    @given(
        st.lists(st.tuples(st.sampled_from("ab"), when), min_size=1, max_size=120),
        st.lists(st.tuples(st.sampled_from("ab"), when), min_size=1, max_size=120, unique=True),
        st.sampled_from([0, 30, 120, 5000]),
    )
    def run(asked, given_points, tolerance):
        audits = [(i, s, t) for i, (s, t) in enumerate(asked)]
        seen = [(i, s, t, i) for i, (s, t) in enumerate(given_points)]
        left = pd.DataFrame(audits, columns=["n", "s", "t"]).sort_values("t")
        right = pd.DataFrame(seen, columns=["e", "s", "at", "v"]).sort_values("at")
        merged = pd.merge_asof(
            left, right, left_on="t", right_on="at", by="s", direction="nearest", tolerance=tolerance
        )
        expected = {
            r.n: (None, None) if pd.isna(r.at) else (int(r.at), int(r.v))
            for r in merged.itertuples()
        }
        assert nearest(spark, audits, seen, tolerance) == expected

    run()


def pit(spark, requests, history, ttl):
    rows = asof.point_in_time(
        spark.createDataFrame(requests, "n bigint, station_id string, asked bigint"),
        spark.createDataFrame(history, "station_id string, seen bigint, a bigint, b double"),
        ["a", "b"],
        ttl,
        at="asked",
        observed="seen",
    ).collect()
    assert len(rows) == len(requests)
    return {r.n: (r.a, r.b) for r in rows}


def test_point_in_time_never_looks_ahead_and_expires(spark):
    history = [("s", 100, 1, 0.1), ("s", 200, 2, None), ("s", 300, 3, 0.3)]
    requests = [(1, "s", 99), (2, "s", 100), (3, "s", 299), (4, "s", 300 + 50), (5, "s", 351)]
    assert pit(spark, requests, history, 50) == {
        1: (None, None),
        2: (1, 0.1),
        3: (None, None),
        4: (3, 0.3),
        5: (None, None),
    }
    # A missing value of the newest row is not filled from an older one.
    assert pit(spark, [(1, "s", 250)], history, 500) == {1: (2, None)}


def test_point_in_time_matches_a_sequential_merge(spark):
    when = st.integers(0, 900_000)

    @settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
    @given(
        st.lists(st.tuples(st.sampled_from("ab"), when), min_size=1, max_size=120),
        st.lists(st.tuples(st.sampled_from("ab"), when), min_size=1, max_size=120, unique=True),
        st.sampled_from([60, 3600, 172_800]),
    )
    def run(asked, points, ttl):
        requests = [(i, s, t) for i, (s, t) in enumerate(asked)]
        history = [(s, t, i, i / 2) for i, (s, t) in enumerate(points)]
        left = pd.DataFrame(requests, columns=["n", "s", "t"]).sort_values("t")
        right = pd.DataFrame(history, columns=["s", "at", "a", "b"]).sort_values("at")
        merged = pd.merge_asof(left, right, left_on="t", right_on="at", by="s", tolerance=ttl)
        expected = {
            r.n: (None, None) if pd.isna(r.a) else (int(r.a), r.b) for r in merged.itertuples()
        }
        assert pit(spark, requests, history, ttl) == expected

    run()


def test_probes_between_seconds(spark):
    audits = spark.sql(
        "SELECT n, 'a' AS station_id, timestamp_micros(us) AS target_at FROM VALUES"
        " (1L, 1000500000L), (2L, 1000499999L), (3L, 1000500001L), (4L, 1060000000L),"
        " (5L, 1061000001L) AS t(n, us)"
    )
    seen = spark.createDataFrame([(1, "a", 1000, 1), (2, "a", 1001, 2)], SEEN)
    got = {r.n: r.actual_at for r in asof.nearest_asof(audits, seen, 60).collect()}
    # The middle between two observations goes to the earlier one.
    assert got == {1: 1000, 2: 1000, 3: 1001, 4: 1001, 5: None}


def test_points_between_seconds_are_refused(spark):
    points = spark.sql("SELECT 's' AS station_id, timestamp_micros(1500000) AS event_timestamp, 1 AS a")
    with pytest.raises(Exception, match="whole seconds"):
        asof.point_in_time(points.select("station_id", "event_timestamp"), points, ["a"], 60).collect()
