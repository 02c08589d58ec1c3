from __future__ import annotations

import json

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from stations import event
from tidewheel.operators.validation import validate_audits, validate_record
from tidewheel.schemas import AUDIT, OBSERVATION_RULES

AUDIT_MESSAGE = {
    "schema_version": 1,
    "event_id": "r1",
    "request_id": "r1",
    "station_id": "s1",
    "served_at": "2026-01-01T00:01:00Z",
    "feature_observed_at": "2026-01-01T00:00:00+00:00",
    "target_at": "2026-01-01T00:15:00Z",
    "horizon_minutes": 15,
    "model_name": "m",
    "model_version": "3",
    "model_alias": "champion",
    "raw_prediction": 4.4,
    "predicted_available_bikes_15m": 4,
    "hour_utc": 0,
    "day_of_week": 3,
    "available_bikes": 5,
    "available_docks": 5,
    "capacity": 10,
    "availability_ratio": 0.5,
}


def parsed(spark, values):
    rows = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "i int, t string")
    return rows.select("i", F.try_parse_json("t").alias("record"))


def checked(spark, events):
    return validate_record(parsed(spark, events), OBSERVATION_RULES).orderBy("i").collect()


@pytest.mark.parametrize(
    ("value", "result"),
    [
        (5, 5),
        (5.0, 5),
        ("5", 5),
        ("5.0", 5),
        (" 5 ", 5),
        (True, 1),
        (1e3, 1000),
        (5.5, None),
        ("5.5", None),
        ("1e3", None),
        ("7.", None),
        ("7.00", 7),
        ("+2", 2),
        ("x", None),
        ("", None),
        (None, None),
        ([5], None),
        ({"a": 5}, None),
        (10**20, None),
    ],
)
def test_whole_numbers(spark, value, result):
    row = checked(spark, [event(status__num_docks_available=value)])[0]
    assert row.num_docks_available == result
    assert (row.problems == []) == (result is not None)


@pytest.mark.parametrize(
    ("value", "ok"), [(1, True), (True, True), (1.0, True), (0, True), ("1", False), (2, False)]
)
def test_literals(spark, value, ok):
    row = checked(spark, [event(status__is_renting=value)])[0]
    assert (row.problems == []) == ok


def test_reason_codes(spark):
    rows = checked(
        spark,
        [
            event(schema_version=...),
            event(schema_version=None),
            event(schema_version=2),
            event(station_id=""),
            event(station_id=7),
            event(status__num_bikes_available=-1, metadata__capacity=0),
            event(metadata__lat="91", metadata__lon="-73.9"),
            event(status=...),
        ],
    )
    assert [r.problems for r in rows[:7]] == [
        [],
        ["schema_version:missing"],
        ["schema_version:not_allowed"],
        ["station_id:too_short"],
        ["station_id:wrong_type"],
        ["num_bikes_available:too_small", "capacity:too_small"],
        ["lat:too_large"],
    ]
    assert len(rows[7].problems) == 6


def test_agrees_with_the_contract_library(spark):
    """Fuzz one field against the public validation library, where it is installed."""
    pydantic = pytest.importorskip("pydantic")
    from typing import Literal

    class Row(pydantic.BaseModel):
        whole: int = pydantic.Field(ge=0)
        flag: Literal[0, 1]
        text: str = pydantic.Field(min_length=1)
        real: float = pydantic.Field(ge=-90, le=90)

    places = {
        "whole": "status__num_docks_available",
        "flag": "status__is_renting",
        "text": "station_id",
        "real": "metadata__lat",
    }
    good = {"whole": 1, "flag": 1, "text": "a", "real": 1.0}
    value = st.one_of(
        st.none(),
        st.booleans(),
        st.integers(-200, 200),
        st.floats(-200, 200, allow_nan=False).map(lambda x: round(x, 2)),
        st.sampled_from(["", "0", "1", "1.0", "7.", "-3", " 4 ", "+2", "1.5", ".5", "1e1", "a", "true"]),
        st.lists(st.integers(), max_size=1),
    )
    case = st.tuples(st.sampled_from(sorted(places)), value)

    @settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(case, min_size=40, max_size=60))
    def run(cases):
        rows = checked(spark, [event(**{places[name]: v}) for name, v in cases])
        for (name, v), row in zip(cases, rows):
            try:
                Row.model_validate({**good, name: v})
                expected = True
            except pydantic.ValidationError:
                expected = False
            assert (row.problems == []) == expected, (name, v, row.problems)

    run()


def test_audit_contract(spark):
    bad = [
        {**AUDIT_MESSAGE, "extra": 1},
        {**AUDIT_MESSAGE, "availability_ratio": 1.2},
        {**AUDIT_MESSAGE, "horizon_minutes": 30},
        {**AUDIT_MESSAGE, "target_at": "soon"},
        {k: v for k, v in AUDIT_MESSAGE.items() if k != "model_name"},
        [1],
    ]
    rows = validate_audits(parsed(spark, [AUDIT_MESSAGE, *bad])).orderBy("i").collect()
    assert [r.error for r in rows] == [
        None,
        "extra:unknown",
        "availability_ratio:too_large",
        "horizon_minutes:not_allowed",
        "target_at:wrong_type",
        "model_name:missing",
        "not_an_object",
    ]
    good = validate_audits(parsed(spark, [AUDIT_MESSAGE])).select(
        *[F.unix_seconds(c).alias(c) for c in ("served_at", "feature_observed_at", "target_at")]
    ).first()
    assert tuple(good) == (1767225660, 1767225600, 1767226500)
    assert set(AUDIT.fieldNames()) == set(AUDIT_MESSAGE)
