from __future__ import annotations

import json
from pathlib import Path
import time

import pytest
from pyspark.sql import functions as F

from stations import POLLED, event, messages, quays, snapshot, station
from tidewheel.operators import cleaning, profiling, snapshots
from tidewheel.operators.profiling import Policy, PolicyExhausted
from tidewheel.sources import snapshots as landing
from tidewheel.sources.topic import decode, topic_frame

BOTH = Policy(True, 900)


def flat(spark, *docs):
    rows = spark.createDataFrame([(json.dumps(d),) for d in docs], "t string")
    parsed = rows.select(F.try_parse_json("t").alias("snapshot"))
    return snapshots.flatten_snapshot(parsed)


def records_of(spark, doc):
    listed = flat(spark, doc).orderBy("station_id").select("record").collect()
    return [json.loads(r["record"].toJson()) for r in listed]


def outcomes(spark, events, policy=BOTH):
    judged = cleaning.evaluate(decode(messages(spark, events)), policy, 900)
    return cleaning.tag_outcomes(judged).orderBy("arrival").collect()


def test_repeated_event_is_a_duplicate(spark):
    first, out = records_of(spark, snapshot(station("a"), station("b", age=5_000, on=0)))
    judged = cleaning.evaluate(decode(messages(spark, [first, out, first, first])), Policy(), 900)
    report = cleaning.quality_report(judged).first()
    assert (report.accepted_rows, report.quarantined_rows, report.duplicate_rows) == (1, 1, 2)
    assert (report.alias_recovered_rows, report.grace_accepted_rows) == (0, 0)
    # Out of service is checked before staleness.
    assert [r.reason for r in judged.where("reason IS NOT NULL").collect()] == [
        cleaning.REASON_NOT_OPERATIONAL
    ]


def test_profile_and_policy(spark):
    decoded = decode(messages(spark, records_of(spark, quays())))
    profile = profiling.profile_batch(decoded, 900).first()
    assert (profile.alias_candidates, profile.within_freshness_grace) == (2, 2)
    policy, attempts = profiling.settle_policy(profile)
    assert (policy.allow_bikes_available_alias, policy.freshness_grace_seconds) == (True, 900)
    assert attempts == 1
    judged = cleaning.evaluate(decoded, policy, 900)
    report = cleaning.quality_report(judged).first()
    assert (report.accepted_rows, report.quarantined_rows) == (4, 1)
    assert (report.alias_recovered_rows, report.grace_accepted_rows) == (2, 2)
    assert report.warnings == [cleaning.WARN_GRACE]
    rows = {r.station_id: r for r in cleaning.accepted_rows(judged).collect()}
    assert {k: r.num_bikes_available for k, r in rows.items()} == {"quay": 9, "mill": 6, "gate": 9, "yard": 3}
    assert tuple(rows["quay"].asDict()) == cleaning.OBSERVATION_COLUMNS


@pytest.mark.parametrize(
    ("alias", "grace", "accepted"),
    [
        (False, 0, {"quay"}),
        (True, 0, {"quay", "mill"}),
        (False, 900, {"quay", "gate"}),
        (True, 900, {"quay", "mill", "gate", "yard"}),
    ],
)
def test_policies(spark, alias, grace, accepted):
    rows = outcomes(spark, records_of(spark, quays()), Policy(alias, grace))
    assert {r.station_id for r in rows if r.outcome == "accepted"} == accepted


@pytest.mark.parametrize(
    "change",
    [
        {"status__num_bikes_available": -4},
        {"status__num_docks_available": None},
        {"status__last_reported": POLLED - 2_700},
        {"status__last_reported": POLLED + 95},
        {"metadata__capacity": ...},
        {"station_id": ""},
    ],
)
def test_bad_row_is_quarantined_with_its_record(spark, change):
    bad = event(**change)
    judged = cleaning.evaluate(decode(messages(spark, [bad])), Policy(), 900)
    assert cleaning.accepted_rows(judged).count() == 0
    kept = cleaning.quarantined_rows(judged).first()
    assert json.loads(kept.record) == bad and kept.reason


@pytest.mark.parametrize(
    ("age", "reason"),
    [
        (1800, None),
        (1801, cleaning.REASON_STALE),
        (-60, None),
        (-61, cleaning.REASON_FUTURE),
    ],
)
def test_time_boundaries(spark, age, reason):
    row = outcomes(spark, [event(status__last_reported=POLLED - age)])[0]
    assert row.reason == reason


def test_alias_never_overrides_canonical(spark):
    both = event(status__bikes_available=13)
    only = event(event_id="e2", status__num_bikes_available=..., status__bikes_available=4)
    null = event(event_id="e3", status__num_bikes_available=None, status__bikes_available=0)
    rows = outcomes(spark, [both, only, null])
    assert [r.num_bikes_available for r in rows] == [9, 4, 0]
    assert [r.used_alias for r in rows] == [False, True, True]


def test_wrong_shapes_are_quarantined_and_profiled(spark):
    events = ["not json", "[1]", event(status=None), event(metadata="x"), event(status=...), event()]
    decoded = decode(messages(spark, events))
    judged = cleaning.evaluate(decoded, Policy(), 900).orderBy("arrival").collect()
    assert [r.reason is None for r in judged] == [False] * 5 + [True]
    assert [r.reason == cleaning.REASON_NOT_OBJECT for r in judged[:5]] == [
        False,
        False,
        True,
        True,
        False,
    ]
    profile = profiling.profile_batch(decoded, 900).first()
    assert profile.rows == 6
    assert profile.missing_fields == {"station_id": 2, "status": 4, "metadata": 2}
    errors = decoded.select(F.try_variant_get("record", "$.decode_error", "string")).collect()
    assert [r[0] is None for r in errors] == [False, False, True, True, True, True]


def test_profile_needs_integer_times_but_cleaning_coerces(spark):
    text_time = event(status__last_reported=str(POLLED - 5))
    decoded = decode(messages(spark, [text_time, event(event_id="e2", source_updated_at=True)]))
    profile = profiling.profile_batch(decoded, 900).first()
    assert profile.within_freshness_limit == 0
    assert (profile.timestamp_min, profile.timestamp_max) == (POLLED, POLLED)
    assert outcomes(spark, [text_time])[0].outcome == "accepted"


def test_empty_batch(spark):
    decoded = decode(messages(spark, []))
    profile = profiling.profile_batch(decoded, 900).first()
    assert (profile.rows, profile.unique_stations, profile.missing_fields) == (0, 0, {})
    assert profile.timestamp_min is None
    report = cleaning.quality_report(cleaning.evaluate(decoded, Policy(), 900)).first()
    assert (report.input_rows, report.accepted_rows) == (0, 0)
    assert report.warnings == [cleaning.WARN_EMPTY]


def test_infeasible_policy(spark):
    decoded = decode(messages(spark, [event()]))
    profile = profiling.profile_batch(decoded, 900)
    issues = profiling.policy_issues(profile, F.lit(True), F.lit(900)).first().issues
    assert issues == [profiling.ISSUE_ALIAS, profiling.ISSUE_GRACE]
    assert profiling.issues_of(profile.first(), BOTH) == issues
    report = cleaning.quality_report(cleaning.evaluate(decoded, BOTH, 900), issues).first()
    assert (report.input_rows, report.accepted_rows, report.quarantined_rows) == (1, 0, 0)
    assert report.repairable and report.issues == issues


def test_policy_is_bounded():
    with pytest.raises(ValueError):
        Policy(False, 3600)
    with pytest.raises(ValueError):
        Policy("yes", 0)


def test_repair_budget(spark):
    profile = profiling.profile_batch(decode(messages(spark, [event()])), 900).first()
    calls = []

    def stubborn(_, issues):
        calls.append(list(issues))
        return BOTH

    with pytest.raises(PolicyExhausted):
        profiling.settle_policy(profile, stubborn, 2)
    assert len(calls) == 3 and calls[0] == [] and calls[1]
    answers = iter([BOTH, Policy()])
    policy, attempts = profiling.settle_policy(profile, lambda *_: next(answers), 2)
    assert attempts == 2 and policy == Policy()


def test_first_arrival_wins_among_rows_that_passed(spark):
    events = [
        event(status__num_bikes_available=-2),
        event(status__num_bikes_available=11),
        event(status__num_bikes_available=8),
    ]
    rows = outcomes(spark, events)
    assert [r.outcome for r in rows] == ["quarantined", "accepted", "duplicate"]
    judged = cleaning.evaluate(decode(messages(spark, events)), BOTH, 900)
    assert [r.num_bikes_available for r in cleaning.accepted_rows(judged).collect()] == [11]


def test_flatten_last_details_win_and_missing_are_empty(spark):
    doc = quays()
    listed = doc["station_information"]["data"]["stations"]
    listed.append({**listed[0], "capacity": 21})
    doc["station_information"]["data"]["stations"] = [s for s in listed if s["station_id"] != "barn"]
    doc["station_status"]["data"]["stations"].append({"last_reported": 1})
    rows = {r.station_id: r for r in flat(spark, doc).collect()}
    assert rows["quay"].metadata.toPython()["capacity"] == 21
    assert rows["barn"].metadata.toPython() == {}
    assert rows[""].metadata.toPython() == {}
    assert len(rows) == 6


def test_flatten_keeps_every_report_of_every_snapshot(spark):
    twice = snapshot(station("a"), station("a", bikes=1), station("b"))
    rows = flat(spark, twice, twice, snapshot()).collect()
    assert sorted(r.station_id for r in rows) == ["a"] * 4 + ["b"] * 2
    assert all(r.metadata.toPython()["capacity"] == 14 for r in rows)


def test_flatten_is_linear_in_the_stations(spark):
    """Twice the stations take about twice the time, in one document."""
    took = {}
    for n in (8_000, 32_000):
        doc = snapshot(*[station(f"s{k}") for k in range(n)])
        rows = spark.createDataFrame([(json.dumps(doc),)], "t string")
        parsed = snapshots.flatten_snapshot(rows.select(F.try_parse_json("t").alias("snapshot")))
        slim = parsed.select("station_id", F.try_variant_get("metadata", "$.capacity", "int").alias("c"))
        slim.write.format("noop").mode("overwrite").save()
        start = time.perf_counter()
        assert slim.where("c = 14").count() == n
        took[n] = time.perf_counter() - start
    assert took[32_000] < 8 * took[8_000] + 2


def test_flatten_numeric_ids_match(spark):
    doc = snapshot(station("7"))
    doc["station_information"]["data"]["stations"][0]["station_id"] = 7
    assert flat(spark, doc).first().metadata.toPython()["capacity"] == 14


def test_event_id_ignores_poll_time_and_key_order(spark):
    first = quays()
    again = json.loads(json.dumps({**first, "ingested_at": first["ingested_at"] + 60}, sort_keys=True))
    changed = quays()
    changed["station_status"]["data"]["stations"][0]["num_bikes_available"] = 8

    def ids(doc):
        return {r.station_id: r.event_id for r in flat(spark, doc).collect()}

    assert ids(first) == ids(again)
    assert ids(first)["quay"] != ids(changed)["quay"]
    assert ids(first)["mill"] == ids(changed)["mill"]
    seen = {ids(first)["quay"]}
    for value in ("9", 9.5, True, None, [9], {"a": 9}, {"a": "9"}):
        changed["station_status"]["data"]["stations"][0]["num_bikes_available"] = value
        seen.add(ids(changed)["quay"])
    del changed["station_status"]["data"]["stations"][0]["num_bikes_available"]
    seen.add(ids(changed)["quay"])
    assert len(seen) == 9


def test_unsupported_feed_version(spark):
    rows = spark.createDataFrame([(json.dumps(snapshot(station("a"), version="3.0")),)], "t string")
    parsed = rows.select(F.try_parse_json("t").alias("snapshot"))
    marked = snapshots.guard_version(parsed, strict=False).first()
    assert not marked.supported
    with pytest.raises(Exception, match="Only feed version 2.3"):
        snapshots.guard_version(parsed).collect()


def test_landing_is_content_addressed(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    text = json.dumps(quays())
    (source / "a.json").write_bytes(b"\xef\xbb\xbf" + text.encode())
    (source / "copy.json").write_text(text)
    (source / "b.json").write_text(json.dumps(snapshot(station("x"), polled=POLLED + 86_400)))
    read = landing.read_snapshots(spark, str(source))
    out = str(tmp_path / "raw")
    for _ in range(2):
        landing.land_snapshots(read, out)
        landed = landing.read_landed(spark, out).collect()
        assert len(landed) == 2
    assert {r.event_date for r in landed} == {"2026-02-25", "2026-02-26"}
    assert {r.system_id for r in landed} == {"harbour"}
    assert [json.loads(r.body) for r in landed if r.event_date == "2026-02-25"] == [quays()]
    (source / "c.json").write_text(json.dumps(snapshot(station("y"), polled=POLLED + 9)))
    landing.land_snapshots(landing.read_snapshots(spark, str(source)), out)
    names = [r.object_name for r in landing.read_landed(spark, out).collect()]
    assert len(names) == len(set(names)) == 3
    # one folder per system and date, not one per snapshot
    assert sorted(str(p.relative_to(out)) for p in Path(out).rglob("event_date=*")) == [
        "system_id=harbour/event_date=2026-02-25", "system_id=harbour/event_date=2026-02-26",
    ]


def test_topic_frame_round_trip(spark):
    events = flat(spark, quays())
    sent = topic_frame(events).collect()
    assert {r.key for r in sent} == {"quay", "mill", "gate", "yard", "barn"}
    assert all(json.loads(r.value)["station_id"] == r.key for r in sent)


def test_enrich_dates_are_utc(spark):
    rows = spark.createDataFrame([(0,), (86_399,), (86_400,)], "last_reported bigint")
    dated = cleaning.enrich_rows(rows, "b").orderBy("last_reported").collect()
    assert [r.event_date for r in dated] == ["1970-01-01", "1970-01-01", "1970-01-02"]
    assert {r.batch_id for r in dated} == {"b"}
