from __future__ import annotations

import json

import pytest
from pyspark.sql import Observation

from stations import POLLED, event, quays, snapshot, station
from test_cleaning import records_of
from test_validation import AUDIT_MESSAGE
from topics import record_messages
from tidewheel.config import Settings
from tidewheel.operators.profiling import Policy, PolicyExhausted
from tidewheel.operators import cleaning
from tidewheel.operators.modeling import score_requests
from tidewheel.plans import testbed as tb
from tidewheel.schemas import TOPIC_RECORD
from tidewheel.sources.tables import Published
from tidewheel.sources.topic import kafka_options, stream_recorded
from tidewheel.streaming.batches import AuditStore, CleaningStore, clean_one
from tidewheel.streaming.queries import start_audits, start_cleaning, start_scoring

SETTINGS = Settings()


def send(spark, path, events):
    texts = [(None, e if isinstance(e, str) else json.dumps(e)) for e in events]
    frame = spark.createDataFrame(texts, "key string, value string").coalesce(1)
    record_messages(frame, path)


def clean(spark, topic, store, checkpoint, **options):
    query = start_cleaning(stream_recorded(spark, topic), store, SETTINGS, checkpoint, **options)
    query.awaitTermination()


def table_of(store):
    return sorted(
        (r.event_id, r.num_bikes_available, r.event_date) for r in store.observations.read().collect()
    )


def test_cleaning_stream(spark, tmp_path):
    topic, out, point = (str(tmp_path / n) for n in ("topic", "out", "cp"))
    docs = records_of(spark, quays())
    send(spark, topic, [*docs, docs[-1], "broken"])
    store = CleaningStore(spark, out)
    clean(spark, topic, store, point)
    first = table_of(store)
    assert [bikes for _, bikes, _ in sorted(first, key=lambda r: r[1])] == [3, 6, 9, 9]
    report = store.reports.read("json").first()
    assert report.quality.accepted_rows == 4 and report.quality.duplicate_rows == 1
    assert report.quality.quarantined_rows == 2
    assert report.plan.freshness_grace_seconds == 900 and report.attempts == 1
    assert report.profile.alias_candidates == 3 and report.table_version == 1
    assert [(o.start, o.end) for o in report.offsets] == [(0, 6)]
    assert (report.storage.format, report.storage.table, report.storage.version) == ("parquet", store.observations.path, 1)
    assert spark.read.json(report.storage.report).count() == 1
    assert store.quarantine.read("json").count() == 2
    assert store.accepted.read().count() == 4

    # New records only: the checkpoint remembers what was read.
    newer = snapshot(station("quay", age=-50, bikes=7), polled=POLLED)
    send(spark, topic, records_of(spark, newer))
    clean(spark, topic, store, point)
    assert len(table_of(store)) == 5 and store.observations.version() == 2

    # The same topic read again from the start changes nothing but versions.
    clean(spark, topic, store, str(tmp_path / "cp2"), name="again")
    assert len(table_of(store)) == 5
    assert {e for e, _, _ in first} <= {e for e, _, _ in table_of(store)}


def test_across_batches_the_last_write_wins(spark, tmp_path):
    topic, store = str(tmp_path / "topic"), CleaningStore(spark, str(tmp_path / "out"))
    for bikes in (3, 8):
        send(spark, topic, [event(status__num_bikes_available=bikes)])
        clean(spark, topic, store, str(tmp_path / "cp"))
    assert [bikes for _, bikes, _ in table_of(store)] == [8]


def test_failure_leaves_no_report_and_a_retry_completes(spark, tmp_path, monkeypatch):
    store = CleaningStore(spark, str(tmp_path / "out"))
    batch = spark.createDataFrame([(None, json.dumps(event()), 0, 5)], TOPIC_RECORD)

    def broken(*_):
        raise OSError("no space")

    with monkeypatch.context() as patch:
        patch.setattr(store.observations, "merge", broken)
        with pytest.raises(OSError):
            clean_one(batch, store, SETTINGS)
    assert not (tmp_path / "out" / "runs").exists()
    # Lost between the data write and the report: the batch is repeated in full.
    done = clean_one(batch, store, SETTINGS)
    assert store.reports.has(done) and store.observations.version() == 1
    assert clean_one(batch, store, SETTINGS) == done
    assert store.observations.version() == 1 and store.reports.read("json").count() == 1
    assert clean_one(batch.limit(0), store, SETTINGS) is None


def test_reports_without_accepted_or_quarantined_rows(spark, tmp_path):
    """The numbers that the writes observe, also where a write has no rows."""
    store = CleaningStore(spark, str(tmp_path / "out"))
    good, bad = (None, json.dumps(event()), 0, 5), (None, "broken", 0, 6)
    for k, rows in enumerate(([bad], [good], [good, good[:3] + (7,)], [bad, good])):
        batch = spark.createDataFrame([r[:3] + (r[3] + 10 * k,) for r in rows], TOPIC_RECORD)
        done = clean_one(batch, store, SETTINGS)
        quality = store.reports.read("json").where(f"batch_id = '{done}'").first().quality
        passed = sum(r[1] != "broken" for r in rows)
        assert (quality.input_rows, quality.quarantined_rows) == (len(rows), len(rows) - passed)
        assert quality.accepted_rows == min(passed, 1) and quality.duplicate_rows == max(passed - 1, 0)
        assert [w for w in quality.warnings if w.startswith("No usable")] == ([] if passed else [cleaning.WARN_EMPTY])


def test_observed_report_equals_the_aggregate(spark, sf_dir):
    judged = cleaning.evaluate(tb.records(spark, sf_dir), Policy(True, 900), 900).persist()
    taken, refused = Observation(), Observation()
    for df in (cleaning.accepted_rows(judged, counted=taken), cleaning.quarantined_rows(judged, counted=refused)):
        df.write.format("noop").mode("overwrite").save()
    got = cleaning.observed_report(judged.count(), taken.get, refused.get)
    assert got == cleaning.quality_report(judged).first().asDict()
    assert got["grace_accepted_rows"] > 0 and got["duplicate_rows"] > 0
    judged.unpersist()


def test_repeats_are_dropped_in_the_stream_across_a_restart(spark, tmp_path):
    topic, point, store = str(tmp_path / "topic"), str(tmp_path / "cp"), CleaningStore(spark, str(tmp_path / "out"))
    first, second = event(), event(station_id="other", event_id="e-other")
    send(spark, topic, [first, "broken"])
    clean(spark, topic, store, point, repeats_within="1 hour")
    send(spark, topic, [first, second, "broken"])  # a new query: the ids are remembered
    clean(spark, topic, store, point, repeats_within="1 hour")
    reports = sorted((r.quality.input_rows, r.quality.accepted_rows, r.quality.quarantined_rows) for r in store.reports.read("json").collect())
    assert reports == [(2, 1, 1), (2, 1, 1)]
    assert len(table_of(store)) == 2


def test_planner_failures(spark, tmp_path):
    store = CleaningStore(spark, str(tmp_path / "out"))
    batch = spark.createDataFrame([(None, json.dumps(event()), 0, 0)], TOPIC_RECORD)
    calls = []

    def stubborn(profile, issues):
        calls.append(profile["rows"])
        return Policy(True, 900)

    with pytest.raises(PolicyExhausted):
        clean_one(batch, store, SETTINGS, stubborn)
    assert calls == [1, 1, 1] and not (tmp_path / "out" / "runs").exists()

    def failing(profile, issues):
        raise ConnectionError("planner is down")

    with pytest.raises(ConnectionError):
        clean_one(batch, store, SETTINGS, failing)
    assert store.observations.version() is None


def test_audit_stream(spark, tmp_path):
    topic, store = str(tmp_path / "topic"), AuditStore(spark, str(tmp_path / "out"))
    later = {**AUDIT_MESSAGE, "predicted_available_bikes_15m": 6}
    other = {**AUDIT_MESSAGE, "event_id": "r2"}
    send(spark, topic, [AUDIT_MESSAGE, later, other, {**other, "unknown": 1}, "broken"])
    query = start_audits(stream_recorded(spark, topic), store, SETTINGS, str(tmp_path / "cp"))
    query.awaitTermination()
    rows = {r.event_id: r.predicted_available_bikes_15m for r in store.audits.read().collect()}
    assert rows == {"r1": 6, "r2": 4}
    report = store.reports.read("json").first()
    assert (report.accepted, report.quarantined, report.table_version) == (3, 2, 1)
    assert store.quarantine.read("json").count() == 2

    send(spark, topic, [later])
    start_audits(stream_recorded(spark, topic), store, SETTINGS, str(tmp_path / "cp")).awaitTermination()
    assert store.audits.read().count() == 2 and store.audits.version() == 2


def test_features_refreshed_in_the_middle_of_a_stream(spark, tmp_path):
    """Requests are scored with the features that are published when their batch runs."""
    latest = Published(spark, str(tmp_path / "latest"))

    def publish(bikes):
        rows = spark.createDataFrame(
            [("s1", 1_772_000_100, 6, 2, bikes, 14 - bikes, 14, bikes / 14)],
            "station_id string, feature_observed_at bigint, hour_utc bigint, day_of_week bigint,"
            " available_bikes bigint, available_docks bigint, capacity bigint, availability_ratio double",
        )
        latest.publish(latest.write(rows))

    asked = "request_id string, station_id string, served_at timestamp"
    incoming, topic = str(tmp_path / "in"), str(tmp_path / "topic")
    for number in (1, 2, 3):
        spark.sql(
            f"SELECT * FROM VALUES ('q{number}', 's1', timestamp'2026-02-25 06:16:05Z'),"
            f" ('x{number}', 'nowhere', timestamp'2026-02-25 06:16:05Z') AS t(request_id, station_id, served_at)"
        ).coalesce(1).write.mode("append").json(incoming)
    publish(9)
    batches = []

    def score(batch):
        found = score_requests(
            batch, latest.read(), lambda df: df.selectExpr("*", "available_bikes + 0.6D AS raw_prediction"), SETTINGS, "3"
        )
        return found

    def send(messages):
        record_messages(messages, topic)
        batches.append(latest.version())
        if len(batches) == 2:
            publish(3)

    stream = spark.readStream.schema(asked).option("maxFilesPerTrigger", 1).json(incoming)
    start_scoring(stream, score, send, str(tmp_path / "cp")).awaitTermination()
    assert batches == [1, 1, 2]

    store = AuditStore(spark, str(tmp_path / "out"))
    start_audits(stream_recorded(spark, topic), store, SETTINGS, str(tmp_path / "cp2")).awaitTermination()
    rows = store.audits.read().selectExpr("*", "unix_seconds(target_at) AS due").collect()
    assert sorted(r.predicted_available_bikes_15m for r in rows) == [4, 10, 10]
    assert {(r.due, r.event_date) for r in rows} == {(1_772_000_100 + 900, "2026-02-25")}


def test_kafka_batches_close_on_size_or_time():
    settings = Settings(batch_size=7, batch_timeout_seconds=2.5)
    ending = kafka_options(settings, "t")
    assert ending["maxOffsetsPerTrigger"] == "7" and "minOffsetsPerTrigger" not in ending
    assert "minPartitions" not in ending and kafka_options(Settings(source_partitions=24), "t")["minPartitions"] == "24"
    options = kafka_options(settings, "t", endless=True)
    assert options["minOffsetsPerTrigger"] == options["maxOffsetsPerTrigger"] == "7"
    assert (options["maxTriggerDelay"], options["startingOffsets"]) == ("2.5s", "earliest")
