from __future__ import annotations

import shutil
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidewheel.config import Settings
from tidewheel.functions import clock
from tidewheel.operators import drift, monitoring
from tidewheel.operators.upsert import keep_last, upsert
from tidewheel.plans import testbed as tb
from tidewheel.schemas import AUDIT
from tidewheel.sources import tables
from tidewheel.sources.reference import ReferenceStore
from tidewheel.sources.tables import BatchLog, CatalogTable, DatedTable, Published, keyed_table
from tidewheel.streaming.batches import audit_table

SCHEMA = "event_id string, value bigint"


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def content(df):
    return sorted((r.event_id, r.value) for r in df.collect())


def test_upsert_replaces_and_adds(spark):
    merged = upsert(rows(spark, ("a", 1), ("b", 1)), rows(spark, ("b", 2), ("c", 2)), ["event_id"])
    assert content(merged) == [("a", 1), ("b", 2), ("c", 2)]


def test_upsert_fills_new_columns(spark):
    target = spark.createDataFrame([("a",)], "event_id string")
    merged = upsert(target, rows(spark, ("b", 2)), ["event_id"])
    assert content(merged) == [("a", None), ("b", 2)]


def test_keep_last(spark):
    frame = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 5, 1)], "event_id string, value bigint, o int")
    assert content(keep_last(frame, ["event_id"], ["o"])) == [("a", 2), ("b", 5)]


def dated(spark, *triples):
    return spark.createDataFrame(list(triples), f"{SCHEMA}, event_date string")


def test_dated_table_is_idempotent_and_updating(spark, tmp_path):
    table = DatedTable(spark, str(tmp_path / "t"), ["event_id"])
    assert table.version() is None
    assert table.merge(rows(spark), "empty") is None
    assert table.merge(rows(spark, ("one", 1)), "b1") == 1
    assert table.merge(rows(spark, ("one", 1)), "b1") == 1
    assert content(table.read()) == [("one", 1)]
    assert table.merge(rows(spark, ("one", 2), ("two", 1)), "b2") == 2
    assert table.merge(rows(spark), "empty") == 2
    assert content(table.read()) == [("one", 2), ("two", 1)]
    # An old batch that is delivered again does not win over newer ones.
    assert table.merge(rows(spark, ("one", 1)), "b1") == 1
    assert content(table.read()) == [("one", 2), ("two", 1)]


def test_only_touched_dates_are_written(spark, tmp_path):
    table = DatedTable(spark, str(tmp_path / "t"), ["event_id"], schema=dated(spark).schema)
    assert table.read().count() == 0
    table.merge(dated(spark, ("a", 1, "2026-01-01"), ("b", 1, "2026-01-02")), "b1")
    before = sorted(p.name for p in (tmp_path / "t" / "event_date=2026-01-01").iterdir())
    table.merge(dated(spark, ("b", 9, "2026-01-02"), ("c", 1, "2026-01-03")), "b2")
    assert sorted(p.name for p in (tmp_path / "t" / "event_date=2026-01-01").iterdir()) == before
    assert content(table.read()) == [("a", 1), ("b", 9), ("c", 1)]
    days = [p for p in (tmp_path / "t").iterdir() if p.name.startswith("event_date=")]
    assert all(len(list(d.glob("*.parquet"))) == 1 for d in days)
    plan = table.read().where("event_date = '2026-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "event_date#" in plan


def test_interrupted_merges_are_finished_or_dropped(spark, tmp_path, monkeypatch):
    table = DatedTable(spark, str(tmp_path / "t"), ["event_id"], schema=dated(spark).schema)
    table.merge(dated(spark, ("a", 1, "2026-01-01"), ("b", 1, "2026-01-01")), "b1")

    def lost(*_):
        raise OSError("driver lost")

    # The new content lies aside, the dates may be half replaced: the next merge finishes it.
    with monkeypatch.context() as patch:
        patch.setattr(table, "_apply", lost)
        with pytest.raises(OSError):
            table.merge(dated(spark, ("a", 2, "2026-01-01")), "b2")
    shutil.rmtree(tmp_path / "t" / "event_date=2026-01-01")
    assert table.merge(dated(spark, ("c", 3, "2026-01-02")), "b3") == 3
    assert content(table.read()) == [("a", 2), ("b", 1), ("c", 3)]
    assert table.merge(dated(spark, ("a", 2, "2026-01-01")), "b2") == 2
    # Not even the copy aside was finished: it is dropped.
    aside = tmp_path / "t" / "_merges" / "b4"
    dated(spark, ("a", 7, "2026-01-01")).write.parquet(str(aside))
    (aside / "_SUCCESS").unlink()
    assert table.merge(dated(spark, ("d", 4, "2026-01-02")), "b5") == 4
    assert content(table.read()) == [("a", 2), ("b", 1), ("c", 3), ("d", 4)] and not aside.exists()


def test_catalogue_tables_are_changed_by_the_engine(spark, tmp_path):
    table = keyed_table(spark, "lake.observations", ["event_id"], fmt="delta")
    assert isinstance(table, CatalogTable)
    text = table.merge_statement("batch")
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text).toString()
    assert "MergeIntoTable" in plan and "event_date" in plan and "updatestaraction" in plan
    # plain Parquet tables of the catalogue do not take it, and say so
    name = "plain_merge_target"
    dated(spark, ("a", 1, "2026-01-01")).write.option("path", str(tmp_path / "p")).saveAsTable(name)
    try:
        with pytest.raises(Exception, match="MERGE|merge"):
            keyed_table(spark, name, ["event_id"], fmt="parquet-catalogue").merge(
                dated(spark, ("a", 2, "2026-01-01")), "b1"
            )
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_published_versions(spark, tmp_path):
    place = Published(spark, str(tmp_path / "p"), keep=2)
    assert place.version() is None
    with pytest.raises(FileNotFoundError):
        place.read()
    first = place.write(rows(spark, ("a", 1)))
    assert place.version() is None and place.publish(first) == 1
    held = place.read()
    second = place.write(rows(spark, ("a", 2)))
    assert content(place.read()) == [("a", 1)]  # written, not published
    place.publish(second)
    assert content(place.read()) == [("a", 2)] and content(held) == [("a", 1)]
    place.publish(place.write(rows(spark, ("a", 3))))
    assert not (tmp_path / "p" / "version=000000000001").exists() and content(place.read(2)) == [("a", 2)]
    with pytest.raises(FileNotFoundError):
        place.publish(9)


def test_inspection(spark, tmp_path):
    full = DatedTable(spark, str(tmp_path / "x"), ["event_id"])
    full.merge(rows(spark, ("a", 1), ("b", 1)), "b1")
    found = tables.inspect_tables({"x": full, "y": DatedTable(spark, str(tmp_path / "y"), ["k"])})
    assert found == [
        {"table": "x", "uri": str(tmp_path / "x"), "version": 1, "rows": 2},
        {"table": "y", "uri": str(tmp_path / "y"), "status": "missing"},
    ]


def test_missing_table_reads_empty(spark, tmp_path):
    schema = rows(spark).schema
    assert tables.read_or_empty(spark, str(tmp_path / "no"), schema).columns == ["event_id", "value"]
    rows(spark, ("a", 1)).write.parquet(str(tmp_path / "yes"))
    assert tables.read_or_empty(spark, str(tmp_path / "yes"), schema).count() == 1


def test_batch_log_rewrites_only_its_batch(spark, tmp_path):
    log = BatchLog(spark, str(tmp_path / "log"))
    assert not log.has("b1")
    log.write(rows(spark, ("a", 1)), "b1")
    log.write(rows(spark, ("b", 1)), "b2")
    log.write(rows(spark, ("a", 2)), "b1")
    assert log.has("b1")
    assert sorted((r.batch_id, r.value) for r in log.read().collect()) == [("b1", 2), ("b2", 1)]


def test_training_input(spark, tmp_path):
    rows(spark, ("a", 1)).write.parquet(str(tmp_path / "s"))
    table = DatedTable(spark, str(tmp_path / "c"), ["event_id"])
    table.merge(rows(spark, ("b", 1)), "b1")
    paths = {"synthetic": str(tmp_path / "s"), "collected": str(tmp_path / "c")}
    assert tables.training_input(spark, Settings(), paths).first().event_id == "a"
    collected = Settings(training_source="collected")
    assert tables.training_input(spark, collected, paths).first().event_id == "b"
    with pytest.raises(ValueError):
        Settings(training_source="other")


def test_windows_reach_the_scans_as_partition_filters(spark, tmp_path, sf_dir):
    """Audits, observations and history: only the folders of the window's days are listed."""
    start, end = (datetime(2024, 1, d, 5, tzinfo=timezone.utc) for d in (10, 11))
    audits = audit_table(spark, str(tmp_path / "audits"))
    audits.merge(tb.audits(spark, sf_dir).select(*AUDIT.fieldNames()), "b1")
    seen = keyed_table(spark, str(tmp_path / "seen"), ["event_id"], dated=clock.iso_date(F.col("last_reported")))
    seen.merge(tb.actuals(spark, sf_dir), "b1")
    place = Published(spark, str(tmp_path / "h"))
    place.publish(tables.write_history(tb.features(spark, sf_dir), place))
    for found, want in (
        (monitoring.select_window(audits.read(), start, end, "3"), monitoring.select_window(tb.audits(spark, sf_dir), start, end, "3")),
        (monitoring.observed_between(seen.read(), start, end), monitoring.observed_between(tb.actuals(spark, sf_dir), start, end)),
        (tables.read_history(spark, place, start, end), tb.features(spark, sf_dir).where("date(event_timestamp) between '2024-01-10' and '2024-01-11'")),
    ):
        spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
        plan = found._jdf.queryExecution().executedPlan().toString()
        spark.conf.unset("spark.sql.maxMetadataStringLength")
        filters = plan[plan.index("PartitionFilters: [") :].split("]")[0]
        assert "event_date" in filters and "2024-01-10" in filters and "2024-01-11" in filters
        assert found.count() == want.count() > 0


def test_reference_counts_only_changed_days(spark, tmp_path, sf_dir):
    store = ReferenceStore(spark, str(tmp_path / "r"))
    with pytest.raises(LookupError):
        store.state("3")
    rows = tb.features(spark, sf_dir).withColumn("event_date", clock.iso_date(F.col("feature_observed_at"))).persist()
    days = rows.select("event_date").distinct().count()
    assert store.refresh(rows, 1, tb.formula_prediction, "3") == days
    assert store.refresh(rows, 1, tb.formula_prediction, "3") == 0
    # one day changes, one goes
    last, first = (r[0] for r in rows.agg(F.max("event_date"), F.min("event_date")).select(F.explode(F.array("max(event_date)", "min(event_date)"))).collect())
    newer = rows.where(F.col("event_date") != first).withColumn("available_bikes", F.when(F.col("event_date") == last, 0).otherwise(F.col("available_bikes")))
    asked = []

    def predict(df):
        asked.append(sorted(r[0] for r in df.select("event_date").distinct().collect()))
        return tb.formula_prediction(df)

    assert store.refresh(newer, 2, predict, "3") == 1 and asked == [[last]]
    from_store = {r.feature: r.psi for r in drift.psi_from_state(store.state("3"), tb.audits(spark, sf_dir), monitoring.DRIFT_COLUMNS).collect()}
    counts = drift.value_counts(tb.formula_prediction(newer), tb.audits(spark, sf_dir), monitoring.DRIFT_COLUMNS)
    direct = {r.feature: r.psi for r in drift.psi(counts.persist(), monitoring.DRIFT_COLUMNS).collect()}
    assert from_store == pytest.approx(direct)
    rows.unpersist()


def test_settings_bounds_and_environment():
    got = Settings.from_env(environ={"TIDEWHEEL_STALE_SECONDS": "60", "TIDEWHEEL_MONITORING_PSI_WARNING": "0.2"})
    assert (got.stale_seconds, got.monitoring_psi_warning) == (60, 0.2)
    for bad in ({"repair_limit": 3}, {"batch_size": 0}, {"monitoring_min_label_coverage": 1.1}):
        with pytest.raises(ValueError):
            Settings(**bad)
