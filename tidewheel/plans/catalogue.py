"""One query per operator over the benchmark tables, each reading the whole table it uses.

Times leave as epoch seconds and doubles rounded, so that results compare across engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewheel.config import Settings
from tidewheel.functions import clock, json_values as jv
from tidewheel.functions.numeric import bounded_count
from tidewheel.operators import (
    asof,
    checks,
    cleaning,
    drift,
    features,
    modeling,
    monitoring,
    profiling,
    snapshots,
    upsert as merging,
    validation,
)
from tidewheel.operators.profiling import Policy
from tidewheel.plans import testbed as tb
from tidewheel.schemas import FEATURE_COLUMNS, OBSERVATION_RULES, TARGET_COLUMN
from tidewheel.session import checkpointed, shared_folder
from tidewheel.sources import snapshots as landing, tables, topic
from tidewheel.sources.reference import ReferenceStore

Query = Callable[[SparkSession, str], DataFrame]

SETTINGS = Settings()
POLICY = Policy(True, 900)
STALE = SETTINGS.stale_seconds
# The window of the monitoring queries spans the whole table.
WINDOW_START, WINDOW_END = 1_703_980_800, 1_707_868_800
DRIFT_CUT = 1_705_363_200  # 2024-01-16: history before it is the reference side
UPSERT_FROM, UPSERT_TO = 1_704_931_200, 1_705_795_200
CHAMPION = "3"


def _rounded(column: str | Column, name: str | None = None, digits: int = 6) -> Column:
    source = F.col(column) if isinstance(column, str) else column
    return F.round(source.cast("double"), digits).alias(name or column)


def _flag(column: Column, name: str) -> Column:
    return column.cast("int").alias(name)


# -- cleaning ---------------------------------------------------------------------------------


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.profile_batch(tb.records(spark, sf_dir), STALE)


def profile_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of which one in 19 has no details, one in 23 no station and one in 29 no status."""
    n = F.col("n")
    lost = {"metadata": n % 19 == 0, "station_id": n % 23 == 0, "status": n % 29 == 0}

    def kept(name: Column, _: Column) -> Column:
        gone = F.lit(False)
        for field, where in lost.items():
            gone = gone | ((name == field) & where)
        return ~gone

    whole = F.try_variant_get("record", "$", "map<string,variant>")
    records = tb.records(spark, sf_dir).withColumn("record", F.to_variant_object(F.map_filter(whole, kept)))
    missing = [
        F.element_at("missing_fields", F.lit(k)).alias(f"missing_{k}")
        for k in profiling.PROFILED_FIELDS
    ]
    return profiling.profile_batch(records, STALE).select("*", *missing).drop("missing_fields")


def distinct_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations and events per UTC day from one sketch per batch, merged: whether each estimate is within three
    standard errors of the exact count."""
    day = clock.iso_date(F.col("ingested_at"))
    rows = tb.envelope(spark, sf_dir).select(day.alias("event_date"), (F.col("n") % 24).alias("batch"), "station_id", "event_id")
    sketches = profiling.distinct_sketches(rows, ["station_id", "event_id"], ["event_date", "batch"])
    merged = profiling.merged_distinct(checkpointed(sketches), ["event_date"])
    exact = rows.groupBy("event_date").agg(*[F.count_distinct(c).alias(c) for c in ("station_id", "event_id")])
    exact = exact.unpivot(["event_date"], ["station_id", "event_id"], "field", "exact")
    near = F.abs(F.col("estimate") - F.col("exact")) <= F.greatest(F.lit(1.0), 3 * profiling.SKETCH_ERROR * F.col("exact"))
    return exact.join(merged, ["event_date", "field"]).select("event_date", "field", "exact", _flag(near, "near"))


def freshness_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.freshness_bands(tb.records(spark, sf_dir), STALE)


def plan_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    policies = F.array(
        *[
            F.struct(F.lit(alias).alias("alias"), F.lit(grace).alias("grace"))
            for alias in (False, True)
            for grace in (0, 900)
        ]
    )
    asked = _profile(spark, sf_dir).select("*", F.inline(policies))
    judged = profiling.policy_issues(asked, F.col("alias"), F.col("grace"))
    return judged.select(
        _flag(F.col("alias"), "alias"), "grace", F.array_join("issues", "; ").alias("issues")
    )


def choose_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = profiling.choose_policy(_profile(spark, sf_dir))
    allowed = _flag(F.col("allow_bikes_available_alias"), "allow_bikes_available_alias")
    return chosen.select(allowed, "freshness_grace_seconds", "rationale")


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.evaluate(tb.records(spark, sf_dir), POLICY, STALE)


def _tagged(judged: DataFrame, *columns: str) -> DataFrame:
    """Tag outcomes from a stored copy: the tagging reads its input twice, and judging a record
    costs more than storing the few columns needed."""
    needed = ["event_id", "arrival", "reason", *columns]
    return cleaning.tag_outcomes(checkpointed(judged.select(*dict.fromkeys(needed))))


def clean_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = ["n", "replay", "station_id", "num_bikes_available", "capacity"]
    return _tagged(_judged(spark, sf_dir), *kept, "used_alias", "used_grace").select(
        "n",
        "replay",
        "station_id",
        "num_bikes_available",
        "capacity",
        _flag(F.col("used_alias"), "used_alias"),
        _flag(F.col("used_grace"), "used_grace"),
        "reason",
        "outcome",
    )


def outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile, choose the policy from it, clean, and count what became of the records."""
    settled, _ = profiling.settle_policy(_profile(spark, sf_dir).first())
    judged = cleaning.evaluate(tb.records(spark, sf_dir), settled, STALE)
    return (
        _tagged(judged, "used_alias")
        .groupBy("outcome", "reason")
        .agg(F.count(F.lit(1)).alias("rows"), F.count_if("used_alias").alias("with_alias"))
    )


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = cleaning.quarantined_rows(_judged(spark, sf_dir))
    return rejected.select(
        F.get_json_object("record", "$.event_id").alias("event_id"),
        F.get_json_object("record", "$.station_id").alias("station_id"),
        "reason",
        F.size("problems").alias("problems"),
    )


def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    passed = _judged(spark, sf_dir).where("reason IS NULL")
    return cleaning.keep_first(passed, ["event_id"], ["arrival"]).select(
        "event_id", "arrival", "station_id", "num_bikes_available"
    )


def alias_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    lifted = cleaning.lift_fields(tb.records(spark, sf_dir), POLICY)
    return lifted.select(
        "n", "replay", "num_bikes_available", _flag(F.col("used_alias"), "used_alias")
    )


def lift_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    lifted = cleaning.lift_fields(tb.records(spark, sf_dir), Policy())
    return lifted.select("n", "replay", *[r.name for r in OBSERVATION_RULES])


def validate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lifted = cleaning.lift_fields(tb.records(spark, sf_dir), Policy())
    return lifted.select("n", "replay", F.array_join("problems", "; ").alias("problems"))


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = cleaning.quality_report(_judged(spark, sf_dir))
    return report.select(
        *[c for c in report.columns if c not in ("issues", "warnings", "repairable")],
        F.array_join("issues", "; ").alias("issues"),
        F.array_join("warnings", "; ").alias("warnings"),
        _flag(F.col("repairable"), "repairable"),
    )


def enrich_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = cleaning.accepted_rows(_judged(spark, sf_dir))
    return cleaning.enrich_rows(accepted, "batch-1").select(
        "event_id", "last_reported", "batch_id", "event_date"
    )


# -- ingest -----------------------------------------------------------------------------------


def flatten_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = snapshots.flatten_snapshot(tb.snapshots(spark, sf_dir))
    return flat.select(
        "event_id",
        "schema_version",
        "system_id",
        "station_id",
        "source_updated_at",
        "ingested_at",
        F.try_variant_get("status", "$.last_reported", "bigint").alias("last_reported"),
        F.try_variant_get("status", "$.num_docks_available", "bigint").alias("docks"),
        F.try_variant_get("metadata", "$.capacity", "bigint").alias("capacity"),
        F.try_variant_get("metadata", "$.name", "string").alias("name"),
    )


def event_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = snapshots.flatten_snapshot(tb.snapshots(spark, sf_dir))
    return flat.select("event_id", "station_id", "source_updated_at")


def raw_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land all snapshots twice, and look at what lies there."""
    place = f"{shared_folder(spark)}/landed-{uuid.uuid4().hex}"
    snapshots = checkpointed(tb.snapshots(spark, sf_dir))
    for _ in range(2):
        landing.land_snapshots(snapshots, place)
    return landing.read_landed(spark, place).groupBy("system_id", "event_date").agg(
        F.count("object_name").alias("objects"),
        F.min(F.split_part("object_name", F.lit("-"), F.lit(1))).alias("first_poll"),
    )


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events.props`` as messages: every 17th cut short, every 19th an array."""
    n, props = F.col("event_id"), F.col("props")
    value = (
        F.when(n % 17 == 0, F.substr(props, F.lit(1), F.length(props) - 2))
        .when(n % 19 == 0, F.concat(F.lit("["), props, F.lit("]")))
        .otherwise(props)
    )
    return tb.events(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("key"),
        value.alias("value"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        n.alias("offset"),
    )


def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = topic.decode(_messages(spark, sf_dir))
    return decoded.select(
        "offset",
        "partition",
        F.try_variant_get("record", "$.k", "bigint").alias("k"),
        F.try_variant_get("record", "$.raw", "string").alias("raw"),
        F.try_variant_get("record", "$.decode_error", "string").alias("decode_error"),
    )


def topic_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tb.records(spark, sf_dir).withColumn("station_id", jv.as_text(F.col("record"), "$.station_id"))
    body = F.col("value")
    return topic.topic_frame(rows).select(
        "key",
        F.get_json_object(body, "$.event_id").alias("event_id"),
        F.get_json_object(body, "$.status.last_reported").cast("bigint").alias("last_reported"),
        F.get_json_object(body, "$.metadata.name").alias("name"),
    )


def validate_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit messages with faults: an unknown key, a ratio above 1, a missing capacity."""
    rows = tb.audits(spark, sf_dir)
    slot = F.unix_seconds("feature_observed_at")
    tick = (slot / clock.QUARTER_HOUR).cast("bigint")
    body = {c: F.col(c) for c in rows.columns}
    for name in ("served_at", "feature_observed_at", "target_at"):
        body[name] = F.unix_seconds(name)
    body["availability_ratio"] = F.col("availability_ratio") + F.when(tick % 11 == 0, 1.5).otherwise(0.0)
    plain = F.struct(*[c.alias(k) for k, c in body.items()])
    marked = F.struct(*[c.alias(k) for k, c in body.items()], F.lit(1).alias("note"))
    text = F.when(tick % 23 == 0, F.to_json(marked)).otherwise(F.to_json(plain))
    checked = validation.validate_audits(
        rows.select(F.try_parse_json(text).alias("record"), slot.alias("slot"))
    )
    return checked.select(
        "station_id",
        "slot",
        F.unix_seconds("target_at").alias("target_at"),
        "predicted_available_bikes_15m",
        "error",
    )


# -- tables -----------------------------------------------------------------------------------


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = tb.history_rows(spark, sf_dir).select(
        "station_id", "last_reported", "num_bikes_available"
    )
    target = rows.where(F.col("last_reported") < UPSERT_TO)
    source = rows.where(F.col("last_reported") >= UPSERT_FROM).withColumn(
        "num_bikes_available", F.col("num_bikes_available") + 100
    )
    return target, source


def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merging.upsert(*_halves(spark, sf_dir), ["station_id", "last_reported"])


def inspect_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge both halves into a table in the shared folder, and look at it."""
    root = f"{shared_folder(spark)}/inspect-{uuid.uuid4().hex}"
    keys = ["station_id", "last_reported"]
    observed = tables.keyed_table(spark, f"{root}/observations", keys, dated=clock.iso_date(F.col("last_reported")))
    for number, half in enumerate(_halves(spark, sf_dir), start=1):
        observed.merge(half, f"half-{number}")
    audits = tables.keyed_table(spark, f"{root}/prediction_audits", ["event_id"])
    found = tables.inspect_tables({"observations": observed, "prediction_audits": audits})
    return spark.createDataFrame(
        [(f["table"], f.get("version"), f.get("rows"), f.get("status")) for f in found],
        "name string, version bigint, rows bigint, status string",
    )


# -- features ---------------------------------------------------------------------------------


def stage_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.staged(spark, sf_dir).select(
        "station_id",
        F.unix_seconds("event_timestamp").alias("event_epoch"),
        "available_bikes",
        "available_docks",
        "capacity",
        "source_name",
    )


def _history_out(df: DataFrame) -> DataFrame:
    return df.select(
        "station_id",
        "feature_observed_at",
        "hour_utc",
        "day_of_week",
        "available_bikes",
        "available_docks",
        "capacity",
        _rounded("availability_ratio"),
        TARGET_COLUMN,
        "source_name",
    )


def feature_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history_out(tb.history(spark, sf_dir))


def sort_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.sort_history(tb.history_rows(spark, sf_dir))


def dedup_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tb.events(spark, sf_dir).select(
        F.concat(F.lit("st-"), (F.col("user_id") % 5).cast("string")).alias("station_id"),
        clock.floor_to(F.col("ep"), clock.QUARTER_HOUR).alias("last_reported"),
        F.col("ep").alias("source_updated_at"),
        "event_id",
    )
    return features.dedup_history(rows)


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots = tb.events(spark, sf_dir).select(
        (F.col("user_id") % 5).alias("station"),
        clock.floor_to(F.col("ep"), clock.QUARTER_HOUR).alias("slot"),
    )
    return checks.duplicate_keys(slots, ["station", "slot"])


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of both tables; one quarter hour in 97 lost its capacity."""
    staged = _flawed(tb.staged(spark, sf_dir), F.lit(None).cast("bigint"), 97)
    history = features.feature_history(staged)
    of_staged = checks.null_counts(staged, checks.NOT_NULL["staged"], "staged")
    return of_staged.unionByName(
        checks.null_counts(history, checks.NOT_NULL["history"], "history")
    )


def _flawed(staged: DataFrame, capacity: Column, every: int) -> DataFrame:
    """Staged rows with another capacity in one quarter hour of ``every``."""
    tick = F.floor(F.unix_seconds("event_timestamp") / clock.QUARTER_HOUR)
    return staged.withColumn("capacity", F.when(tick % every == 0, capacity).otherwise(F.col("capacity")))


def dq_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature rows of stations whose capacity is set to 25, so that some are over it."""
    tight = tb.features(spark, sf_dir).withColumn("capacity", F.lit(25).cast("bigint"))
    return checks.out_of_bounds(tight).select(
        "station_id", "feature_observed_at", "available_bikes", "available_docks"
    )


def test_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some quarter hours are staged twice, in others stations are smaller than their counts."""
    tight = _flawed(tb.staged(spark, sf_dir), F.lit(25).cast("bigint"), 41)
    tick = F.floor(F.unix_seconds("event_timestamp") / clock.QUARTER_HOUR)
    staged = tight.unionByName(tight.where(tick % 50 == 0))
    return checks.summarize(checks.run_checks(staged, features.feature_history(staged)))


def latest_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history_out(features.latest_features(tb.history(spark, sf_dir)))


def history_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.history_extent(tb.staged(spark, sf_dir)).select(
        F.unix_seconds("start_at").alias("start_at"), F.unix_seconds("end_at").alias("end_at")
    )


# -- joins ------------------------------------------------------------------------------------


def point_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = tb.actuals(spark, sf_dir).select(
        "event_id", "station_id", F.col("last_reported").alias("asked_at")
    )
    columns = ["feature_observed_at", "available_bikes", "hour_utc"]
    return asof.point_in_time(
        requests,
        tb.features(spark, sf_dir),
        columns,
        SETTINGS.feature_ttl_seconds,
        at="asked_at",
        observed="event_timestamp",
    )


def _labeled(spark: SparkSession, sf_dir: str, tolerance: int) -> DataFrame:
    return asof.nearest_asof(tb.audits(spark, sf_dir), tb.actuals(spark, sf_dir), tolerance)


def nearest_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labeled(spark, sf_dir, 600).select(
        "event_id", "station_id", "actual_at", "actual_available_bikes"
    )


# -- monitoring -------------------------------------------------------------------------------


def _selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = (F.timestamp_seconds(F.lit(t)) for t in (WINDOW_START, WINDOW_END))
    return monitoring.select_window(tb.audits(spark, sf_dir), start, end, CHAMPION)


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof.nearest_asof(
        _selected(spark, sf_dir),
        tb.actuals(spark, sf_dir),
        SETTINGS.monitoring_label_tolerance_seconds,
    )


def monitor_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selected(spark, sf_dir).select(
        "event_id", F.unix_seconds("served_at").alias("served_at"), "model_version"
    )


def validity_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = monitoring.flag_rows(_selected(spark, sf_dir), STALE)
    return flagged.select(
        "event_id",
        _flag(F.col("invalid_features"), "invalid_features"),
        _flag(F.col("stale_features"), "stale_features"),
    )


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = monitoring.flag_rows(_joined(spark, sf_dir), STALE)
    return monitoring.window_metrics(flagged, training_test_mae=2.5)


def monitor_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = _metrics(spark, sf_dir)
    return metrics.select(*[_rounded(c) for c in metrics.columns])


def error_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = monitoring.error_metrics(_joined(spark, sf_dir))
    return errors.select(*[_rounded(c) for c in errors.columns])


def station_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_station = monitoring.station_breakdown(_joined(spark, sf_dir))
    return per_station.select("station_id", "samples", _rounded("mae"))


def _reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.formula_prediction(tb.features(spark, sf_dir))


def _stored_reference(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """The state of a reference from a store: counted by day, folded, and read back."""
    store = ReferenceStore(spark, f"{shared_folder(spark)}/reference-{uuid.uuid4().hex}")
    dated = rows.withColumn(tables.DAY, clock.iso_date(F.col("feature_observed_at")))
    store.refresh(dated, 1, lambda df: df, CHAMPION)
    return store.state(CHAMPION)


def psi(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _reference(spark, sf_dir)
    before = F.col("feature_observed_at") < DRIFT_CUT
    state = _stored_reference(spark, rows.where(before))
    scores = drift.psi_from_state(state, rows.where(~before), monitoring.DRIFT_COLUMNS)
    return scores.select("feature", _rounded("psi"))


def monitor_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = checkpointed(monitoring.flag_rows(_joined(spark, sf_dir), STALE))
    state = _stored_reference(spark, _reference(spark, sf_dir))
    table = monitoring.metric_table(
        monitoring.window_metrics(flagged, training_test_mae=2.5),
        drift.psi_from_state(state, flagged, monitoring.DRIFT_COLUMNS),
    )
    return monitoring.decide(table, SETTINGS).select(
        "status",
        F.array_join("warnings", "; ").alias("warnings"),
        F.array_join("failures", "; ").alias("failures"),
        F.size("metrics").alias("metrics"),
    )


def _champions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All labelled audits of the champion, stored once: windows, hours and drift each read them."""
    labeled = _labeled(spark, sf_dir, SETTINGS.monitoring_label_tolerance_seconds)
    return checkpointed(monitoring.flag_rows(labeled.where(F.col("model_version") == CHAMPION), STALE))


def monitor_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = monitoring.backfill_metrics(_champions(spark, sf_dir), SETTINGS.monitoring_window_hours)
    return runs.select(
        "window_end", *[_rounded(c) for c in runs.columns if c != "window_end"]
    )


def backfill_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = _champions(spark, sf_dir)
    state = _stored_reference(spark, _reference(spark, sf_dir))
    verdicts = monitoring.backfill_decisions(flagged, state, SETTINGS)
    return verdicts.select(
        "window_end",
        "status",
        F.array_join("warnings", "; ").alias("warnings"),
        F.array_join("failures", "; ").alias("failures"),
        _rounded(F.element_at("metrics", F.lit("psi_prediction")), "psi_prediction"),
    )


# -- models -----------------------------------------------------------------------------------


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modeling.chrono_split(tb.features(spark, sf_dir))


def chrono_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir).select("station_id", "feature_observed_at", "split")


def _training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    labeled = tb.history(spark, sf_dir).where(F.col(TARGET_COLUMN).isNotNull())
    return modeling.require_complete(labeled)


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = tb.formula_prediction(modeling.chrono_split(_training_set(spark, sf_dir)))
    return modeling.regression_scores(scored)


def regression_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = _scores(spark, sf_dir)
    return scores.select(
        "split", "samples", *[_rounded(c) for c in ("mae", "rmse", "r2", "baseline_mae")]
    )


def promotion_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    gate = modeling.promotion_gate(_scores(spark, sf_dir))
    return gate.select(
        *[_rounded(c) for c in gate.columns if c != "promoted"],
        _flag(F.col("promoted"), "promoted"),
    )


def champion_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry tables with one model version per station; the one with the least error is
    champion, the newest is candidate."""
    error = F.avg(F.abs(F.col("available_bikes") - 15))
    versions = (
        tb.features(spark, sf_dir)
        .groupBy("station_id")
        .agg(error.alias("mae"))
        .select(
            F.lit("bikes").alias("name"),
            (F.substr("station_id", F.lit(4)).cast("int") + 8).cast("string").alias("version"),
            F.concat(F.lit("run-"), (F.substr("station_id", F.lit(4)).cast("int") % 2).cast("string")).alias("run_id"),
            F.create_map(F.lit("test_mae"), "mae").alias("metrics"),
        )
    )
    least = F.min_by("version", F.struct(F.element_at("metrics", F.lit("test_mae")), "version"))
    champion = versions.groupBy("name").agg(least.alias("version"))
    newest = modeling.newest_version(versions, "run-0").withColumn("name", F.lit("bikes"))
    aliases = champion.withColumn("alias", F.lit("champion")).unionByName(
        newest.withColumn("alias", F.lit("candidate"))
    )
    found = [
        modeling.champion_lookup(versions, aliases, "bikes", alias)
        for alias in ("champion", "candidate")
    ]
    return found[0].unionByName(found[1]).select(
        "name", "alias", "version", "run_id", _rounded("training_test_mae")
    )


def score_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request per event. Two of seven stations have no features."""
    requests = tb.events(spark, sf_dir).select(
        F.concat(F.lit("req-"), F.col("event_id").cast("string")).alias("request_id"),
        F.concat(F.lit("st-"), (F.col("user_id") % 7).cast("string")).alias("station_id"),
        F.timestamp_seconds("ep").alias("served_at"),
    )
    latest = features.latest_features(tb.features(spark, sf_dir))
    scored = modeling.score_requests(requests, latest, tb.formula_prediction, SETTINGS, CHAMPION)
    return scored.select(
        "request_id",
        "station_id",
        F.unix_seconds("target_at").alias("target_at"),
        _rounded("raw_prediction"),
        "predicted_available_bikes_15m",
        *FEATURE_COLUMNS[:5],
        _flag(F.col("found"), "found"),
    )


def fit_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit on the training split and score the other two: whether the bounded predictions lie in
    their range, and whether the error beats that of forecasting no change."""
    split = modeling.chrono_split(checkpointed(_training_set(spark, sf_dir)))
    model = modeling.fit_model(checkpointed(split.where("split = 'train'")))
    scored = checkpointed(modeling.predict(model, split.where("split <> 'train'")))
    bounded = bounded_count(F.col("raw_prediction"), F.col("capacity"))
    ranges = scored.groupBy("split").agg(_flag(F.bool_and(bounded.between(0, F.col("capacity"))), "in_range"))
    scores = modeling.regression_scores(scored).join(ranges, "split")
    better = F.col("mae") < F.col("baseline_mae")
    return scores.select("split", "samples", _rounded("baseline_mae"), "in_range", _flag(better, "beats_baseline"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        profile_batch,
        distinct_estimate,
        freshness_bands,
        plan_issues,
        choose_plan,
        clean_batch,
        outcome_counts,
        quarantine,
        dedup_first,
        alias_resolve,
        lift_fields,
        validate_rows,
        quality_report,
        enrich_rows,
        flatten_snapshot,
        event_digest,
        raw_landing,
        json_decode,
        topic_frame,
        validate_audit,
        upsert,
        inspect_lake,
        stage_observations,
        feature_history,
        sort_history,
        dedup_history,
        dq_unique,
        dq_not_null,
        dq_bounds,
        test_summary,
        latest_features,
        history_extent,
        point_in_time,
        nearest_asof,
        monitor_select,
        validity_flags,
        monitor_metrics,
        error_metrics,
        station_breakdown,
        psi,
        monitor_decision,
        monitor_backfill,
        backfill_decisions,
        chrono_split,
        regression_scores,
        promotion_gate,
        champion_lookup,
        score_requests,
        fit_model,
    )
}
