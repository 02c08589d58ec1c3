"""Quality of served predictions: window selection, flags, metrics, verdict."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F

from tidewheel.config import Settings
from tidewheel.functions import clock
from tidewheel.functions.numeric import ratio_or_zero
from tidewheel.operators import bounds, drift
from tidewheel.schemas import FEATURE_COLUMNS

# Messages other systems may match on.
FAIL_INVALID = "Production feature rows violated model input constraints"
FAIL_BASELINE = "Production MAE no longer beats the persistence baseline"
WARN_COVERAGE = "Delayed-label coverage is below the configured minimum"
WARN_STALE = "Some predictions used stale online features"
WARN_FEW_LABELS = "Not enough delayed labels to evaluate production model quality"
OVER_FAILURE = "{} exceeded the failure threshold"
OVER_WARNING = "{} exceeded the warning threshold"

DRIFT_COLUMNS = (*FEATURE_COLUMNS, "raw_prediction")
_DRIFT_METRICS = {c: f"psi_{c}" for c in FEATURE_COLUMNS} | {"raw_prediction": "psi_prediction"}
_MICROS = 1_000_000


def select_window(
    audits: DataFrame, start: datetime | Column, end: datetime | Column, model_version: str
) -> DataFrame:
    """Predictions of one model version served in ``[start, end)`` whose target has passed.

    The predicates stay on plain columns, so they reach the Parquet scan; in a table by date
    (``event_date``, of the serving time) the days of the window are its partition filter.
    """
    if "event_date" in audits.columns and not isinstance(start, Column):
        audits = within_days(audits, start, end)
    start, end = (c if isinstance(c, Column) else F.lit(c) for c in (start, end))
    return audits.where(
        (F.col("served_at") >= start)
        & (F.col("served_at") < end)
        & (F.col("target_at") <= end)
        & (F.col("model_version") == F.lit(str(model_version)))
    )


def within_days(df: DataFrame, low: datetime, high: datetime, day: str = "event_date") -> DataFrame:
    """Rows of the UTC days from ``low`` to ``high``: a filter on the partition column alone."""
    first, last = (t.astimezone(timezone.utc).date().isoformat() for t in (low, high))
    return df.where(F.col(day).between(first, last))


def observed_between(observations: DataFrame, low: datetime, high: datetime) -> DataFrame:
    """Observations reported from ``low`` to ``high``; their days are a partition filter."""
    rows = within_days(observations, low, high) if "event_date" in observations.columns else observations
    return rows.where(F.col("last_reported").between(int(low.timestamp()), int(high.timestamp())))


def flag_rows(joined: DataFrame, stale_seconds: int) -> DataFrame:
    """Add ``invalid_features`` and ``stale_features``. A NULL feature is invalid."""
    valid = bounds.kept()
    for name in FEATURE_COLUMNS:
        valid = valid & F.col(name).isNotNull()
    age = F.unix_micros("served_at") - F.unix_micros("feature_observed_at")
    return joined.withColumn("invalid_features", ~F.coalesce(valid, F.lit(False))).withColumn(
        "stale_features", F.coalesce(age > stale_seconds * _MICROS, F.lit(False))
    )


def _sums() -> list[Column]:
    """Additive measures; every metric of a window follows from their totals."""
    error = F.col("predicted_available_bikes_15m") - F.col("actual_available_bikes")
    baseline = F.col("available_bikes") - F.col("actual_available_bikes")
    return [
        F.count(F.lit(1)).alias("samples"),
        F.count("actual_available_bikes").alias("labeled"),
        F.count_if("invalid_features").alias("invalid"),
        F.count_if("stale_features").alias("stale"),
        F.sum(F.abs(error)).cast("double").alias("abs_error"),
        F.sum(error.cast("double") * error).alias("squared_error"),
        F.sum(F.abs(baseline)).cast("double").alias("abs_baseline"),
        F.count(error).alias("scored"),
        F.count(baseline).alias("baselined"),
    ]


def _metrics() -> list[Column]:
    mean_square = F.try_divide("squared_error", F.col("scored"))
    return [
        F.col("samples").cast("double").alias("sample_count"),
        F.col("labeled").cast("double").alias("labeled_count"),
        ratio_or_zero(F.col("labeled"), F.col("samples")).alias("label_coverage"),
        ratio_or_zero(F.col("invalid"), F.col("samples")).alias("invalid_feature_rate"),
        ratio_or_zero(F.col("stale"), F.col("samples")).alias("stale_feature_rate"),
        F.try_divide("abs_error", F.col("scored")).alias("production_mae"),
        F.sqrt(mean_square).alias("production_rmse"),
        F.try_divide("abs_baseline", F.col("baselined")).alias("persistence_baseline_mae"),
    ]


def window_metrics(flagged: DataFrame, training_test_mae: float | None = None) -> DataFrame:
    """One row of coverage, rates and errors. Error metrics are NULL without labels."""
    return with_training(flagged.agg(*_sums()).select(*_metrics()), training_test_mae)


def with_training(metrics: DataFrame, training_test_mae: float | None) -> DataFrame:
    """Add the test error the model was registered with, and the ratio to it."""
    known = F.lit(training_test_mae).cast("double")
    ratio = F.when(known > 0, F.col("production_mae") / known)
    return metrics.withColumn("training_test_mae", known).withColumn(
        "production_to_training_mae_ratio", ratio
    )


def error_metrics(joined: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean absolute and root mean square error of the bounded prediction, and the error of
    forecasting no change, over labeled rows."""
    labeled = joined.where("actual_available_bikes IS NOT NULL").select(
        "*", F.lit(False).alias("invalid_features"), F.lit(False).alias("stale_features")
    )
    return (
        labeled.groupBy(*by)
        .agg(*_sums())
        .select(*by, *_metrics())
        .select(
            *by, "labeled_count", "production_mae", "production_rmse", "persistence_baseline_mae"
        )
    )


def station_breakdown(joined: DataFrame) -> DataFrame:
    """Labeled samples and mean absolute error per station."""
    error = F.col("predicted_available_bikes_15m") - F.col("actual_available_bikes")
    return (
        joined.where("actual_available_bikes IS NOT NULL")
        .groupBy("station_id")
        .agg(F.count(F.lit(1)).alias("samples"), F.avg(F.abs(error)).alias("mae"))
    )


def metric_table(metrics: DataFrame, scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Metrics and drift scores in long form ``(*by, name, value)``; absent ones are left out."""
    names = [c for c in metrics.columns if c not in by]
    long = metrics.unpivot(list(by), names, "name", "value").where("value IS NOT NULL")
    renamed = F.element_at(
        F.create_map(*[F.lit(x) for pair in _DRIFT_METRICS.items() for x in pair]), F.col("feature")
    )
    return long.unionByName(scores.select(*by, renamed.alias("name"), F.col("psi").alias("value")))


def decide(table: DataFrame, settings: Settings, by: Sequence[str] = ()) -> DataFrame:
    """Verdict per window: ``metrics`` map, ``status``, ``warnings``, ``failures``.

    A window has a fixed, short list of metrics, so its map is small.
    """
    packed = table.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("metrics")
    )

    def metric(name: str) -> Column:
        return F.element_at("metrics", F.lit(name))

    minimum = settings.monitoring_min_samples
    labeled_enough = metric("labeled_count") >= minimum
    failures = [F.when(metric("invalid_feature_rate") > 0, F.lit(FAIL_INVALID))]
    warnings = [
        F.when(
            metric("label_coverage") < settings.monitoring_min_label_coverage,
            F.lit(WARN_COVERAGE),
        ),
        F.when(metric("stale_feature_rate") > 0, F.lit(WARN_STALE)),
    ]
    for name in _DRIFT_METRICS.values():
        failing = metric(name) >= settings.monitoring_psi_failure
        warning = metric(name) >= settings.monitoring_psi_warning
        failures.append(F.when(failing, F.lit(OVER_FAILURE.format(name))))
        warnings.append(F.when(~failing & warning, F.lit(OVER_WARNING.format(name))))
    worse = metric("production_mae") >= metric("persistence_baseline_mae")
    failures.append(F.when(labeled_enough & worse, F.lit(FAIL_BASELINE)))
    warnings.append(F.when(~labeled_enough, F.lit(WARN_FEW_LABELS)))

    enough = metric("sample_count") >= minimum
    none = F.array().cast("array<string>")

    def found(tests: list[Column]) -> Column:
        return F.when(enough, F.array_compact(F.array(*tests))).otherwise(none)

    status = (
        F.when(~enough, "insufficient_data")
        .when(F.size("failures") > 0, "failed")
        .when(F.size("warnings") > 0, "warning")
        .otherwise("passed")
    )
    return packed.select(
        *by, "metrics", found(warnings).alias("warnings"), found(failures).alias("failures")
    ).withColumn("status", status)


def in_hourly_windows(rows: DataFrame, window_hours: int = 24) -> DataFrame:
    """Add ``_first`` and ``_last``: the hourly window ends, as hour numbers, each row counts in.

    A prediction counts in each window that covers its serving time and ends at or after its
    target, which is a contiguous range of ends. Rows that count nowhere are left out.
    """
    hour = clock.HOUR * _MICROS
    served = clock.bucket_of(F.unix_micros("served_at"), hour)
    due = clock.bucket_of(F.unix_micros("target_at") + hour - 1, hour)
    return rows.select(
        "*", F.greatest(served + 1, due).alias("_first"), (served + window_hours).alias("_last")
    ).where("_first <= _last")


def backfill_metrics(flagged: DataFrame, window_hours: int = 24) -> DataFrame:
    """The metrics of every hourly run at once: one row per ``window_end`` (epoch seconds), from the
    first window with a row to the last. Windows without rows count zero samples.

    Rows are first summed per range of windows; only those short sums are copied to the windows,
    never the rows.
    """
    panes = in_hourly_windows(flagged, window_hours).groupBy("_first", "_last").agg(*_sums())
    measures = [c for c in panes.columns if c not in ("_first", "_last")]
    filled = (
        panes.withColumn("_end", F.explode(F.sequence("_first", "_last")))
        .groupBy("_end")
        .agg(*[F.sum(c).alias(c) for c in measures])
    )
    counts = ("samples", "labeled", "invalid", "stale", "scored", "baselined")
    return (
        every_window(flagged, window_hours)
        .join(filled, "_end", "left")
        .withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})
        .select((F.col("_end") * clock.HOUR).alias("window_end"), *_metrics())
    )


def every_window(flagged: DataFrame, window_hours: int) -> DataFrame:
    """``_end``: every hourly window end from the first to the last that has a row, those without
    rows included. Two numbers are aggregated; the hours between are generated."""
    ends = in_hourly_windows(flagged, window_hours).agg(
        F.min("_first").alias("low"), F.max("_last").alias("high")
    )
    return ends.where("low IS NOT NULL").select(F.explode(F.sequence("low", "high")).alias("_end"))


def backfill_decisions(
    flagged: DataFrame,
    reference: DataFrame,
    settings: Settings,
    training_test_mae: float | None = None,
) -> DataFrame:
    """The verdict of every hourly run at once. ``reference`` is a stored `drift.reference_state`."""
    hours = settings.monitoring_window_hours
    metrics = with_training(backfill_metrics(flagged, hours), training_test_mae)
    scores = drift.psi_per_window(
        reference, in_hourly_windows(flagged, hours), DRIFT_COLUMNS, "_first", "_last"
    ).withColumn("window_end", F.col("window") * clock.HOUR)
    # a feature without values in a window has not drifted
    names = F.explode(F.array(*map(F.lit, DRIFT_COLUMNS))).alias("feature")
    wanted = every_window(flagged, hours).select((F.col("_end") * clock.HOUR).alias("window_end"), names)
    whole = wanted.join(scores, ["window_end", "feature"], "left").withColumn(
        "psi", F.coalesce("psi", F.lit(0.0))
    )
    return decide(metric_table(metrics, whole, ["window_end"]), settings, ["window_end"])
