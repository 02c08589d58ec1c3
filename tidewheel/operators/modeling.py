"""Chronological split, regressor, scores, promotion gate and request scoring."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidewheel.config import Settings
from tidewheel.functions import clock
from tidewheel.functions.numeric import bounded_count
from tidewheel.operators import boosting
from tidewheel.operators.quantiles import values_at_ranks
from tidewheel.schemas import AUDIT, FEATURE_COLUMNS, TARGET_COLUMN

# Split shares and model size.
TRAIN_SHARE = 0.70
VALIDATION_SHARE = 0.85
MIN_TIMESTAMPS = 10
MAX_ITERATIONS = 200
_DAY_MICROS = clock.DAY * 1_000_000
_LOOKUP_SALTS = 16


def split_cutoffs(times: DataFrame) -> DataFrame:
    """One row ``(validation_from, test_from)`` from a column ``_t`` of distinct times.

    Times are ranked day by day: day totals give the offsets, and only the days that hold a
    cutoff are ordered.
    """
    counts = times.select(
        F.lit("time").alias("series"),
        "_t",
        F.lit(1).cast("bigint").alias("n"),
        clock.bucket_of(F.col("_t"), _DAY_MICROS).alias("_bucket"),
    )

    def ends(total: Column) -> Column:
        train_end = F.greatest(F.lit(1), F.floor(total * F.lit(TRAIN_SHARE)))
        validation_end = F.greatest(train_end + 1, F.floor(total * F.lit(VALIDATION_SHARE)))
        too_few = F.raise_error(
            F.lit(f"At least {MIN_TIMESTAMPS} distinct timestamps are required for training")
        )
        return F.when(total >= MIN_TIMESTAMPS, F.array(train_end, validation_end)).otherwise(
            too_few.cast("array<bigint>")
        )

    found = values_at_ranks(counts, "series", "_t", "n", ends)
    return found.agg(F.min("_t").alias("validation_from"), F.max("_t").alias("test_from"))


def chrono_split(df: DataFrame, time: str = "event_timestamp") -> DataFrame:
    """Add ``split``: train, validation or test. Rows of one time share a split."""
    at = F.unix_micros(time)
    times = df.select(at.alias("_t")).where("_t IS NOT NULL").distinct()
    cutoffs = split_cutoffs(times).select(F.struct("*")).scalar()
    return df.withColumn(
        "split",
        F.when(at < cutoffs.getField("validation_from"), "train")
        .when(at < cutoffs.getField("test_from"), "validation")
        .when(at.isNotNull(), "test"),
    )


def require_complete(df: DataFrame, columns: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """Fail the job on the first row with a missing feature."""
    missing = F.lit(False)
    for name in columns:
        missing = missing | F.col(name).isNull()
    error = F.raise_error(F.lit("missing training features")).cast("boolean")
    return df.where(F.when(missing, error).otherwise(F.lit(True)))


def fit_model(train: DataFrame, iterations: int = MAX_ITERATIONS) -> boosting.BoostedTrees:
    """Boosted regression trees on the feature columns in their fixed order."""
    return boosting.fit(train, FEATURE_COLUMNS, TARGET_COLUMN, iterations=iterations)


def predict(model: boosting.BoostedTrees, df: DataFrame) -> DataFrame:
    """Add ``raw_prediction``."""
    return model.transform(df)


def regression_scores(
    df: DataFrame,
    *,
    label: str = TARGET_COLUMN,
    prediction: str = "raw_prediction",
    baseline: str = "available_bikes",
    by: str = "split",
) -> DataFrame:
    """MAE, RMSE, R2 and the MAE of forecasting no change, per split."""
    error = F.col(label) - F.col(prediction)
    total = F.var_pop(label) * F.count(label)
    unexplained = F.sum(error * error)
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("samples"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - F.try_divide(unexplained, total)).alias("r2"),
        F.avg(F.abs(F.col(label) - F.col(baseline))).alias("baseline_mae"),
    )


def promotion_gate(scores: DataFrame) -> DataFrame:
    """One row of registry metrics and ``promoted``: the model must beat the baseline strictly."""

    def of(split: str, column: str):
        return F.max(F.when(F.col("split") == split, F.col(column)))

    return scores.agg(
        of("validation", "mae").alias("validation_mae"),
        of("validation", "baseline_mae").alias("baseline_validation_mae"),
        of("test", "mae").alias("test_mae"),
        of("test", "rmse").alias("test_rmse"),
        of("test", "r2").alias("test_r2"),
    ).withColumn("promoted", F.col("validation_mae") < F.col("baseline_validation_mae"))


def champion_lookup(
    versions: DataFrame, aliases: DataFrame, name: str, alias: str = "champion"
) -> DataFrame:
    """The version behind an alias with its ``test_mae`` (NULL if that was not recorded)."""
    wanted = aliases.where((F.col("name") == name) & (F.col("alias") == alias))
    return wanted.join(versions, ["name", "version"]).select(
        "name",
        "alias",
        "version",
        "run_id",
        F.try_element_at("metrics", F.lit("test_mae")).alias("training_test_mae"),
    )


def newest_version(versions: DataFrame, run_id: str) -> DataFrame:
    """Greatest version number registered for a run; versions are numbers stored as text."""
    return versions.where(F.col("run_id") == run_id).agg(
        F.max(F.col("version").cast("bigint")).cast("string").alias("version")
    )


def lookup_latest(requests: DataFrame, latest: DataFrame, key: str = "station_id") -> DataFrame:
    """Requests with the newest features of their station, NULL where there are none.

    ``latest`` has one row per station. Each of its rows is repeated for a fixed number of
    salts and requests pick a salt by request id, so the requests of one busy station are
    joined by several tasks. If ``latest`` is small, Spark broadcasts it after measuring it.
    """
    salts = F.sequence(F.lit(0), F.lit(_LOOKUP_SALTS - 1))
    spread = latest.withColumn("_salt", F.explode(salts))
    salted = requests.withColumn(
        "_salt", F.pmod(F.xxhash64("request_id"), F.lit(_LOOKUP_SALTS)).cast("int")
    )
    return salted.join(spread, [key, "_salt"], "left").drop("_salt")


def score_requests(
    requests: DataFrame,
    latest: DataFrame,
    predictor: Callable[[DataFrame], DataFrame],
    settings: Settings,
    model_version: str,
) -> DataFrame:
    """Score ``requests(request_id, station_id, served_at)`` against the latest features.

    ``predictor`` adds ``raw_prediction``. The result has the audit columns and ``found``: False
    when the station has no complete feature row; such requests get no prediction.
    """
    needed = [*FEATURE_COLUMNS, "feature_observed_at"]
    looked_up = lookup_latest(requests, latest.select("station_id", *needed))
    found = F.lit(True)
    for name in needed:
        found = found & F.col(name).isNotNull()
    # Incomplete rows go through the model with zeros and lose the result again below, so that
    # one pass serves both kinds.
    filled = looked_up.select(
        "request_id",
        "station_id",
        "served_at",
        "feature_observed_at",
        found.alias("found"),
        F.struct(*FEATURE_COLUMNS).alias("_given"),
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in FEATURE_COLUMNS],
    )
    scored = predictor(filled).withColumn(
        "raw_prediction", F.when(F.col("found"), F.col("raw_prediction"))
    )
    for name in FEATURE_COLUMNS:
        scored = scored.withColumn(name, F.col(f"_given.{name}"))
    observed = F.timestamp_seconds("feature_observed_at")
    target = observed + F.make_dt_interval(secs=F.lit(clock.QUARTER_HOUR))
    built = scored.select(
        F.lit(1).alias("schema_version"),
        F.col("request_id").alias("event_id"),
        "request_id",
        "station_id",
        "served_at",
        observed.alias("feature_observed_at"),
        target.alias("target_at"),
        F.lit(15).alias("horizon_minutes"),
        F.lit(settings.model_name).alias("model_name"),
        F.lit(str(model_version)).alias("model_version"),
        F.lit(settings.model_alias).alias("model_alias"),
        F.col("raw_prediction").cast("double").alias("raw_prediction"),
        bounded_count(F.col("raw_prediction"), F.col("capacity")).alias(
            "predicted_available_bikes_15m"
        ),
        *FEATURE_COLUMNS,
        "found",
    )
    return built.select(*AUDIT.fieldNames(), "found")
