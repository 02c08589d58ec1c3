"""Apply a cleaning policy: every record ends accepted, quarantined or duplicate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from tidewheel.config import FUTURE_TOLERANCE_SECONDS
from tidewheel.functions import clock, json_values as jv
from tidewheel.functions.pinning import pinned
from tidewheel.operators.profiling import Policy, alias_only
from tidewheel.operators.validation import validate_record
from tidewheel.schemas import OBSERVATION, OBSERVATION_RULES

# Messages other systems may match on.
REASON_NOT_OBJECT = "Record, status and metadata must be JSON objects"
REASON_NOT_OPERATIONAL = "Station is not operational"
REASON_STALE = "Stale station observation"
REASON_FUTURE = "Station timestamp is in the future"
#: Columns of a quality report.
REPORT = (
    "input_rows bigint, accepted_rows bigint, quarantined_rows bigint, duplicate_rows bigint,"
    " alias_recovered_rows bigint, grace_accepted_rows bigint, issues array<string>,"
    " warnings array<string>, repairable boolean"
)
WARN_EMPTY = "No usable station observations in this batch"
WARN_GRACE = "Some observations were accepted under freshness grace"

OBSERVATION_COLUMNS = tuple(OBSERVATION.fieldNames())
_OFFSET_BITS = 44


def arrival_of(partition: Column, offset: Column) -> Column:
    """One sortable number for a (partition, offset) position."""
    return F.shiftleft(partition.cast("bigint"), _OFFSET_BITS) + offset


def lift_fields(df: DataFrame, policy: Policy, *, record: str = "record") -> DataFrame:
    """Typed observation columns from the nested record, with ``used_alias`` and ``problems``.

    Nested values replace envelope values of the same name. The canonical bike count always
    wins; the alias is read only where the policy allows it and the canonical one is absent.
    """
    used_alias = F.lit(policy.allow_bikes_available_alias) & alias_only(F.col(record))
    return validate_record(
        pinned(df, df.columns, {"used_alias": used_alias}),
        OBSERVATION_RULES,
        record=record,
        elsewhere={"num_bikes_available": (F.col("used_alias"), "status.bikes_available")},
    )


def _shaped(record: Column) -> Column:
    """The record and its sections, where present, are objects."""
    ok = jv.is_object(record)
    for section in ("$.status", "$.metadata"):
        ok = ok & (jv.member(record, section).isNull() | jv.is_object(record, section))
    return ok


def evaluate(
    df: DataFrame, policy: Policy, stale_seconds: int, *, record: str = "record"
) -> DataFrame:
    """Judge each record on its own, without a shuffle.

    Adds the observation columns, ``used_alias``, ``used_grace``, ``problems`` and ``reason``:
    the first failing rule, NULL for a record that passed.
    """
    lifted = lift_fields(df, policy, record=record)
    age = F.col("source_updated_at") - F.col("last_reported")
    operational = (
        (F.col("is_installed") == 1) & (F.col("is_renting") == 1) & (F.col("is_returning") == 1)
    )
    ahead = F.col("last_reported") > F.col("source_updated_at") + FUTURE_TOLERANCE_SECONDS
    reason = (
        F.when(
            F.size("problems") > 0,
            F.when(~_shaped(F.col(record)), F.lit(REASON_NOT_OBJECT)).otherwise(
                F.concat(F.lit("invalid: "), F.array_join("problems", "; "))
            ),
        )
        .when(~operational, F.lit(REASON_NOT_OPERATIONAL))
        .when(age > stale_seconds + policy.freshness_grace_seconds, F.lit(REASON_STALE))
        .when(ahead, F.lit(REASON_FUTURE))
    )
    judged = pinned(lifted, lifted.columns, {"reason": reason})
    return judged.withColumn("used_grace", F.col("reason").isNull() & (age > stale_seconds))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in ``order``.

    The rank filter is applied inside every map task before the shuffle, so a hot key sends
    one row per task whatever its number of copies.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def accepted_rows(
    evaluated: DataFrame, arrival: str = "arrival", counted: Observation | None = None
) -> DataFrame:
    """Observations that passed, first arrival per ``event_id``, in contract columns. ``counted`` gets their
    numbers while they are written, after the shuffle, so that work done again is not counted again."""
    first = keep_first(evaluated.where("reason IS NULL"), ["event_id"], [arrival])
    if counted is not None:
        first = first.observe(
            counted,
            F.count(F.lit(1)).alias("accepted_rows"),
            F.count_if("used_alias").alias("alias_recovered_rows"),
            F.count_if("used_grace").alias("grace_accepted_rows"),
        )
    return first.select(*OBSERVATION_COLUMNS)


def quarantined_rows(
    evaluated: DataFrame, *, record: str = "record", counted: Observation | None = None
) -> DataFrame:
    """Rejected records as they came in, with the reason."""
    rejected = evaluated.where("reason IS NOT NULL")
    if counted is not None:
        rejected = rejected.observe(counted, F.count(F.lit(1)).alias("quarantined_rows"))
    return rejected.select(F.to_json(F.col(record)).alias("record"), "reason", "problems")


def observed_report(rows: int, accepted: dict[str, int], quarantined: dict[str, int]) -> dict:
    """The quality report of a batch that was applied, from the numbers that its writes observed: no pass of its
    own. Equal to `quality_report`."""
    taken = {k: int(accepted.get(k, 0)) for k in ("accepted_rows", "alias_recovered_rows", "grace_accepted_rows")}
    refused = int(quarantined.get("quarantined_rows", 0))
    warnings = [WARN_EMPTY] * (not taken["accepted_rows"]) + [WARN_GRACE] * (taken["grace_accepted_rows"] > 0)
    return {
        "input_rows": rows,
        "accepted_rows": taken["accepted_rows"],
        "quarantined_rows": refused,
        "duplicate_rows": rows - refused - taken["accepted_rows"],
        "alias_recovered_rows": taken["alias_recovered_rows"],
        "grace_accepted_rows": taken["grace_accepted_rows"],
        "issues": [],
        "warnings": warnings,
        "repairable": False,
    }


def tag_outcomes(evaluated: DataFrame, arrival: str = "arrival") -> DataFrame:
    """All records with ``outcome``: accepted, quarantined or duplicate.

    The first arrival per event is a map-side combined minimum. It is matched back on
    (event_id, arrival): arrivals are unique, so copies of one hot event spread over all
    partitions instead of meeting in one.
    """
    first = (
        evaluated.where("reason IS NULL")
        .groupBy(F.col("event_id").alias("_event_id"))
        .agg(F.min(arrival).alias("_first"))
    )
    same = (F.col("event_id") == F.col("_event_id")) & (F.col(arrival) == F.col("_first"))
    outcome = (
        F.when(F.col("reason").isNotNull(), "quarantined")
        .when(F.col("_first").isNotNull(), "accepted")
        .otherwise("duplicate")
    )
    return (
        evaluated.join(first, same & F.col("reason").isNull(), "left")
        .withColumn("outcome", outcome)
        .drop("_event_id", "_first")
    )


def quality_report(
    evaluated: DataFrame, issues: Sequence[str] = (), arrival: str = "arrival"
) -> DataFrame:
    """One row of batch counts.

    With ``issues`` the policy was infeasible, nothing was applied and only the input counts.
    Copies collapse per event before the shuffle; the flags of the first copy travel in the
    low bits of its arrival number, which keeps the minimum a plain long.
    """
    flags = F.col("used_alias").cast("bigint") * 2 + F.col("used_grace").cast("bigint")
    passed = F.col("reason").isNull()
    per_event = evaluated.groupBy(F.when(passed, F.col("event_id")).alias("event_id")).agg(
        F.count(F.lit(1)).alias("copies"),
        F.count_if(~passed).alias("rejected"),
        F.min(F.when(passed, F.col(arrival) * 4 + flags)).alias("first"),
    )
    applied = F.lit(0 if issues else 1).cast("bigint")

    def total(column: Column) -> Column:
        return F.coalesce(F.sum(column), F.lit(0)).cast("bigint") * applied

    counts = per_event.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).cast("bigint").alias("input_rows"),
        (F.count("first") * applied).alias("accepted_rows"),
        total(F.col("rejected")).alias("quarantined_rows"),
        (total(F.col("copies") - F.col("rejected")) - F.count("first") * applied).alias(
            "duplicate_rows"
        ),
        total(F.shiftright(F.col("first"), 1).bitwiseAND(F.lit(1))).alias("alias_recovered_rows"),
        total(F.col("first").bitwiseAND(F.lit(1))).alias("grace_accepted_rows"),
    )
    known = F.array(*[F.lit(i) for i in issues]).cast("array<string>")
    return counts.select(
        "*",
        known.alias("issues"),
        F.array_compact(
            F.array(
                F.when(F.col("accepted_rows") == 0, F.lit(WARN_EMPTY)),
                F.when(F.col("grace_accepted_rows") > 0, F.lit(WARN_GRACE)),
            )
        ).alias("warnings"),
        F.lit(bool(issues)).alias("repairable"),
    )


def enrich_rows(df: DataFrame, batch_id: str | Column, time: str = "last_reported") -> DataFrame:
    """Add the batch and the UTC date of the event."""
    batch = F.lit(batch_id) if isinstance(batch_id, str) else batch_id
    return df.withColumn("batch_id", batch).withColumn(
        "event_date", clock.iso_date(F.col(time))
    )
