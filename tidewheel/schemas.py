"""Table layouts and the constraint lists that validation is generated from."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Rule:
    """One field of a contract: where it lives, how it is read, what it must satisfy."""

    name: str
    section: str  # "" = the record itself, else the nested object that holds the key
    key: str
    kind: str  # long, literal, double, text, instant
    low: float | None = None
    high: float | None = None
    strict_low: bool = False  # True: the value must be above ``low``
    min_length: int = 0
    allowed: tuple[int, ...] = ()
    default: int | None = None  # used only when the key is missing


# The observation contract.
OBSERVATION_RULES = (
    Rule("schema_version", "", "schema_version", "literal", allowed=(1,), default=1),
    Rule("event_id", "", "event_id", "text"),
    Rule("system_id", "", "system_id", "text"),
    Rule("station_id", "", "station_id", "text", min_length=1),
    Rule("source_updated_at", "", "source_updated_at", "long", low=0, strict_low=True),
    Rule("last_reported", "status", "last_reported", "long", low=0, strict_low=True),
    Rule("ingested_at", "", "ingested_at", "long", low=0, strict_low=True),
    Rule("num_bikes_available", "status", "num_bikes_available", "long", low=0),
    Rule("num_docks_available", "status", "num_docks_available", "long", low=0),
    Rule("is_installed", "status", "is_installed", "literal", allowed=(0, 1)),
    Rule("is_renting", "status", "is_renting", "literal", allowed=(0, 1)),
    Rule("is_returning", "status", "is_returning", "literal", allowed=(0, 1)),
    Rule("capacity", "metadata", "capacity", "long", low=0, strict_low=True),
    Rule("station_name", "metadata", "name", "text"),
    Rule("lat", "metadata", "lat", "double", low=-90, high=90),
    Rule("lon", "metadata", "lon", "double", low=-180, high=180),
)

# The prediction audit contract (a closed schema).
AUDIT_RULES = (
    Rule("schema_version", "", "schema_version", "literal", allowed=(1,), default=1),
    Rule("event_id", "", "event_id", "text"),
    Rule("request_id", "", "request_id", "text"),
    Rule("station_id", "", "station_id", "text", min_length=1),
    Rule("served_at", "", "served_at", "instant"),
    Rule("feature_observed_at", "", "feature_observed_at", "instant"),
    Rule("target_at", "", "target_at", "instant"),
    Rule("horizon_minutes", "", "horizon_minutes", "literal", allowed=(15,), default=15),
    Rule("model_name", "", "model_name", "text"),
    Rule("model_version", "", "model_version", "text"),
    Rule("model_alias", "", "model_alias", "text"),
    Rule("raw_prediction", "", "raw_prediction", "double"),
    Rule("predicted_available_bikes_15m", "", "predicted_available_bikes_15m", "long", low=0),
    Rule("hour_utc", "", "hour_utc", "long", low=0, high=23),
    Rule("day_of_week", "", "day_of_week", "long", low=0, high=6),
    Rule("available_bikes", "", "available_bikes", "long", low=0),
    Rule("available_docks", "", "available_docks", "long", low=0),
    Rule("capacity", "", "capacity", "long", low=0, strict_low=True),
    Rule("availability_ratio", "", "availability_ratio", "double", low=0, high=1),
)

_KIND_TYPES = {
    "long": T.LongType(),
    "literal": T.IntegerType(),
    "double": T.DoubleType(),
    "text": T.StringType(),
    "instant": T.TimestampType(),
}


def contract_schema(rules: tuple[Rule, ...]) -> T.StructType:
    return T.StructType([T.StructField(r.name, _KIND_TYPES[r.kind]) for r in rules])


OBSERVATION = contract_schema(OBSERVATION_RULES)
OBSERVATION_TABLE = T.StructType(
    [*OBSERVATION.fields, T.StructField("batch_id", T.StringType()),
     T.StructField("event_date", T.StringType())]
)
AUDIT = contract_schema(AUDIT_RULES)

# Model inputs in their order, and the label.
FEATURE_COLUMNS = (
    "hour_utc",
    "day_of_week",
    "available_bikes",
    "available_docks",
    "capacity",
    "availability_ratio",
)
TARGET_COLUMN = "target_available_bikes_15m"

FEATURE_HISTORY = T.StructType(
    [
        T.StructField("station_id", T.StringType()),
        T.StructField("event_timestamp", T.TimestampType()),
        T.StructField("feature_observed_at", T.LongType()),
        T.StructField("hour_utc", T.LongType()),
        T.StructField("day_of_week", T.LongType()),
        T.StructField("available_bikes", T.LongType()),
        T.StructField("available_docks", T.LongType()),
        T.StructField("capacity", T.LongType()),
        T.StructField("availability_ratio", T.DoubleType()),
        T.StructField(TARGET_COLUMN, T.DoubleType()),
        T.StructField("source_name", T.StringType()),
    ]
)

TOPIC_RECORD = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)
