"""Settings that change results, with the bounds they are checked against."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields

# The cleaning policy has no other choices than these.
FUTURE_TOLERANCE_SECONDS = 60
GRACE_SECONDS = 900

# Lower (and upper) bounds of the settings below.
_BOUNDS = {
    "batch_size": (1, None),
    "batch_timeout_seconds": (0, None),
    "source_partitions": (0, None),
    "stale_seconds": (1, None),
    "repair_limit": (0, 2),
    "monitoring_window_hours": (1, None),
    "monitoring_label_tolerance_seconds": (0, None),
    "monitoring_min_samples": (1, None),
    "monitoring_min_label_coverage": (0, 1),
    "monitoring_psi_warning": (0, None),
    "monitoring_psi_failure": (0, None),
}


@dataclass(frozen=True)
class Settings:
    kafka_bootstrap_servers: str = "localhost:9092"
    topic: str = "station-status"
    group_id: str = "tidewheel-cleaning"
    audit_topic: str = "prediction-audit"
    audit_group_id: str = "tidewheel-audits"
    batch_size: int = 1000
    batch_timeout_seconds: float = 30.0
    source_partitions: int = 0
    stale_seconds: int = 900
    repair_limit: int = 2
    training_source: str = "synthetic"
    table_format: str = "parquet"
    model_name: str = "availability-in-15-minutes"
    model_alias: str = "champion"
    feature_ttl_seconds: int = 2 * 86_400
    monitoring_window_hours: int = 24
    monitoring_label_tolerance_seconds: int = 120
    monitoring_min_samples: int = 100
    monitoring_min_label_coverage: float = 0.9
    monitoring_psi_warning: float = 0.1
    monitoring_psi_failure: float = 0.25

    def __post_init__(self) -> None:
        for name, (low, high) in _BOUNDS.items():
            value = getattr(self, name)
            if value < low or (high is not None and value > high):
                raise ValueError(f"{name}={value} is outside [{low}, {high}]")
        if self.batch_timeout_seconds == 0:
            raise ValueError("batch_timeout_seconds must be positive")
        if self.training_source not in ("synthetic", "collected"):
            raise ValueError(f"unknown training_source {self.training_source!r}")

    @classmethod
    def from_env(cls, prefix: str = "TIDEWHEEL_", environ: dict[str, str] | None = None) -> Settings:
        """Read ``<prefix><FIELD>`` variables; a value takes the type of its default."""
        environ = dict(os.environ) if environ is None else environ
        given = {}
        for field in fields(cls):
            text = environ.get(prefix + field.name.upper())
            if text is not None:
                given[field.name] = type(field.default)(text)
        return cls(**given)
