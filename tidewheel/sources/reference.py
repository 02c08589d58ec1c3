"""Stored reference of a model: counted once, by day, and folded for every version of the history."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewheel.operators import drift
from tidewheel.operators.monitoring import DRIFT_COLUMNS
from tidewheel.schemas import FEATURE_COLUMNS
from tidewheel.session import checkpointed
from tidewheel.sources import files
from tidewheel.sources.tables import DAY

_MARKS = "event_date string, rows bigint, mark bigint"
_COUNTS = "feature string, value double, n bigint, event_date string"


class ReferenceStore:
    """Per model version: value counts of its scored history by day, and per history version the folded state.

    A new history is scored and counted only on the days whose rows changed; the counts of the other days
    stand. Monitoring reads the state, one row per feature, and never the history.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _place(self, kind: str, model_version: str) -> str:
        return f"{self.root}/{kind}/model_version={model_version}"

    def state_folder(self, model_version: str, history_version: int) -> str:
        return f"{self._place('state', model_version)}/history_version={history_version:012d}"

    def refresh(
        self,
        history: DataFrame,
        history_version: int,
        predict: Callable[[DataFrame], DataFrame],
        model_version: str,
        columns: Sequence[str] = DRIFT_COLUMNS,
    ) -> int:
        """Bring the state up to a version of the history (with ``event_date``). Returns how many days were
        scored. An interrupted refresh counts its days again."""
        done = self.state_folder(model_version, history_version)
        if files.is_complete(self.spark, done):
            return 0
        mark = F.bit_xor(F.xxhash64("station_id", "feature_observed_at", *FEATURE_COLUMNS)).alias("mark")
        marks = checkpointed(history.groupBy(DAY).agg(F.count(F.lit(1)).alias("rows"), mark))
        counts, noted = self._place("counts", model_version), self._place("marks", model_version)
        known = self.spark.createDataFrame([], _MARKS)
        if files.is_complete(self.spark, noted):
            known = checkpointed(self.spark.read.schema(_MARKS).parquet(noted))
        days = [r[0] for r in marks.join(known, [DAY, "rows", "mark"], "left_anti").select(DAY).collect()]
        if days:
            rows = predict(history.where(F.col(DAY).isin(days)))
            fresh = drift.daily_counts(rows, columns, DAY).repartitionByRange(DAY, "feature", "value")
            writer = fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(DAY).parquet(counts)
            marks.write.mode("overwrite").parquet(noted)
        live = self.spark.read.schema(_COUNTS).parquet(counts).join(F.broadcast(marks.select(DAY)), DAY)
        state = drift.reference_state(checkpointed(drift.folded(live)))
        state.coalesce(1).write.mode("overwrite").parquet(done)
        return len(days)

    def state(self, model_version: str, history_version: int | None = None) -> DataFrame:
        """The state for a version of the history, by default the newest there is."""
        place = self._place("state", model_version)
        names = [n for n in files.folders(self.spark, place) if files.is_complete(self.spark, f"{place}/{n}")]
        if history_version is not None:
            names = [n for n in names if n == f"history_version={history_version:012d}"]
        if not names:
            raise LookupError(f"no reference of model version {model_version!r} was stored")
        return self.spark.read.parquet(f"{place}/{names[-1]}")
