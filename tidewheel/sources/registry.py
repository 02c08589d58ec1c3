"""Model registry in two keyed tables: versions and aliases."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from tidewheel.operators.modeling import champion_lookup, newest_version
from tidewheel.sources.tables import BatchLog, DatedTable

VERSION_SCHEMA = (
    "name string, version string, run_id string, path string,"
    " metrics map<string,double>, validation_status string"
)
ALIAS_SCHEMA = "name string, alias string, version string"


class Registry:
    """Every registered version gets a validation status and the alias ``candidate``; the alias
    ``champion`` moves only to a promoted one."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        empty = spark.createDataFrame
        self._versions = DatedTable(
            spark,
            f"{root}/model_version",
            ("name", "version"),
            schema=empty([], VERSION_SCHEMA).schema,
        )
        self._aliases = DatedTable(
            spark,
            f"{root}/model_alias",
            ("name", "alias"),
            schema=empty([], ALIAS_SCHEMA).schema,
        )

    def versions(self) -> DataFrame:
        return self._versions.read()

    def aliases(self) -> DataFrame:
        return self._aliases.read()

    def register(
        self, name: str, run_id: str, path: str, metrics: Mapping[str, float], promoted: bool
    ) -> str:
        """Add the model of a run as the next version; a run is registered once."""
        known = newest_version(self.versions(), run_id).first()["version"]
        if known is None:
            last = self.versions().where(F.col("name") == name)
            top = last.agg(F.max(F.col("version").cast("int")).alias("top")).first()["top"]
            known = str((top or 0) + 1)
            status = "passed" if promoted else "failed"
            row = [(name, known, run_id, path, dict(metrics), status)]
            self._versions.merge(self.spark.createDataFrame(row, VERSION_SCHEMA), run_id)
        names = ["candidate", "champion"] if promoted else ["candidate"]
        rows = [(name, alias, known) for alias in names]
        self._aliases.merge(self.spark.createDataFrame(rows, ALIAS_SCHEMA), run_id)
        return known

    def lookup(self, name: str, alias: str = "champion") -> Row:
        """Version, run, path and recorded test error behind an alias."""
        found = champion_lookup(self.versions(), self.aliases(), name, alias)
        paths = self.versions().select("name", "version", "path")
        row = found.join(paths, ["name", "version"]).first()
        if row is None:
            raise LookupError(f"no model {name!r} has the alias {alias!r}")
        return row


RUN_SCHEMA = (
    "run_id string, model_name string, model_version string, parameters map<string,string>,"
    " rows map<string,bigint>, metrics map<string,double>, source string, gate string,"
    " promoted boolean, places map<string,string>"
)


class RunLog:
    """Records of training runs, one row per run: what was fitted on what, how it scored, and where its
    parts lie. The record is written last, so a run with a record is complete."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self._log = BatchLog(spark, root)

    def has(self, run_id: str) -> bool:
        return self._log.has(run_id)

    def write(self, run_id: str, **record) -> None:
        names = [part.split()[0] for part in RUN_SCHEMA.split(", ")]
        row = [tuple({"run_id": run_id, **record}[name] for name in names)]
        self._log.write(self.spark.createDataFrame(row, RUN_SCHEMA).coalesce(1), run_id)

    def read(self) -> DataFrame:
        return self._log.read(schema=RUN_SCHEMA)
