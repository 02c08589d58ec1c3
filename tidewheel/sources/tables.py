"""Tables in Parquet folders by date, and in the catalogue where its format takes MERGE."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidewheel.config import Settings
from tidewheel.functions import clock
from tidewheel.operators.upsert import upsert
from tidewheel.sources import files

_DIGITS = 12


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``, or an empty one with its columns if nothing was written yet."""
    if files.exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def training_input(spark: SparkSession, settings: Settings, paths: dict[str, str]) -> DataFrame:
    """Raw history for the feature step: recorded Parquet or the collected table."""
    name = settings.training_source
    if name == "synthetic":
        return spark.read.parquet(paths[name])
    if name == "collected":
        return keyed_table(spark, paths[name], OBSERVATION_KEY, fmt=settings.table_format).read()
    raise ValueError(f"unknown training_source {name!r}")


OBSERVATION_KEY = ("event_id",)
DAY = "event_date"
#: Batches whose ids a table remembers. A stream repeats its last batch only.
_REMEMBERED = 1000


def day_of(time: str) -> Column:
    """UTC date of a timestamp column, as text."""
    return clock.iso_date(F.unix_seconds(time))


class DatedTable:
    """A keyed Parquet table in one folder per UTC date that absorbs batches: a matching key of the same
    date is replaced, a new one is added.

    Spark's dynamic partition overwrite replaces the dates a batch touches and leaves the others alone. The
    new content of these dates is written aside first and the table's note (version, batches) is swapped
    last, so an interrupted merge is finished or dropped by the next one, and merging the same batch again
    changes nothing. A date is rewritten whole with few files, so no small files pile up and none need
    compaction. One writer at a time, as with any single streaming query per table.

    ``dated`` computes the date of a row; without it rows bring ``event_date`` along, and a table whose
    ``schema`` has none keeps one folder.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        *,
        schema: T.StructType | None = None,
        dated: Column | None = None,
    ) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = tuple(keys)
        self.dated = dated
        if schema is not None and DAY not in schema.fieldNames():
            schema = T.StructType([*schema.fields, T.StructField(DAY, T.StringType())])
        self.schema = schema

    def _note(self) -> dict:
        text = files.read_text(self.spark, f"{self.path}/_note")
        return json.loads(text) if text else {"version": 0, "batches": {}}

    def version(self) -> int | None:
        """Number of the last merged batch; None for a table without any."""
        return self._note()["version"] or None

    def merge(self, source: DataFrame, batch_id: str) -> int | None:
        """Merge ``source`` (unique keys) as one batch and return the version.

        An empty source writes nothing and returns the version there is, if any.
        """
        self._finish_pending()
        note = self._note()
        if batch_id in note["batches"]:
            return note["batches"][batch_id]
        if source.isEmpty():
            return note["version"] or None
        if self.dated is not None:
            source = source.withColumn(DAY, self.dated)
        elif DAY not in source.columns:
            source = source.withColumn(DAY, F.lit("all"))
        days = [r[0] for r in source.select(DAY).distinct().collect()]  # the dates of one batch
        merged = source
        if note["version"]:
            merged = upsert(self.read().where(F.col(DAY).isin(days)), source, [*self.keys, DAY])
        merged.write.mode("overwrite").parquet(f"{self.path}/_merges/{batch_id}")
        return self._apply(batch_id)

    def _apply(self, batch_id: str) -> int:
        aside = f"{self.path}/_merges/{batch_id}"
        rows = self.spark.read.parquet(aside).repartitionByRange(DAY, *self.keys)
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(DAY).parquet(self.path)
        note = self._note()
        version = note["version"] + 1
        batches = dict(list(note["batches"].items())[1 - _REMEMBERED :]) | {batch_id: version}
        files.swap_text(self.spark, f"{self.path}/_note", json.dumps({"version": version, "batches": batches}))
        files.remove(self.spark, aside)
        return version

    def _finish_pending(self) -> None:
        for name in files.folders(self.spark, f"{self.path}/_merges"):
            place = f"{self.path}/_merges/{name}"
            if files.is_complete(self.spark, place) and name not in self._note()["batches"]:
                self._apply(name)
            else:
                files.remove(self.spark, place)

    def read(self) -> DataFrame:
        """The current rows with ``event_date``; a filter on it prunes folders. A missing table reads as
        empty if the schema is known."""
        if not self._note()["version"]:
            if self.schema is None:
                raise FileNotFoundError(self.path)
            return self.spark.createDataFrame([], self.schema)
        if self.schema is not None:
            return self.spark.read.schema(self.schema).parquet(self.path)
        rows = self.spark.read.option("mergeSchema", "true").parquet(self.path)
        return rows.withColumn(DAY, F.col(DAY).cast("string"))


class CatalogTable:
    """The same operations on a table of the session's catalogue, through the engine's own MERGE. For formats
    that take row-level changes, such as Delta or Iceberg; their packages must be on the class path."""

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        keys: Sequence[str],
        *,
        schema: T.StructType | None = None,
        dated: Column | None = None,
        fmt: str = "delta",
    ) -> None:
        self.spark, self.path, self.keys, self.schema, self.dated, self.fmt = spark, name, tuple(keys), schema, dated, fmt

    def merge_statement(self, source: str) -> str:
        same = " AND ".join(f"t.{k} = s.{k}" for k in (*self.keys, DAY))
        return (
            f"MERGE INTO {self.path} t USING {source} s ON {same}"
            " WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
        )

    def version(self) -> int | None:
        if not self.spark.catalog.tableExists(self.path):
            return None
        if self.fmt == "delta":
            return self.spark.sql(f"DESCRIBE HISTORY {self.path} LIMIT 1").first()["version"]
        snapshots = self.spark.sql(f"SELECT count(*) AS n FROM {self.path}.snapshots")
        return snapshots.first()["n"] or None

    def merge(self, source: DataFrame, batch_id: str) -> int | None:
        """Merge ``source`` (unique keys). Merging a batch again finds its keys and changes nothing."""
        if source.isEmpty():
            return self.version()
        if self.dated is not None:
            source = source.withColumn(DAY, self.dated)
        elif DAY not in source.columns:
            source = source.withColumn(DAY, F.lit("all"))
        if not self.spark.catalog.tableExists(self.path):
            source.limit(0).writeTo(self.path).using(self.fmt).partitionedBy(F.col(DAY)).create()
        view = f"batch_{uuid.uuid4().hex}"
        source.createOrReplaceTempView(view)
        try:
            self.spark.sql(self.merge_statement(view))
        finally:
            self.spark.catalog.dropTempView(view)
        return self.version()

    def read(self) -> DataFrame:
        if self.schema is not None and not self.spark.catalog.tableExists(self.path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.table(self.path)


KeyedTable = DatedTable | CatalogTable


def keyed_table(spark: SparkSession, place: str, keys: Sequence[str], *, fmt: str = "parquet", **options) -> KeyedTable:
    """A table that absorbs batches. ``parquet``: a folder by date, touched dates overwritten; any other
    format: a table of the catalogue, changed by MERGE."""
    if fmt == "parquet":
        return DatedTable(spark, place, keys, **options)
    return CatalogTable(spark, place, keys, fmt=fmt, **options)


class Published:
    """A data set that is replaced as a whole while others read it: versions in folders of their own, and a
    pointer that is swapped when a version is complete. The last few versions stay for their readers."""

    def __init__(self, spark: SparkSession, path: str, keep: int = 3) -> None:
        self.spark, self.path, self.keep = spark, path.rstrip("/"), keep

    def version(self) -> int | None:
        text = files.read_text(self.spark, f"{self.path}/_current")
        return int(text) if text else None

    def folder(self, version: int) -> str:
        return f"{self.path}/version={version:0{_DIGITS}d}"

    def write(self, df: DataFrame, by: Sequence[str] = ()) -> int:
        """Write the next version, in folders ``by`` columns, without publishing it."""
        number = (self.version() or 0) + 1
        df.write.mode("overwrite").partitionBy(*by).parquet(self.folder(number))
        return number

    def publish(self, version: int) -> int:
        """Point readers to a written version and drop those before the last few."""
        if not files.is_complete(self.spark, self.folder(version)):
            raise FileNotFoundError(self.folder(version))
        files.swap_text(self.spark, f"{self.path}/_current", str(version))
        for name in files.folders(self.spark, self.path):
            if name.startswith("version=") and int(name.split("=")[1]) <= version - self.keep:
                files.remove(self.spark, f"{self.path}/{name}")
        return version

    def read(self, version: int | None = None) -> DataFrame:
        """The version that is current now, or a certain one."""
        version = version or self.version()
        if version is None:
            raise FileNotFoundError(self.path)
        return self.spark.read.parquet(self.folder(version))


def inspect_tables(tables: dict[str, KeyedTable]) -> list[dict]:
    """Place, version and row count per table, or status "missing"."""
    found = []
    for name, table in tables.items():
        version = table.version()
        entry = {"table": name, "uri": table.path}
        if version is None:
            found.append({**entry, "status": "missing"})
        else:
            found.append({**entry, "version": version, "rows": table.read().count()})
    return found


class BatchLog:
    """Outputs written once per batch: ``<path>/batch_id=<id>``. Writing a batch again replaces
    its own folder and no other; a finished report folder marks the batch as done."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")

    def folder(self, batch_id: str) -> str:
        return f"{self.path}/batch_id={batch_id}"

    def has(self, batch_id: str) -> bool:
        return files.is_complete(self.spark, self.folder(batch_id))

    def write(self, df: DataFrame, batch_id: str, fmt: str = "parquet") -> None:
        df.write.mode("overwrite").format(fmt).save(self.folder(batch_id))

    def read(self, fmt: str = "parquet", schema: T.StructType | str | None = None) -> DataFrame:
        reader = self.spark.read.format(fmt)
        return (reader.schema(schema) if schema is not None else reader).load(self.path)


def write_history(history: DataFrame, place: Published) -> int:
    """Write the feature history as the next version, one folder per UTC date of observation.

    Rows are ranged by date first, so that a task writes to few folders.
    """
    dated = history.withColumn(DAY, clock.iso_date(F.col("feature_observed_at")))
    return place.write(dated.repartitionByRange(DAY, *history.columns), [DAY])


def read_history(
    spark: SparkSession, place: Published | str, low: datetime | None = None, high: datetime | None = None, *, version: int | None = None
) -> DataFrame:
    """The feature history, of the days from ``low`` to ``high`` if given: other days are not listed."""
    place = Published(spark, place) if isinstance(place, str) else place
    rows = place.read(version)
    rows = rows.withColumn(DAY, F.col(DAY).cast("string"))
    if low is not None:
        rows = rows.where(F.col(DAY) >= low.astimezone(timezone.utc).date().isoformat())
    if high is not None:
        rows = rows.where(F.col(DAY) <= high.astimezone(timezone.utc).date().isoformat())
    return rows
