"""Session helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution sizes the shuffles and splits skewed join partitions at run time.
_ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cpus: int | str = 8, app: str = "tidewheel") -> SparkSession:
    """A session for tests and benches. On a cluster, pass your own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TIDEWHEEL_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    for key, value in _ADAPTIVE.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def require_adaptive(spark: SparkSession) -> None:
    """Jobs that join on keys of unknown skew refuse to run with the splitter off."""
    off = [k for k in _ADAPTIVE if spark.conf.get(k, "true").lower() != "true"]
    if off:
        raise RuntimeError(f"adaptive execution is needed; switched off: {', '.join(off)}")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it in ``spark.checkpoint.dir``. Only
    a local session may go without and gets a temporary one."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", "")
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tidewheel-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written copy."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def widened(df: DataFrame, key: str) -> DataFrame:
    """Spread the rows by ``key`` if the input has fewer partitions than the session has cores.

    For costly work per row on a narrow source: one file, or a topic with few partitions. A wide
    input is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)
