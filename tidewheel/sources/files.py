"""Questions to the file system Spark writes to, local or remote."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``, sorted; empty if it does not exist."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory())


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a Spark write to ``path`` finished: the committer leaves a marker last."""
    return exists(spark, f"{path}/_SUCCESS")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that a job wrote itself."""
    fs, target = _open(spark, path)
    fs.delete(target, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A short text file, or None if there is none."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def swap_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a short text file as one step: readers see the old or the new text, never a part."""
    aside = f"{path}-{uuid.uuid4().hex}"
    fs, target = _open(spark, aside)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    jvm = spark._jvm
    option = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark._sc._gateway.new_array(option, 1)
    options[0] = option.OVERWRITE
    place = jvm.org.apache.hadoop.fs.Path(path)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(target, fs.makeQualified(place), options)
