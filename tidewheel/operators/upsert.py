"""Merge by key for tables without a MERGE command."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidewheel.operators.cleaning import keep_first


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last in ``order``; hot keys shrink before the shuffle."""
    return keep_first(df, keys, [F.desc(c) for c in order])


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows without a match, plus every source row. ``source`` has unique keys.

    Columns the target lacks are filled with NULL for its rows.
    """
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)

