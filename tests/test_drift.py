from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidewheel.operators import drift
from tidewheel.operators.quantiles import SPLITTERS, bucketed, upper_bound, values_at_ranks


def frame(spark, values):
    return spark.createDataFrame([(float(v) if v is not None else None,) for v in values], "x double")


def index(spark, reference, current):
    counts = drift.value_counts(frame(spark, reference), frame(spark, current), ["x"])
    return drift.psi(counts, ["x"]).first()["psi"]


def expected_index(reference, current):
    """The definition, over plain arrays."""
    ref = np.array([v for v in reference if v is not None and math.isfinite(v)], dtype=float)
    cur = np.array([v for v in current if v is not None and math.isfinite(v)], dtype=float)
    if not len(ref) or not len(cur):
        return 0.0
    if ref.max() - ref.min() <= 1e-8 + 1e-5 * abs(ref.min()):
        return float(not np.allclose(cur, ref.min()))
    inner = np.unique(np.quantile(ref, np.linspace(0, 1, 11)))[1:-1]

    def share(values):
        bins = np.searchsorted(inner, values, side="right")
        return np.maximum(np.bincount(bins, minlength=len(inner) + 1) / len(values), 1e-6)

    r, c = share(ref), share(cur)
    return float(((c - r) * np.log(c / r)).sum())


def test_goldens(spark):
    base = list(range(100))
    assert index(spark, base, base) == 0.0
    assert index(spark, base, [v + 100 for v in base]) > 0.25
    assert index(spark, [1.0] * 20, [1.0] * 20) == 0.0
    assert index(spark, [1.0] * 20, [2.0] * 20) == 1.0


def test_empty_and_not_finite(spark):
    assert index(spark, [], [1.0]) == 0.0
    assert index(spark, [1.0, 2.0], []) == 0.0
    assert index(spark, [None, math.nan], [1.0]) == 0.0
    odd = [1.0, 2.0, 3.0, math.inf, -math.inf, math.nan, None]
    assert index(spark, odd, [1.0, 3.0]) == pytest.approx(expected_index(odd, [1.0, 3.0]), abs=1e-12)


def test_matches_the_definition(spark):
    value = st.one_of(st.integers(-5, 5).map(float), st.floats(-100, 100).map(lambda v: round(v, 3)))

    @settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(value, min_size=1, max_size=300), st.lists(value, min_size=1, max_size=300))
    def run(reference, current):
        got = index(spark, reference, current)
        assert got == pytest.approx(expected_index(reference, current), abs=1e-9)

    run()


def test_several_columns_and_a_missing_one(spark):
    left = spark.createDataFrame([(float(i), None) for i in range(50)], "x double, y double")
    right = spark.createDataFrame([(float(i) + 5, 1.0) for i in range(50)], "x double, y double")
    got = {r.feature: r.psi for r in drift.psi(drift.value_counts(left, right, ["x", "y"]), ["x", "y"]).collect()}
    assert got["y"] == 0.0
    assert got["x"] == pytest.approx(expected_index(range(50), [i + 5 for i in range(50)]), abs=1e-9)


def test_ranks_are_exact_over_many_buckets(spark):
    """Heavy-tailed values, one of which holds a third of the weight."""
    counts = spark.range(20_000).select(
        F.lit("x").alias("feature"),
        F.exp(F.col("id") / 1000.0).alias("value"),
        F.when(F.col("id") == 7, 10_000).otherwise(1).cast("bigint").alias("n"),
    )
    spread = bucketed(counts, "feature", "value")
    assert spread.agg(F.count_distinct("_bucket")).first()[0] > 500
    wanted = [0, 6, 7, 10_006, 10_007, 29_998]
    found = values_at_ranks(
        spread, "feature", "value", "n", lambda n: F.array(*[F.lit(r) for r in wanted]).cast("array<bigint>")
    ).collect()
    assert {r.total for r in found} == {29_999}
    got = {r["rank"]: r["value"] for r in found}
    ids = {0: 0, 6: 6, 7: 7, 10_006: 7, 10_007: 8, 29_998: 19_999}
    assert {k: round(math.log(v) * 1000) for k, v in got.items()} == ids


def test_upper_bound(spark):
    cuts = sorted((i * 37) % 50 for i in range(SPLITTERS))
    rows = spark.range(-1, 52).select(
        "id",
        upper_bound(F.array(*[F.lit(c) for c in cuts]), F.col("id"), SPLITTERS).alias("k"),
    )
    assert all(r.k == sum(c <= r.id for c in cuts) for r in rows.collect())
