"""Toxicity chain and quality on labelled rows that training has not seen, and on made-up data."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpus_cases import frame, invented
from tidewheel.llm import quality, toxicity


@pytest.fixture(scope="module")
def larger(spark):
    return tuple(spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))


def test_toxicity_on_rows_not_trained_on(spark):
    texts = [invented(k, 80) + (" dreckfool you" if k % 4 == 0 else "") for k in range(400)]
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(k, int(k % 7 == 0), int(k % 4 == 0)) for k in range(300)] + [(301, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.judge(docs, labels).collect()}
    assert all(got[k].toxic == (k % 4 == 0) and got[k].kept == (k % 4 != 0) for k in range(300, 400))


def test_later_models_use_earlier_categories():
    """The second category is the first one and a feature: only a chain sees it from the features alone."""
    rng = np.random.default_rng(1)
    x = (rng.random((3000, 3)) < 0.5).astype(np.float32)
    first = (x[:, 0] + x[:, 1] > 0).astype(float)
    second = np.logical_and(first, x[:, 2]).astype(float)
    fold = np.arange(3000) % toxicity.FOLDS
    chain = toxicity.fit_chain(x, np.column_stack([first, second]), fold, ["a", "b"], np.zeros(3, np.uint64))
    row, at = np.nonzero(x)
    p = chain.probabilities(3000, row, at)
    assert ((p[:, 1] > 0.5) == second).mean() > 0.98 and chain.weights[1][3] > 0.3
    plain = toxicity.fit_linear(x, second)
    assert np.abs(p[:, 1] - second).mean() < np.abs(1 / (1 + np.exp(-(x @ plain[:-1] + plain[-1]))) - second).mean()


def test_toxicity_odd_and_empty(spark, odd, none):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.judge(odd, labels).where("kept").count() == odd.count()
    assert toxicity.judge(none, labels).count() == 0


def test_quality_on_held_out_labels(larger):
    docs, labels = larger
    got = quality.judge(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = {y: [r.predicted == y for r in got if r.quality == y] for y in (0, 1)}
    assert np.mean(right[1]) > 0.97 and np.mean(right[0]) > 0.8
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)


def test_held_out_labels_are_not_read(larger):
    docs, labels = larger
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    turned = labels.withColumn("quality", F.when(out, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (quality.judge(docs, t).orderBy("doc_id").toPandas() for t in (labels, turned))
    assert np.allclose(one.score, two.score)


def test_quality_odd_and_empty(spark, odd, none):
    labels = spark.createDataFrame([(0, 1), (1, None), (None, 0)], "doc_id long, quality int")
    rows = quality.judge(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(not r.held_out for r in rows if r.doc_id is None)
    assert quality.judge(none, labels).count() == 0
