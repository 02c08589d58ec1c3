"""Boosted trees against a plain best-first version over rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewheel.operators import boosting

COLUMNS = ("a", "b", "c")


def sample(n=600, seed=3):
    rng = np.random.default_rng(seed)
    a, b, c = rng.integers(0, 40, n), rng.integers(0, 7, n), rng.normal(size=n)
    y = np.where(a > 17, 3.0, -1.0) * b + np.sin(a / 5) + (c > 0.3) * 2 + rng.normal(size=n) * 0.1
    return pd.DataFrame({"a": a, "b": b, "c": np.round(c, 3), "y": y})


def plain_tree(x, g, leaves, least, l2):
    """[(feature, threshold, gain)] in the order of the splits, and the leaf of each row."""

    def best(rows):
        found = None
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for cut in (values[1:] + values[:-1]) / 2:
                left = rows & (x[:, f] <= cut)
                right = rows & ~left
                if left.sum() < least or right.sum() < least:
                    continue
                score = lambda m: g[m].sum() ** 2 / (m.sum() + l2)
                gain = score(left) + score(right) - score(rows)
                if gain > 0 and (found is None or gain > found[0] + 1e-9):
                    found = (gain, f, cut, left, right)
        return found

    parts = [np.ones(len(x), bool)]
    splits = []
    while len(parts) < leaves:
        options = [(best(p), k) for k, p in enumerate(parts)]
        options = [(o, k) for o, k in options if o]
        if not options:
            break
        (gain, f, cut, left, right), k = max(options, key=lambda o: o[0][0])
        splits.append((f, cut, gain))
        parts[k] = left
        parts.append(right)
    return splits, parts


@pytest.fixture(scope="module")
def rows():
    return sample()


@pytest.fixture(scope="module")
def fitted(spark, rows):
    return boosting.fit(spark.createDataFrame(rows).repartition(3), COLUMNS, "y", iterations=12, leaves=9, least=10)


def test_split_gains_equal_plain_ones(spark):
    rows = sample(240)
    model = boosting.fit(spark.createDataFrame(rows).repartition(3), COLUMNS, "y", iterations=3, leaves=12, least=8)
    x = rows[list(COLUMNS)].to_numpy()
    y = rows["y"].to_numpy()
    out = np.full(len(y), y.mean())
    for t in range(3):
        splits, parts = plain_tree(x, out - y, 12, 8, boosting.L2)
        nodes = model.nodes[(model.nodes.tree == t) & (model.nodes.left >= 0)]
        assert sorted(np.round(nodes.gain, 2)) == pytest.approx(sorted(round(s[2], 2) for s in splits), abs=0.03)
        assert {(f, round(c, 6)) for f, c, _ in splits} == {(f, round(c, 6)) for f, c in zip(nodes.feature, nodes.threshold)}
        g = out - y
        for p in parts:
            out[p] -= boosting.RATE * g[p].sum() / (p.sum() + boosting.L2)
    got = model.transform(spark.createDataFrame(rows)).orderBy("a", "b", "c", "y").toPandas()
    want = rows.assign(p=out).sort_values(["a", "b", "c", "y"])["p"]
    assert np.abs(got["raw_prediction"].to_numpy() - want.to_numpy()).max() < 1e-3


def test_sizes(fitted):
    for _, nodes in fitted.nodes.groupby("tree"):
        leaves = nodes[nodes.left < 0]
        assert len(leaves) <= 9 and leaves.rows.min() >= 10 and leaves.rows.sum() == 600


def test_order_parts_and_place_of_the_sums_do_not_matter(spark, rows, fitted):
    again = boosting.fit(spark.createDataFrame(rows.iloc[::-1]).repartition(5), COLUMNS, "y", iterations=12, leaves=9, least=10, near=0)
    pd.testing.assert_frame_equal(again.nodes, fitted.nodes)


def test_only_sums_reach_the_driver(spark, rows, monkeypatch):
    """Many cells: no pass returns more rows than leaves x features x bins."""
    sizes, real = [], boosting._FarCells.sums

    def counted(self, tree, nodes):
        sizes.append(max(len(nodes), 1))
        return real(self, tree, nodes)

    monkeypatch.setattr(boosting._FarCells, "sums", counted)
    model = boosting.fit(spark.createDataFrame(rows), COLUMNS, "y", iterations=1, leaves=9, least=10, near=0)
    depth = {0: 0}
    for r in model.nodes.itertuples():
        if r.left >= 0:
            depth[r.left] = depth[r.right] = depth[r.node] + 1
    assert len(sizes) <= max(depth.values()) + 3 and max(sizes) <= 16


def test_learns(spark, rows, fitted):
    more = boosting.fit(spark.createDataFrame(rows), COLUMNS, "y", iterations=40)
    other = sample(seed=9)
    error = lambda m: np.abs(m.transform(spark.createDataFrame(other)).toPandas().eval("raw_prediction - y")).mean()
    assert error(more) < 0.6 < error(fitted) < np.abs(other["y"] - rows["y"].mean()).mean()


def test_many_values_are_cut_by_rank(spark):
    rows = pd.DataFrame({"v": np.random.default_rng(1).normal(size=5000)})
    edges = boosting.bin_edges(spark.createDataFrame(rows), ["v"], 16)["v"]
    want = np.percentile(rows["v"], np.arange(1, 16) / 16 * 100, method="midpoint")
    assert edges == pytest.approx(want)


def test_saved_model_predicts_the_same(spark, rows, fitted, tmp_path):
    fitted.save(spark, str(tmp_path / "model"))
    back = boosting.BoostedTrees.load(spark, str(tmp_path / "model"))
    frame = spark.createDataFrame(rows)
    both = frame.withColumn("x", fitted.predictor()).withColumn("y", back.predictor())
    assert both.where("x <> y").isEmpty()
    empty = frame.withColumn("b", F.lit(None).cast("bigint"))
    assert back.transform(empty).where("raw_prediction IS NOT NULL").isEmpty()


def test_constant_label_and_no_rows(spark):
    frame = spark.createDataFrame([(float(k), 1.0, 2.0, 5.0) for k in range(60)], "a double, b double, c double, y double")
    model = boosting.fit(frame, COLUMNS, "y", iterations=2)
    assert model.transform(frame).select("raw_prediction").distinct().first()[0] == pytest.approx(5.0)
    with pytest.raises(ValueError, match="no rows"):
        boosting.fit(frame.where("a < 0"), COLUMNS, "y", iterations=2)
