"""Boosted regression trees over quantile bins, grown leaf by leaf.

Rows with equal bins are one cell that holds their number and the sum of their labels: for squared errors the
gradients of a cell follow from these, so everything after the first grouping is as long as the table of cells.
A tree grows best-first to a number of leaves. One pass over the cells sums gradients and counts per (leaf,
feature, bin) for all leaves that may be split next; only these sums reach the driver, at most leaves x features x
bins of them, and the driver keeps the splits. Sums are whole numbers (gradients in units of 2**-16), so a tree
does not depend on the order of rows or on lost executors.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewheel.functions.numeric import is_finite
from tidewheel.operators.quantiles import bucketed, values_at_ranks
from tidewheel.session import checkpointed

# Size of the model.
LEAVES = 31
L2 = 1.0
RATE = 0.1
LEAST_ROWS = 20
BINS = 255
#: Gradients are rounded to this share of a label unit.
UNIT = 1 << 16
#: Trees whose predictions are recomputed in every pass before they are written into the cells.
CHAIN = 10
#: Cells, of a few numbers each, that are summed on the driver at most.
NEAR_CELLS = 200_000
NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, value double, gain double, rows bigint"


def bin_edges(rows: DataFrame, columns: Sequence[str], bins: int = BINS) -> dict[str, np.ndarray]:
    """Upper edges of the bins of every column: the middles between its values if these are few, else the
    middles around the ranks that cut the rows into ``bins`` equal parts. At most ``bins`` - 1 numbers a column
    come to the driver."""
    wide = rows.select(*[F.col(c).cast("double").alias(c) for c in columns])
    long = wide.unpivot([], list(columns), "feature", "value").where(is_finite(F.col("value")))
    counts = checkpointed(long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")))
    distinct = {r.feature: r["count"] for r in counts.groupBy("feature").count().collect()}
    few = [c for c in columns if distinct.get(c, 0) <= bins]
    edges = {c: np.zeros(0) for c in columns}
    for r in counts.where(F.col("feature").isin(few)).groupBy("feature").agg(F.sort_array(F.collect_list("value")).alias("v")).collect():
        v = np.array(r.v)
        edges[r.feature] = (v[1:] + v[:-1]) / 2
    many = counts.where(~F.col("feature").isin(few))
    if len(few) < len(columns):
        shares = F.array(*[F.lit(k / bins) for k in range(1, bins)])
        around = lambda total: F.flatten(F.transform(shares, lambda s: F.array(F.floor(s * (total - 1)), F.ceil(s * (total - 1)))))
        found = values_at_ranks(bucketed(many, "feature", "value"), "feature", "value", "n", around)
        for r in found.groupBy("feature").agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at"), F.max("total").alias("total")).collect():
            places = [k / bins * (r.total - 1) for k in range(1, bins)]
            edges[r.feature] = np.unique([(r["at"][int(np.floor(p))] + r["at"][int(np.ceil(p))]) / 2 for p in places])
    return edges


@dataclass
class Tree:
    """Nodes by number, the root first: the split (feature, bin) and the children of inner ones."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    rows: list[int] = field(default_factory=list)
    gradient: list[int] = field(default_factory=list)

    def add(self, rows: int, gradient: int) -> int:
        for values, v in zip((self.feature, self.bin, self.left, self.right, self.gain, self.rows, self.gradient), (-1, -1, -1, -1, np.nan, rows, gradient)):
            values.append(v)
        return len(self.rows) - 1

    def leaves_of(self, bins: Sequence[np.ndarray]) -> np.ndarray:
        """The leaf that each row of bins ends in."""
        feature, limit, left, right = (np.array(v) for v in (self.feature, self.bin, self.left, self.right))
        at = np.zeros(len(bins[0]), np.int64)
        table = np.column_stack(bins)
        while (inner := np.flatnonzero(left[at] >= 0)).size:
            node = at[inner]
            goes_left = table[inner, feature[node]] <= limit[node]
            at[inner] = np.where(goes_left, left[node], right[node])
        return at


def best_split(rows: np.ndarray, gradient: np.ndarray, least: int, l2: float) -> tuple[float, int, int, int, int] | None:
    """(gain, feature, bin, rows, gradient) of the best split of a node from its sums (feature, bin): rows up to
    and including the bin go left. Of equal ones the first; None if no split gains."""
    n, g = rows.cumsum(1), gradient.cumsum(1)
    total_n, total_g = n[:, -1:], g[:, -1:]
    right_n, right_g = total_n - n, total_g - g
    score = lambda a, b: (a / UNIT) ** 2 / (b + l2)
    gain = score(g, n) + score(right_g, right_n) - score(total_g, total_n)
    gain = np.where((n >= least) & (right_n >= least), gain, -np.inf)
    f, b = np.unravel_index(int(gain.argmax()), gain.shape)
    return (float(gain[f, b]), int(f), int(b), int(n[f, b]), int(g[f, b])) if gain[f, b] > 0 else None


def grow(sums, leaves: int, least: int, l2: float) -> Tree:
    """The tree that always splits the leaf with the greatest gain. ``sums(tree, nodes)`` gives rows and gradients
    (feature, bin) of the named leaves of a tree; it is asked for all leaves at once that may come next, so often
    as the tree is deep and not so often as it has leaves."""
    whole = Tree()  # every split known, whether taken or not
    found: dict[int, tuple | None] = {}
    rows, gradient = sums(whole, [])
    whole.add(int(rows[0].sum()), int(gradient[0].sum()))
    fresh = {0: (rows, gradient)}
    while True:
        for node, (n, g) in fresh.items():
            found[node] = best_split(n, g, least, l2)
            if found[node]:
                gain, f, b, left_n, left_g = found[node]
                whole.gain[node], whole.feature[node], whole.bin[node] = gain, f, b
                whole.left[node] = whole.add(left_n, left_g)
                whole.right[node] = whole.add(whole.rows[node] - left_n, whole.gradient[node] - left_g)
        taken, unknown, heap = [], [], [(-whole.gain[0], 0)] if found[0] else []
        while heap and len(taken) < leaves - 1:
            _, node = heapq.heappop(heap)
            taken.append(node)
            for child in (whole.left[node], whole.right[node]):
                if child in found:
                    if found[child]:
                        heapq.heappush(heap, (-whole.gain[child], child))
                elif whole.rows[child] >= 2 * least:
                    unknown.append(child)
                else:
                    found[child] = None
        if not unknown or _settled(whole, found, taken, leaves):
            return _kept(whole, set(taken))
        fresh = dict(zip(unknown, zip(*sums(whole, unknown))))


def _settled(tree: Tree, found: dict, taken: list[int], leaves: int) -> bool:
    """Whether no unknown leaf can come into play: the last split used up the leaves, and only its children
    are unknown."""
    unknown = {c for node in taken for c in (tree.left[node], tree.right[node]) if c not in found}
    return len(taken) == leaves - 1 and unknown <= {tree.left[taken[-1]], tree.right[taken[-1]]}


def _kept(tree: Tree, taken: set[int]) -> Tree:
    out, number = Tree(), {0: 0}
    out.add(tree.rows[0], tree.gradient[0])
    todo = [0]
    while todo:
        node = todo.pop(0)
        if node in taken:
            at = number[node]
            out.feature[at], out.bin[at], out.gain[at] = tree.feature[node], tree.bin[node], tree.gain[node]
            for side, child in ((out.left, tree.left[node]), (out.right, tree.right[node])):
                side[at] = number[child] = out.add(tree.rows[child], tree.gradient[child])
                todo.append(child)
    return out


class BoostedTrees:
    """A fitted model: columns, nodes as a data frame, and the start value."""

    def __init__(self, columns: Sequence[str], nodes: pd.DataFrame, start: float) -> None:
        self.columns, self.nodes, self.start = tuple(columns), nodes, start

    def predictor(self) -> Column:
        """The prediction as an expression over the columns, evaluated in Arrow batches."""
        trees = [tuple(g[c].to_numpy() for c in ("feature", "threshold", "left", "right", "value")) for _, g in self.nodes.sort_values("node").groupby("tree")]
        start = self.start

        @F.pandas_udf("double")
        def raw(*columns: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy("float64", na_value=np.nan) for c in columns])
            out = np.full(len(x), start)
            for feature, threshold, left, right, value in trees:
                at = np.zeros(len(x), np.int64)
                while (inner := np.flatnonzero(left[at] >= 0)).size:
                    node = at[inner]
                    at[inner] = np.where(x[inner, feature[node]] <= threshold[node], left[node], right[node])
                out += value[at]
            return pd.Series(np.where(np.isnan(x).any(axis=1), np.nan, out))

        return F.nanvl(raw(*[F.col(c).cast("double") for c in self.columns]), F.lit(None).cast("double"))

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``raw_prediction``; null where a feature is null."""
        return df.withColumn("raw_prediction", self.predictor())

    def save(self, spark: SparkSession, path: str) -> None:
        """One Parquet file of nodes, with the columns and the start value."""
        rows = spark.createDataFrame(self.nodes, NODE_SCHEMA)
        named = rows.select("*", F.lit(self.start).alias("start"), F.array(*map(F.lit, self.columns)).alias("columns"))
        named.coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedTrees:
        rows = spark.read.parquet(path).toPandas()
        return cls(list(rows["columns"].iloc[0]), rows.drop(columns=["start", "columns"]), float(rows["start"].iloc[0]))


def _binned(train: DataFrame, columns: Sequence[str], label: str, edges: dict[str, np.ndarray]) -> DataFrame:
    """Cells: one row per combination of bins, with ``n`` and ``total``, the sum of the labels."""
    cuts = [edges[c] for c in columns]
    names = [f"b{k}" for k in range(len(columns))]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [pa.array(np.searchsorted(cut, b.column(k).to_numpy(zero_copy_only=False), "left").astype(np.int16)) for k, cut in enumerate(cuts)]
            yield pa.RecordBatch.from_arrays([*found, b.column(len(cuts))], [*names, "label"])

    wanted = train.select(*[F.col(c).cast("double") for c in columns], F.col(label).cast("double").alias("label"))
    rows = wanted.mapInArrow(made, ", ".join(f"{c} smallint" for c in names) + ", label double")
    return rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("total"))


class _Sums:
    """Rows and gradients (node, feature, bin) of the cells in named leaves, part by part; of all cells if no leaf
    is named."""

    def __init__(self, width: int, tree: Tree, nodes: list[int]) -> None:
        self.width, self.tree, self.every = width, tree, not nodes
        self.count = max(len(nodes), 1)
        self.place = np.full(max(len(tree.rows), 1), -1)
        self.place[nodes or [0]] = np.arange(self.count)
        self.rows, self.gradient = (np.zeros(self.count * width * (BINS + 1), np.int64) for _ in range(2))

    def add(self, bins: list[np.ndarray], n: np.ndarray, total: np.ndarray, score: np.ndarray) -> None:
        g = np.rint((n * score - total) * UNIT).astype(np.int64)
        node = np.zeros(len(n), np.int64) if self.every else self.place[self.tree.leaves_of(bins)]
        hit = np.flatnonzero(node >= 0)
        for k in range(self.width):
            at = (node[hit] * self.width + k) * (BINS + 1) + bins[k][hit]
            np.add.at(self.rows, at, n[hit])
            np.add.at(self.gradient, at, g[hit])

    def out(self) -> tuple[np.ndarray, np.ndarray]:
        rows, gradient = (v.reshape(self.count, self.width, BINS + 1) for v in (self.rows, self.gradient))
        return (rows[0], gradient[0]) if self.every else (rows, gradient)


class _NearCells:
    """Few cells: their columns on the driver, no more than the sums of a pass would take."""

    def __init__(self, cells: DataFrame, width: int) -> None:
        columns = [c.to_numpy() for c in cells.toArrow().columns]
        self.width, self.bins, (self.n, self.total, score) = width, columns[:width], columns[width:]
        self.score = score.copy()

    def sums(self, tree: Tree, nodes: list[int]) -> tuple[np.ndarray, np.ndarray]:
        part = _Sums(self.width, tree, nodes)
        part.add(self.bins, self.n, self.total, self.score)
        return part.out()

    def step(self, tree: Tree, value: np.ndarray) -> None:
        self.score += value[tree.leaves_of(self.bins)]

    def close(self) -> None:
        pass


class _FarCells:
    """Cells in executors. Trees since the last stored scores are applied in every pass."""

    def __init__(self, cells: DataFrame, width: int) -> None:
        self.cells, self.width = cells.persist(StorageLevel.MEMORY_AND_DISK), width
        self.recent: list[tuple[Tree, np.ndarray]] = []

    def _scored(self, batch: pa.RecordBatch) -> tuple[list[np.ndarray], np.ndarray]:
        bins = [batch.column(k).to_numpy() for k in range(self.width)]
        score = batch.column(self.width + 2).to_numpy().copy()
        for tree, value in self.recent:
            score += value[tree.leaves_of(bins)]
        return bins, score

    def _task(self) -> _FarCells:
        """What a task needs, without the table."""
        out = object.__new__(_FarCells)
        out.width, out.recent = self.width, list(self.recent)
        return out

    def sums(self, tree: Tree, nodes: list[int]) -> tuple[np.ndarray, np.ndarray]:
        task = self._task()

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part = _Sums(task.width, tree, nodes)
            for b in batches:
                bins, score = task._scored(b)
                part.add(bins, b.column(task.width).to_numpy(), b.column(task.width + 1).to_numpy(), score)
            some = np.flatnonzero(part.rows)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(part.rows[some]), pa.array(part.gradient[some])], ["at", "n", "g"])

        parts = self.cells.mapInArrow(partial, "at bigint, n bigint, g bigint")
        found = parts.groupBy("at").agg(F.sum("n").alias("n"), F.sum("g").alias("g")).toArrow()
        whole = _Sums(self.width, tree, nodes)
        for values, name in ((whole.rows, "n"), (whole.gradient, "g")):
            values[found.column("at").to_numpy()] = found.column(name).to_numpy()
        return whole.out()

    def step(self, tree: Tree, value: np.ndarray) -> None:
        self.recent.append((tree, value))
        if len(self.recent) < CHAIN:
            return
        task = self._task()

        def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(task._scored(b)[1])], b.schema.names)

        further = checkpointed(self.cells.mapInArrow(made, self.cells.schema)).persist(StorageLevel.MEMORY_AND_DISK)
        self.cells.unpersist()
        self.cells, self.recent = further, []

    def close(self) -> None:
        self.cells.unpersist()


def fit(
    train: DataFrame,
    columns: Sequence[str],
    label: str,
    *,
    iterations: int,
    leaves: int = LEAVES,
    l2: float = L2,
    rate: float = RATE,
    least: int = LEAST_ROWS,
    bins: int = BINS,
    near: int = NEAR_CELLS,
) -> BoostedTrees:
    """Boosted trees for squared errors. Rows with a null feature or label are left out.

    The number of cells does not grow with the rows once all combinations of bins were seen. Up to ``near``
    counted cells they are summed where the splits are chosen, beyond it by a Spark job per pass; the sums are the
    same whole numbers, and so are the trees.
    """
    whole = train.dropna(subset=[*columns, label])
    edges = bin_edges(whole, columns, bins)
    start = whole.agg(F.avg(label)).first()[0]
    if start is None:
        raise ValueError("no rows to train on")
    cells = checkpointed(_binned(whole, columns, label, edges).withColumn("score", F.lit(float(start))))
    held = (_NearCells if cells.count() <= near else _FarCells)(cells, len(columns))
    table = []
    try:
        for k in range(iterations):
            tree = grow(held.sums, leaves, least, l2)
            value = -rate * np.array(tree.gradient) / UNIT / (np.array(tree.rows) + l2)
            held.step(tree, value)
            for node in range(len(tree.rows)):
                inner = tree.left[node] >= 0
                cut = float(edges[columns[tree.feature[node]]][tree.bin[node]]) if inner else None
                table.append((k, node, tree.feature[node], cut, tree.left[node], tree.right[node], 0.0 if inner else float(value[node]), tree.gain[node] if inner else 0.0, tree.rows[node]))
    finally:
        held.close()
    names = [part.split()[0] for part in NODE_SCHEMA.split(", ")]
    return BoostedTrees(columns, pd.DataFrame(table, columns=names), float(start))
