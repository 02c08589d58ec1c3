"""Toxicity by a chain of linear classifiers.

The categories are predicted one after the other; each model sees the words of a document and the
probabilities of the categories before it. In training these probabilities are out-of-fold: a row's
probability comes from a model that has not seen the row, so later models learn how far earlier ones
can be trusted on new text. Features are words and word beginnings, which also cover unseen endings.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm.common import LOWER, Hashes, chunks, documents, text_bytes, word_ranges

#: The fit uses at most this many labelled rows, those of the lowest hash of the id.
MOST_LABELLED = 20_000
#: Features of a model, chosen by how well they tell the last label apart.
FEATURES = 256
#: Labelled rows that must have a feature.
LEAST_ROWS = 4
FOLDS = 5
#: Word beginnings that are features, in bytes.
BEGINNINGS = (4, 5, 6)
# What stands between words: every ASCII byte but letters and digits.
_BETWEEN = np.zeros(256, bool)
_BETWEEN[:128] = True
_BETWEEN[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False


def features_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct features of each text: its words (A-Z in lower case) and the
    beginnings of longer ones."""
    data, at = text_bytes(column)
    data = LOWER[data]
    starts, ends, row = word_ranges(data, at, _BETWEEN)
    hashes = Hashes(data)
    rows, found = [row], [hashes.of(starts, ends)]
    for n in BEGINNINGS:
        longer = np.flatnonzero(ends - starts > n)
        rows.append(row[longer])
        found.append(hashes.of(starts[longer], starts[longer] + n) + np.uint64(n))
    rows, found = np.concatenate(rows), np.concatenate(found)
    return rows, found


def once(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs, by value."""
    order = np.lexsort((rows, values))
    rows, values = rows[order], values[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    return rows[new], values[new]


def chosen_of(column: pa.Array, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and feature number of the chosen features (sorted hashes) that each text has."""
    rows, found = features_of(column)
    if not len(features):
        return rows[:0], rows[:0]
    at = np.minimum(np.searchsorted(features, found), len(features) - 1)
    hit = features[at] == found
    return once(rows[hit], at[hit])


@dataclass
class Chain:
    """The fitted models: one row of weights per category, for the features, the probabilities of the
    earlier categories (as log odds) and a constant."""

    categories: list[str]
    features: np.ndarray
    weights: list[np.ndarray] = field(default_factory=list)

    def probabilities(self, n: int, row: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rows of probabilities, one column per category; ``row`` has the feature ``at``."""
        out = np.zeros((n, len(self.categories)))
        odds = np.zeros((n, 0))
        for k, w in enumerate(self.weights):
            z = np.bincount(row, w[at], n) + odds @ w[len(self.features) : -1] + w[-1]
            out[:, k] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            odds = np.column_stack([odds, log_odds(out[:, k])])
        return out


def log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def fit_linear(x: np.ndarray, y: np.ndarray, ridge: float = 0.2, steps: int = 12) -> np.ndarray:
    """Logistic regression by Newton's method; the last weight is the constant."""
    x = np.column_stack([x, np.ones(len(x), x.dtype)])
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y).astype(x.dtype) + penalty * w
        bend = (x * (p * (1 - p))[:, None].astype(x.dtype)).T @ x + np.diag(penalty)
        step = np.linalg.solve(bend.astype(np.float64), slope.astype(np.float64))
        w -= step
        if np.abs(step).max() < 1e-3:
            break
    return w


def fit_chain(x: np.ndarray, labels: np.ndarray, fold: np.ndarray, categories: list[str], features: np.ndarray) -> Chain:
    """Fit the chain on a 0/1 matrix; a NaN label leaves its row out of that category's fit."""
    chain, odds = Chain(categories, features), np.zeros((len(x), 0), x.dtype)
    for k in range(len(categories)):
        y, known = labels[:, k], ~np.isnan(labels[:, k])
        seen = np.column_stack([x, odds])
        whole = fit_linear(seen[known], y[known])
        p = np.zeros(len(x))
        for f in range(FOLDS):
            own = fold == f
            rest = known & ~own
            w = fit_linear(seen[rest], y[rest]) if rest.any() else whole
            p[own] = 1 / (1 + np.exp(-np.clip(seen[own] @ w[:-1] + w[-1], -30, 30)))
        chain.weights.append(whole)
        odds = np.column_stack([odds, log_odds(p)]).astype(x.dtype)
    return chain


def _counted(sample: DataFrame, target: str) -> DataFrame:
    """feature, rows, hits: over the labelled rows, how many have the feature, and of these the marked."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            row, found = once(*features_of(chunk.column("text")))
            y = chunk.column("y").to_numpy(zero_copy_only=False).astype(np.int64)
            values, first, rows = np.unique(found, return_index=True, return_counts=True)
            hits = np.add.reduceat(y[row], first) if len(first) else rows
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(rows), pa.array(hits)], ["feature", "rows", "hits"])

    parts = sample.select("text", F.col(target).alias("y")).where("y is not null").mapInArrow(count, "feature long, rows long, hits long")
    return parts.groupBy("feature").agg(F.sum("rows").alias("rows"), F.sum("hits").alias("hits"))


def choose(sample: DataFrame, target: str, features: int = FEATURES) -> np.ndarray:
    """The features whose rows differ most from the base rate of the target, by a z statistic. Ties go to
    the smaller hash."""
    base = sample.where(F.col(target).isNotNull()).agg(F.avg(F.col(target).cast("double"))).first()[0]
    if base is None or base in (0.0, 1.0):
        return np.zeros(0, np.uint64)
    z = F.abs(F.col("hits") - F.col("rows") * base) / F.sqrt(F.col("rows") * base * (1 - base))
    best = _counted(sample, target).where(F.col("rows") >= LEAST_ROWS).orderBy(z.desc(), "feature").limit(features)
    return np.sort(np.array([r.feature for r in best.select("feature").collect()], np.int64).view(np.uint64))


def train(docs: DataFrame, labels: DataFrame, categories: list[str], *, target: str, most: int = MOST_LABELLED, features: int = FEATURES) -> Chain:
    """Fit a chain for ``categories`` (0/1 columns of ``labels``, keyed by doc_id) on at most ``most``
    labelled rows. The features are those that tell ``target`` apart."""
    rows = labels.where("doc_id is not null").select("doc_id", *categories).dropDuplicates(["doc_id"])
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)  # bounded, so it may be broadcast
    sample = docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id")
    chosen = choose(sample, target, features)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            row, at = chosen_of(chunk.column("text"), chosen)
            found = [at[row == k].tolist() for k in range(chunk.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.int32())), *(chunk.column(c) for c in ("doc_id", *categories))], ["found", "doc_id", *categories]
            )

    kinds = "found array<int>, " + ", ".join(f"{c} {sample.schema[c].dataType.simpleString()}" for c in ("doc_id", *categories))
    got = sample.mapInArrow(numbered, kinds).toArrow().sort_by("doc_id")
    found = got.column("found").to_pylist()
    x = np.zeros((len(found), len(chosen)), np.float32)
    for k, f in enumerate(found):
        x[k, f] = 1
    labelled = np.column_stack([np.array([np.nan if v is None else float(v) for v in got.column(c).to_pylist()]) for c in categories]) if found else np.zeros((0, len(categories)))
    fold = np.array([zlib.crc32(str(i).encode()) % FOLDS for i in got.column("doc_id").to_pylist()], np.int64)
    if not len(found):
        return Chain(categories, chosen, [np.r_[np.zeros(len(chosen) + k), -30.0] for k in range(len(categories))])
    return fit_chain(x, labelled, fold, categories, chosen)


def score(docs: DataFrame, chain: Chain, *, key: str = "doc_id") -> DataFrame:
    """doc_id and the probability ``p_<category>`` of every category, from the whole text."""
    names = [f"p_{c}" for c in chain.categories]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            p = chain.probabilities(chunk.num_rows, *chosen_of(chunk.column("text"), chain.features))
            yield pa.RecordBatch.from_arrays([chunk.column(key), *(pa.array(p[:, k]) for k in range(len(names)))], [key, *names])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, "text").mapInArrow(scored, f"{key} {kind}, " + ", ".join(f"{n} double" for n in names))


def with_categories(labels: DataFrame) -> DataFrame:
    """The categories of the labels table in the chain's order: junk (quality 0), then toxic."""
    return labels.select("doc_id", (1 - F.col("quality")).alias("junk"), F.col("toxic").alias("toxic"))


def judge(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.5) -> DataFrame:
    """doc_id, p_junk, p_toxic, toxic and kept (not toxic) of every document.

    ``docs`` needs doc_id and text, ``labels`` doc_id, quality and toxic; other columns are ignored. A
    null or empty text has no features and gets the base rate; a null doc_id is kept as null; repeated
    rows come back once each. Null labels are left out of their category's fit. Without labelled
    documents every probability is about 0. An empty table gives no rows.
    """
    chain = train(docs, with_categories(labels), ["junk", "toxic"], target="toxic")
    toxic = F.col("p_toxic") >= threshold
    return score(docs, chain).withColumn("toxic", toxic).withColumn("kept", ~toxic)


def op3_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
