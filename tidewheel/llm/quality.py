"""Quality by positive-unlabelled learning.

Trusted positives are documents labelled good; all documents serve as unlabelled web text. With the
class prior ``pi`` and the logistic loss, the risk is ``pi * E_P[l(g)] + max(0, E_U[l(-g)] - pi *
E_P[l(-g)])``: the negative part is estimated from unlabelled text less its positive share and kept
from falling under zero. Figures of every document are stored once; each Newton step is one pass
over them that brings back sums only.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm.common import chunks, documents, stored, text_bytes
from tidewheel.llm.fertility import repeated

_CLASSES = {
    "bar": b"|",
    "symbol": b"#*$%&<>",
    "bang": b"!?",
    "stop": b".,;:",
    "digit": b"0123456789",
    "upper": bytes(range(65, 91)),
    "lower": bytes(range(97, 123)),
    "line": b"\n",
}
_OTHER = len(_CLASSES)
_CLASS_OF = np.full(256, _OTHER, np.int64)
for _k, _bytes in enumerate(_CLASSES.values()):
    _CLASS_OF[list(_bytes)] = _k
#: Shares that also count as their square root and by being over 5 % and 20 %.
SHARES = 13
WIDTH = 5 + 4 * SHARES


def figures(texts: list[bytes], data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A row of ``WIDTH`` numbers for each text."""
    rows, known = len(texts), {}
    split = [t.split() for t in texts]
    n = np.array([len(s) for s in split], np.int64)
    doc = np.repeat(np.arange(rows), n)
    add = known.setdefault
    word = np.fromiter((add(w, len(known)) for s in split for w in s), np.int64, int(n.sum()))
    byte_of = np.repeat(np.arange(rows), np.diff(at))
    by_class = np.bincount(byte_of * (_OTHER + 1) + _CLASS_OF[data], minlength=rows * (_OTHER + 1)).reshape(rows, -1)
    again = np.zeros(len(word), bool)
    again[1:] = (word[1:] == word[:-1]) & (doc[1:] == doc[:-1])
    counts = [Counter(s) for s in split]
    distinct = np.array([len(c) for c in counts])
    most = np.array([max(c.values()) if c else 0 for c in counts])
    lines = [[x for x in t.split(b"\n") if x.strip()] for t in texts]
    all_lines = np.array([len(x) for x in lines])
    dup_lines = np.array([len(x) - len(set(x)) for x in lines])
    some = np.maximum(n, 1)
    size = np.maximum(np.diff(at), 1)
    letters = np.maximum(by_class[:, 5] + by_class[:, 6], 1)
    shares = np.column_stack(
        [
            by_class[:, [0, 1, 2, 3, 4, 7]] / some[:, None], by_class[:, 5] / letters, by_class[:, _OTHER] / size,
            np.bincount(doc[again], minlength=rows) / some, most / some, dup_lines / np.maximum(all_lines, 1),
            repeated(word, doc, rows) / some, repeated(word, doc, rows, 3) / some,
        ]
    )
    shares = np.clip(shares, 0, 2)
    variety = np.log1p(distinct) / np.log1p(some)
    plain = np.column_stack([np.log1p(n), variety, np.log(size / some), np.log1p(distinct) - 0.8 * np.log1p(n), n == 0])
    return np.column_stack([plain, shares, np.sqrt(shares), shares > 0.05, shares > 0.2]).astype(np.float32)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and ``x``, the figures of the whole text as 32-bit floats."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            data, at = text_bytes(chunk.column("text"))
            raw = data.tobytes()
            x = figures([raw[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())], data, at)
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id").cast(pa.int64()), pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "x"]
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(made, "doc_id long, x binary")


def matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, WIDTH).astype(np.float64)


def _summed(frame: DataFrame, per_batch, size: int) -> np.ndarray:
    """The sum over all batches of the vector that ``per_batch`` makes of ``x`` and ``positive``."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            total += per_batch(matrix(b.column("x")), b.column("positive").to_numpy(zero_copy_only=False).astype(bool))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array(total)], ["at", "v"])

    got = frame.mapInArrow(sums, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(size)
    out[got.column("at").to_numpy()] = got.column("v").to_numpy()
    return out


def fit(frame: DataFrame, prior: float, *, ridge: float | None = None, steps: int = 15) -> dict[str, np.ndarray]:
    """Minimise the non-negative risk over ``frame`` (x, positive); every row is unlabelled text, the
    positive ones are trusted as well. By default the fewer positives there are, the stronger the ridge."""
    d = WIDTH
    first = _summed(
        frame,
        lambda x, p: np.concatenate([[len(x), p.sum()], x.sum(0), (x * x).sum(0)]),
        2 + 2 * d,
    )
    n, n_pos = first[0], first[1]
    if not n or not n_pos:
        return {"mean": np.zeros(d), "scale": np.ones(d), "w": np.r_[np.zeros(d), log_prior(prior)]}
    if ridge is None:
        ridge = max(3e-3, 30 / n_pos)
    mean = first[2 : 2 + d] / n
    scale = np.sqrt(np.maximum(first[2 + d :] / n - mean**2, 0))
    scale = np.where(scale > 1e-6, scale, 1e9)  # a constant says nothing
    w = np.zeros(d + 1)
    w[-1] = log_prior(prior)

    def state(w: np.ndarray) -> tuple[float, float, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        m = d + 1

        def part(x: np.ndarray, pos: np.ndarray) -> np.ndarray:
            x = np.column_stack([np.clip((x - mean) / scale, -8, 8), np.ones(len(x))])
            g = np.clip(x @ w, -30, 30)
            p, soft = 1 / (1 + np.exp(-g)), np.logaddexp(0, g)
            bend = (x * (p * (1 - p))[:, None]).T @ x
            xp, gp, pp = x[pos], g[pos], p[pos]
            bend_p = (xp * (pp * (1 - pp))[:, None]).T @ xp
            return np.concatenate(
                [[soft.sum(), (soft[pos] - gp).sum(), soft[pos].sum()], x.T @ p, xp.T @ (pp - 1), xp.T @ pp, bend.ravel(), bend_p.ravel()]
            )

        s = _summed(frame, part, 3 + 3 * m + 2 * m * m)
        u, pos_loss, pos_as_neg = s[0] / n, s[1] / n_pos, s[2] / n_pos
        gu, gp, gn = s[3 : 3 + m] / n, s[3 + m : 3 + 2 * m] / n_pos, s[3 + 2 * m : 3 + 3 * m] / n_pos
        hu, hp = s[3 + 3 * m : 3 + 3 * m + m * m].reshape(m, m) / n, s[3 + 3 * m + m * m :].reshape(m, m) / n_pos
        negative = u - prior * pos_as_neg
        if negative >= 0:
            return prior * pos_loss + negative, negative, prior * gp + gu - prior * gn, hu, hp, s
        return prior * pos_loss, negative, prior * gp, prior * hp, hp, s

    penalty = np.full(d + 1, ridge)
    penalty[-1] = 0
    last = np.inf
    best = w
    for _ in range(steps):
        risk, negative, slope, bend, _, _ = state(w)
        risk += 0.5 * (penalty * w * w).sum()
        if negative < 0 or risk > last + 1e-9:  # the negative part would go under zero, or too long a step
            w = (w + best) / 2
            if np.abs(w - best).max() < 1e-3:
                break
            continue
        done = last - risk < 1e-6
        best, last = w, risk
        if done:
            break
        w = w - np.linalg.solve(bend + np.diag(penalty) + 1e-9 * np.eye(d + 1), slope + penalty * w)
    return {"mean": mean, "scale": scale, "w": best}


def log_prior(prior: float) -> float:
    p = min(max(prior, 1e-3), 1 - 1e-3)
    return float(np.log(p / (1 - p)))


def judge(docs: DataFrame, labels: DataFrame, *, folds: int = 5, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    ``docs`` needs doc_id and text, ``labels`` doc_id and quality; other columns are ignored. Labels of
    documents whose crc32(doc_id) is divisible by ``folds`` are never read. The class prior is the share
    of good ones among the other labelled documents. A null or empty text is scored by its length alone;
    a null doc_id is kept as null, unlabelled and not held out; repeated rows come back once each.
    Without labels every score is the prior, 0.5. An empty table gives no rows.
    """
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == 0, F.lit(False))
    known = labels.where("quality is not null and doc_id is not null").where(~out).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    prior = known.agg(F.avg(F.col("quality").cast("double"))).first()[0]
    x = stored(measured(docs), "quality-figures")
    trusted = known.where("quality = 1").select(F.col("doc_id").alias("good_id"))
    frame = x.join(trusted, F.col("doc_id") == F.col("good_id"), "left").select("x", F.col("good_id").isNotNull().alias("positive"))
    model = fit(stored(frame, "quality-rows"), 0.5 if prior is None else prior)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            z = np.clip((matrix(b.column("x")) - model["mean"]) / model["scale"], -8, 8) @ model["w"][:-1] + model["w"][-1]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], ["doc_id", "score"])

    return (
        x.mapInArrow(scored, "doc_id long, score double")
        .withColumn("held_out", out)
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
        .select("doc_id", "held_out", "score", "predicted")
    )


def op6_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
