"""Manifests against a recursive tree on the driver, and against SQL."""

from __future__ import annotations

import hashlib
import zlib
from itertools import groupby

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from corpus_cases import frame
from tidewheel.llm.manifest import LEAF, OP13_SQL, fold, manifest, numbered, op13_slot_manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(values):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree_of(leaves, fanout):
    """The root, and per leaf the siblings of each level as (left, right)."""
    paths, level, place = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for k, at in enumerate(place):
            first = at - at % fanout
            paths[k].append(("".join(level[first:at]), "".join(level[at + 1 : first + fanout])))
        level = [sha(*level[k : k + fanout]) for k in range(0, len(level), fanout)]
        place = [at // fanout for at in place]
    return level[0], paths


def expected(rows, fanout=2):
    order = lambda v: (v is not None, v or 0)
    langs = sorted({r.lang for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    parts = [sorted(((r.doc_id, leaf_of([r[c] for c in LEAF])) for r in rows if r.lang == lang), key=lambda t: (order(t[0]), t[1])) for lang in langs]
    trees = [tree_of([h for _, h in part], fanout) for part in parts]
    root, beyond = tree_of([sub for sub, _ in trees], fanout)
    return sorted((repr((i, h, sub, root, path + more)) for part, (sub, paths), more in zip(parts, trees, beyond) for (i, h), path in zip(part, paths)))


def got(rows):
    return sorted(repr((r.doc_id, r.leaf, r.subroot, r.root, [tuple(p) for p in r.path])) for r in rows)


@pytest.mark.parametrize("fanout", [2, 3, 20])
def test_trees(spark, odd, fanout):
    docs = odd.unionByName(frame(spark, [f"text {k}" for k in range(70)], range(50, 120)))
    assert got(manifest(docs, fanout=fanout).collect()) == expected(docs.collect(), fanout)


@pytest.mark.parametrize("n", [1, 2, 17, 33])
def test_sizes(spark, n):
    docs = frame(spark, [f"text {k}" for k in range(n)]).withColumn("lang", F.lit("en"))
    rows = manifest(docs).collect()
    assert got(rows) == expected(docs.collect()) and all(r.root == r.subroot for r in rows)


def test_every_proof_folds_and_tampering_shows(spark, odd):
    rows = op13_like(manifest(odd, keep={"other": F.sha2(F.col("doc_id").cast("string"), 256)}))
    assert all(r.own == r.root and r.forged != r.root for r in rows if r.doc_id is not None)


def op13_like(made):
    return made.select("doc_id", "root", fold(F.col("leaf"), F.col("path")).alias("own"), fold(F.col("other"), F.col("path")).alias("forged")).collect()


def test_equal_rows_and_none(spark, none):
    docs = frame(spark, ["same"] * 5, [7] * 5)
    assert got(manifest(docs).collect()) == expected(docs.collect())
    assert manifest(none).isEmpty()


def test_other_tables(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").withColumn("host", F.regexp_extract("url", "://([^/]*)", 1))
    made = manifest(pages, part="host", order="page_id", columns=("page_id", "url", "html"), fanout=4)
    assert made.where(fold(F.col("leaf"), F.col("path")) != F.col("root")).isEmpty() and made.count() == pages.count()


def test_places_need_no_window_over_a_part(spark, odd):
    rows = numbered(odd.select(F.lit("x").alias("tree"), "doc_id"), "tree", ["doc_id"])
    assert sorted(r.idx for r in rows.collect()) == list(range(odd.count()))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_query(spark, documents, sf_dir):
    rows = op13_slot_manifest(spark, sf_dir).collect()
    for r in rows:
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 7 != 0) and r.verified == (r.folded_root == r.root)
    assert differences(spark, connect(sf_dir), op13_slot_manifest, OP13_SQL, sf_dir) == []
