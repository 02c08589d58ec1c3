"""Components against all pairs of full shingle sets."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from compare import connect, differences
from corpus_cases import frame, invented, odd_texts
from tidewheel.llm import near_dedup
from tidewheel.llm.near_dedup import components, link, shingles


def sets_of(texts, words=5):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        out.append({tuple(w[k : k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set()))
    return out


def expected(ids, texts):
    sets = sets_of(texts)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(ids[a]), find(ids[b])
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in zip(ids, sets)}


def changed(text, seed, share):
    rng = random.Random(seed)
    words = text.split()
    for k in rng.sample(range(len(words)), int(share * len(words))):
        words[k] = "w%d" % rng.randrange(10**9)
    return " ".join(words)


def test_groups_of_near_copies(spark):
    base, other = invented(5, 150), invented(6, 150)
    texts = [changed(base, k, (0.0, 0.01, 0.02, 0.05)[k % 4]) for k in range(90)]
    texts += [changed(other, k, 0.03) for k in range(30)] + [other.upper()] * 5
    texts += [invented(100 + k, 60) + " " + invented(7, 50) for k in range(60)]  # a passage in common
    texts += ["a b c", "A  b\nc", "a b", "", None, " \t"]
    ids = list(range(1000, 1000 + len(texts)))
    random.Random(1).shuffle(ids)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in link(frame(spark, texts, ids)).collect()}
    assert got == expected(ids, texts)


def family(size, pairs, seed, own, shared):
    """Documents of one template with words of their own; every two of a pair share some more words."""
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randrange(10**9)
    template = [word() for _ in range(170)]
    out = []
    for k in range(size):
        if k < 2 * pairs and k % 2:
            out.append(" ".join(template + [word() for _ in range(own - shared)] + common))
        else:
            common = [word() for _ in range(shared)]
            out.append(" ".join(template + [word() for _ in range(own - shared)] + common))
    return out


@pytest.mark.parametrize(("own", "shared"), [(33, 9), (36, 14), (30, 8)])
def test_pairs_inside_large_families(spark, own, shared):
    """Families just below the threshold, with pairs inside that are just above it: no link is lost."""
    texts = family(400, 150, own, own, shared)
    sets = sets_of(texts)
    near = lambda x, y: len(sets[x] & sets[y]) / len(sets[x] | sets[y])
    assert near(0, 2) < 0.75 < near(0, 1) < 0.82
    ids = list(range(len(texts)))
    random.Random(3).shuffle(ids)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in link(frame(spark, texts, ids)).collect()}
    assert got == expected(ids, texts)
    assert len({c for _, c in got.values()}) == 250


def test_the_exact_join_alone(spark, monkeypatch):
    """Every pair that the forest leaves out is found by the join, in blocks of a few rows, whatever the order."""
    texts = family(60, 25, 1, 33, 9) + [changed(invented(3, 120), k, 0.02) for k in range(40)] + ["one two three"] * 2
    texts += [invented(k, 90) for k in range(20)]
    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    docs = frame(spark, texts).selectExpr("doc_id AS node", "text", "doc_id AS component", "doc_id")
    sets = near_dedup._sets(docs.select("doc_id", "text"), docs.select("node")).withColumn("component", F.col("node"))
    value = sets_of(texts)
    want = {(a, b) for b in range(len(texts)) for a in range(b) if value[a] and 100 * len(value[a] & value[b]) >= 75 * len(value[a] | value[b])}
    for sketch in (near_dedup._sketch(sets), np.zeros(1 << near_dedup.SKETCH_BITS, np.uint32)):
        found = {tuple(r) for r in near_dedup._across(near_dedup._firsts(sets, sketch, 75), 75).collect()}
        assert want <= found
    linked = spark.createDataFrame([(k, 0 if 60 <= k < 100 else k) for k in range(len(texts))], "node long, component long")
    members = sets.drop("component").join(linked, "node")
    found = {tuple(r) for r in near_dedup._across(near_dedup._firsts(members, near_dedup._sketch(sets), 75), 75).collect()}
    outside = lambda a, b: not (60 <= a < 100 and 60 <= b < 100)
    assert {p for p in want if outside(*p)} <= found and all(outside(*p) for p in found)
    # members of a family that are not alike enough are hardly ever compared
    assert len(found) < 2 * len({p for p in want if outside(*p)}) + 20


def test_wide_regions_are_marked():
    def marks(sizes, cuts):
        wide, out = near_dedup._Wide(), []
        tree = np.repeat(np.arange(len(sizes)), sizes)
        node = np.arange(len(tree))
        path = np.zeros((len(tree), near_dedup.DEPTH), ">u4")
        for part in np.split(node, cuts):
            if len(part):
                out += wide.add(tree[part], path[part], node[part]).tolist()
        return sorted({*out, *wide.held.tolist()}), node

    sizes = [2, 9, 10, 1, 30, 9, 1, 3]
    for cuts in ([], [1], [5, 6, 7], [12, 30, 50], list(range(1, 65)), [11], [21, 22]):
        got, node = marks(sizes, cuts)
        assert got == [0, 1, *range(11, 21), *range(22, 52), 62, 63, 64]
    assert marks([3], [1])[0] == [0, 1, 2] and marks([40], [7, 20])[0] == list(range(40))


def test_odd_rows(odd):
    rows = link(odd).collect()
    assert len(rows) == odd.count()
    texts = odd_texts()
    known = {k: t for k, t in enumerate(texts) if k != len(texts) - 2}
    want = expected(list(known), list(known.values()))
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
            assert r.kept == (r.component_id == r.doc_id)


def test_benchmark_table(documents):
    rows = documents.select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in link(documents).collect()}
    assert got == expected([r.doc_id for r in rows], [r.text for r in rows])


def test_against_sql(spark, sf_dir):
    assert differences(spark, connect(sf_dir), near_dedup.op2_lsh_forest, near_dedup.OP2_SQL, sf_dir) == []


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(60)] + [(500, k) for k in range(501, 560)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(61)} | {k: 500 for k in range(500, 560)}


def test_empty_table(none):
    assert link(none).count() == 0


def test_shingles_do_not_cross_texts():
    value, at = shingles(pa.array(["a b c d e f", None, "a b c d e", "x"]))
    assert np.diff(at).tolist() == [2, 0, 1, 1]
    assert value[at[2]] in value[:2]
