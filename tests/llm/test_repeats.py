"""Repeat removal against a count of every string."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest

from compare import connect, differences
from corpus_cases import frame, invented
from tidewheel.llm.repeats import OP4_SQL, op4_cover_repeats, remove


def expected(texts, length=200):
    raw = [(t or "").encode() for t in texts]
    starts = Counter(t[k : k + length] for t in raw for k in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if starts[t[k : k + length]] > 1:
                gone[k : k + length] = b"\x01" * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def result(df):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove(df).collect())


def test_shared_passages_at_every_alignment(spark):
    passage = invented(3, 80)
    texts = [invented(10 + k, 20 + 3 * k)[: 100 + 17 * k] + passage[k % 7 :] + invented(50 + k, 30) for k in range(40)]
    exact = invented(4, 60)[:200]
    texts += [f"{'p' * k}{exact}{'q' * k}" for k in (1, 3)]  # exactly as long as a repeat must be
    texts += [f"{'r' * k}{exact[:199]}{k}" for k in (5, 6)]
    texts += ["z" * 450, "y" * 200, exact, None, "", "short"]
    got = result(frame(spark, texts))
    assert got == Counter((k, *e) for k, e in enumerate(expected(texts)))


def test_copies_stay_known_to_others(spark):
    whole = invented(8, 90)
    texts = [whole, whole, whole, "before " + whole[40:300] + " after", "tiny", "tiny"]
    got = result(frame(spark, texts, [None, 5, 3, 4, 1, 1]))
    assert got == Counter((i, *e) for i, e in zip([None, 5, 3, 4, 1, 1], expected(texts)))


def test_remaining_text(spark):
    whole = "é" * 130 + invented(9, 20)
    rows = remove(frame(spark, [whole + " one", whole + " two"]), with_text=True).collect()
    for r in rows:
        assert hashlib.sha256(r.text).hexdigest() == r.kept_sha256 and len(r.text) == r.n_bytes - r.n_removed


def test_benchmark_table(documents):
    rows = documents.select("doc_id", "text").collect()
    got = result(documents)
    assert got == Counter((r.doc_id, *e) for r, e in zip(rows, expected([r.text for r in rows])))


def test_against_sql(spark, sf_dir):
    assert differences(spark, connect(sf_dir), op4_cover_repeats, OP4_SQL, sf_dir) == []


def test_odd_and_empty(odd, none):
    assert remove(odd).count() == odd.count() and remove(none).count() == 0
    with pytest.raises(ValueError):
        remove(none, length=100)
