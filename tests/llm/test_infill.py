"""The wavelet matrix against plain counting, and the documents against their SQL."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from compare import connect, differences
from corpus_cases import frame
from tidewheel.llm.infill import BEGINS, ENDS, OP12_SQL, WaveletMatrix, classes, cut, op12_wavelet_infill, restored, transform
from pyspark.sql import functions as F

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def expected(doc_id, text):
    text = text or ""
    units = TOKEN.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@given(st.lists(st.integers(0, 7), max_size=400), st.integers(0, 400))
def test_ranks_count(symbols, place):
    symbols, place = np.array(symbols, np.uint8), min(place, len(symbols))
    matrix = WaveletMatrix(symbols, 3)
    for s in range(8):
        assert matrix.rank(s, np.array([place]))[0] == (symbols[:place] == s).sum()


@given(st.lists(st.text(st.sampled_from(" \t\nab\x1cé你\U0001f600")), min_size=1), st.integers(0, 1 << 32), st.integers(0, 1 << 32))
def test_cuts_are_token_ends(texts, h1, h2):
    raw = [t.encode() for t in texts]
    at = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    data = np.frombuffer(b"".join(raw), np.uint8)
    h = np.full(len(texts), h1), np.full(len(texts), h2)
    for t, a, n, x, y, chars, more in zip(texts, at, *cut(data, at, *h)):
        units = TOKEN.findall(t)
        one, two = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
        assert n == len(units)
        assert (chars, more) == (len("".join(units[:one])), len("".join(units[:two])))
        assert (x - a, y - a) == (len("".join(units[:one]).encode()), len("".join(units[:two]).encode()))


def test_classes_count_tokens_and_code_points():
    text = "ä  b\t\n".encode()
    got = classes(np.frombuffer(text, np.uint8), np.array([0, 0, len(text), len(text)]))
    assert (got & ENDS).tolist() == [0, 1, 0, 0, 1, 0, 1] and (got & BEGINS > 0).sum() == 6


def test_every_document(spark, odd):
    more = ["a <P> b c d", "x <S>", "<M>", "<", "<S", "P> <S <P", *[f"w{k} <P <S> "[:-2] * k for k in range(1, 60)]]
    docs = odd.unionByName(frame(spark, more, range(100, 100 + len(more))))
    made = transform(docs)
    got = sorted(made.collect(), key=str)
    want = sorted((expected(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=str)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    back = made.select("doc_id", restored(F.col("output"), F.col("form")).alias("text"))
    assert back.exceptAll(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))).isEmpty()


def test_empty_table_and_own_markers(spark, none):
    assert transform(none).isEmpty()
    docs = frame(spark, [f"one two three {k}" for k in range(40)])
    rows = transform(docs, percent=100, suffix_first=0, markers=("{p}", "{s}", "{m}")).collect()
    assert all(r.form == "psm" and r.output.startswith("{p}") for r in rows)


def test_long_white_space(spark):
    docs = frame(spark, [" " * 3_000_000 + "x " + "\n" * 1_000_000], [3])
    (row,) = transform(docs, percent=100).collect()
    assert row.n == 2


@pytest.mark.parametrize("folder", ["sf0.001"])
def test_against_sql(spark, sf_dir, folder):
    assert differences(spark, connect(sf_dir), op12_wavelet_infill, OP12_SQL, sf_dir) == []
