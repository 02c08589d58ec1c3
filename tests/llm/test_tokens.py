"""Packing, token counts and fertility against the tokenizer libraries themselves."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewheel.llm.fertility import BANDED, LEAST_DOCUMENTS, LEAST_WIDTH, judge
from tidewheel.llm.packing import SPECIAL, Encoder, pack, place
from tidewheel.llm.token_counts import count_tokens

BYTES, RANKS, WORDS, PIECES = map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "word_bpe_49k.json", "piece_bpe_32k.model"))


def rows_of(df):
    return [(r.doc_id, r.text or "") for r in df.collect()]


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_pieces_give_back_every_id_once(request, table):
    docs = request.getfixturevalue(table)
    tokenizer = Tokenizer.from_file(BYTES)
    want = Counter()
    for i, text in rows_of(docs):
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [0], "<u4")
        want[i, len(ids), zlib.crc32(ids.tobytes())] += 1
    got = pack(docs, RANKS, with_ids=True).collect()
    by_sequence, by_doc = {}, {}
    for r in got:
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == 1024 or at & (at - 1) == 0
    found = Counter()
    for (i, n), parts in by_doc.items():
        copies = sum(w for (j, m, _), w in want.items() if (i, n) == (j, m))
        assert sum(r.length for r in parts) == n * copies
        if copies == 1:
            ids = [x for r in sorted(parts, key=lambda r: r.start) for x in r.ids]
            found[i, n, zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert found == Counter({k: 1 for k, w in want.items() if sum(v for (j, m, _), v in want.items() if (j, m) == k[:2]) == 1})


def test_long_white_space_is_encoded_as_the_library_does():
    tokenizer, encoder = Tokenizer.from_file(BYTES), Encoder(RANKS, SPECIAL)
    blanks = [" " * 10_000, "\n" * 12_345, " \n\t" * 5_000, "\u3000 " * 9_000, "\x1c" * 11_000, " " * 9_999, "\r\n" * 10_001]
    for run in blanks:
        for text in (run, "a" + run, run + "b", f"word 12{run}more{run}x <|endoftext|>{run}", f"{run}\x1c{run}.", f"a{run}'s {run}\u2028b"):
            assert encoder.encode(text, 0).tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
    for run in (" " * 2_000_000, "\n" * 2_000_000):
        assert encoder.encode(run + "x", 0).tolist() == [*tokenizer.encode(run + "x", add_special_tokens=False).ids, 0]


def test_costs_are_balanced():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 700, 400)
    pieces = place(sizes, 1024, 1.0, 1 / 1024)
    cost, held = Counter(), Counter()
    for _, _, n, s, _ in pieces:
        cost[s] += n + n * n / 1024
        held[s] += n
    full = [cost[s] for s in held if held[s] == 1024]
    arrival, at = Counter(), 0
    for n in sizes.tolist():  # the same sizes one after the other
        arrival[at // 1024] += n + n * n / 1024
        at += n
    assert np.std(full) < np.std(list(arrival.values()))


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_counts_are_the_library_s(request, table):
    docs = request.getfixturevalue(table)
    tokenizer = Tokenizer.from_file(WORDS)
    want = Counter((i, len(t.encode()), len(tokenizer.encode(t, add_special_tokens=False).ids)) for i, t in rows_of(docs))
    assert Counter(map(tuple, count_tokens(docs, WORDS).collect())) == want


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_base_rules_and_figures(request, table):
    docs = request.getfixturevalue(table)
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = Counter()
    for i, text in rows_of(docs):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
        inside = {k + j for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for j in range(8)}
        ids = [x for w in words for x in model.encode(w)]
        count = Counter(ids)
        entropy = -sum(c / len(ids) * math.log2(c / len(ids)) for c in count.values())
        bytes_ = sum(model.is_byte(x) for x in ids)
        symbols = sum(text.count(c) for c in "#*$%&|<>")
        want[i, len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside), len(ids), bytes_, round(entropy, 6)] += 1
    judged = judge(docs, PIECES)
    got = judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens", "n_byte_tokens", "token_entropy"
    ).collect()
    assert Counter((*r[:-1], round(r[-1], 6) + 0.0) for r in got) == want
    for r in judged.collect():
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_bands_reject_the_outlier(spark):
    from corpus_cases import frame, invented

    texts = [invented(k, 120) for k in range(40)] + ["ẟ҈ஜ " * 120 + invented(99, 30)]
    kept = {r.doc_id: r.in_bands for r in judge(frame(spark, texts).drop("lang"), PIECES).collect()}
    assert all(kept[k] for k in range(40)) and not kept[40]


def test_bands_are_those_of_enough_documents(spark):
    """Bands recomputed: a class with few documents is judged by its language, a language with few by all."""
    from corpus_cases import frame, invented

    texts = [invented(k, 60 + k % 5) for k in range(60)] + [invented(100, 4000), "ẟ҈ஜ " * 3000 + invented(99, 30), invented(101, 70), "ẟ҈ஜ " * 200]
    docs = frame(spark, texts).drop("lang").withColumn("lang", F.when(F.col("doc_id") >= 62, "xx").otherwise("yy"))
    rows = judge(docs, PIECES).collect()
    assert {r.doc_id: r.in_bands for r in rows if r.doc_id >= 60} == {60: True, 61: False, 62: True, 63: False}
    by_class, by_group = {}, {}
    for r in rows:
        by_class.setdefault((r.group, r.length_class), []).append(r)
        by_group.setdefault(r.group, []).append(r)
    for r in rows:
        peers = by_class[r.group, r.length_class]
        peers = peers if len(peers) >= LEAST_DOCUMENTS else by_group[r.group]
        peers = peers if len(peers) >= LEAST_DOCUMENTS else rows
        within = {}
        for f in BANDED:
            values = sorted(p[f] for p in peers)
            middle = values[(len(values) - 1) // 2]
            spread = sorted(abs(v - middle) for v in values)[(len(values) - 1) // 2]
            width = max(6.0 * 1.4826 * spread, LEAST_WIDTH[f] * (middle if f == "chars_per_token" else 1))
            within[f] = (r[f] >= middle - width - 1e-9, r[f] <= middle + width + 1e-9)
        borrowed = len(by_class[r.group, r.length_class]) < LEAST_DOCUMENTS
        ends = zip(within["entropy_ratio"], within["token_entropy"])
        entropy = all(ratio or borrowed and bits for ratio, bits in ends)
        inside = all(within["chars_per_token"]) and all(within["byte_share"]) and entropy
        assert r.in_bands == inside, r


def test_empty_tables(none):
    assert pack(none, RANKS).count() == count_tokens(none, WORDS).count() == judge(none, PIECES).count() == 0
