"""Context-tree weighting against a plain recursion, and against simpler models on held-out text."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import pytest

from corpus_cases import frame, invented
from tidewheel.llm.context_tree import CHUNK, DEPTH, END, ROW_KEYS, _blocks, score


def plain(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").lower().encode() if (text or "").isascii() else (text or "").translate({c: c + 32 for c in range(65, 91)}).encode())
    return b"".join(w + b" " for w in words) + bytes([END]), words


def brute(rows):
    """log10 probabilities of the texts under trees built from the training rows."""
    counts = defaultdict(lambda: [0, 0])

    def events(text):
        data, _ = plain(text)
        padded = bytes([END]) * DEPTH + data
        for k, byte in enumerate(data):
            context = padded[k : k + DEPTH]
            for j in range(8):
                yield context, (1 << j) | (byte >> (8 - j)), byte >> (7 - j) & 1

    train = [t for i, t in rows if zlib.crc32(str(i).encode()) % 10]
    children = defaultdict(set)
    for text in train:
        for context, tree, bit in events(text):
            for d in range(DEPTH + 1):
                node = (tree, context[DEPTH - d :])
                counts[node][bit] += 1
                if d < DEPTH:
                    children[node].add((tree, context[DEPTH - d - 1 :]))

    def estimate(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)

    @lru_cache(None)
    def weighted(node):
        own = estimate(*counts[node]) if node in counts else 0.0
        if len(node[1]) == DEPTH or node not in counts:
            return own
        below = sum(weighted(c) for c in children[node])
        top = max(own, below)
        return top + math.log(math.exp(own - top) + math.exp(below - top)) - math.log(2)

    def chance(context, tree, bit, d=0):
        node = (tree, context[DEPTH - d :])
        n = counts[node] if node in counts else [0, 0]
        own = (n[bit] + 0.5) / (n[0] + n[1] + 1)
        if d == DEPTH:
            return own
        stop = math.exp((estimate(*n) if sum(n) else 0.0) - math.log(2) - weighted(node)) if sum(n) else 0.5
        return stop * own + (1 - stop) * chance(context, tree, bit, d + 1)

    return [sum(math.log10(chance(*e)) for e in events(t)) for _, t in rows]


def test_same_as_the_recursion(spark):
    rows = [(k, invented(k, 12)) for k in range(25)] + [(40, "Été NEW zzz"), (41, None), (42, " "), (43, "ka lo")]
    got = {r.doc_id: r for r in score(frame(spark, [t for _, t in rows], [i for i, _ in rows])).collect()}
    for (i, text), want in zip(rows, brute(rows)):
        assert got[i].score == pytest.approx(want, abs=1e-6), text
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 10 == 0)


def test_base_model_and_held_out_text(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    count = Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 10:
            count.update([*plain(t)[1], None])
    total, distinct = sum(count.values()), len(count)
    got = {r.doc_id: r for r in score(documents).collect()}
    for i, t in rows:
        tokens = [*plain(t)[1], None]
        base = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in tokens)
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(w in count for w in tokens), total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    # on held-out text, contexts say more than the frequency of bytes does
    held = [i for i, r in got.items() if r.held_out]
    seen = Counter(b for i, t in rows if not got[i].held_out for b in plain(t)[0])
    bytes_ = sum(seen.values())
    single = sum(math.log10((seen[b] + 0.5) / (bytes_ + 128)) for i, t in rows if got[i].held_out for b in plain(t)[0])
    assert sum(got[i].score for i in held) > 0.7 * single


def test_odd_and_empty(odd, none):
    rows = score(odd).collect()
    assert len(rows) == odd.count() and all(r.score < 0 for r in rows)
    assert score(none).count() == 0


def test_rows_of_a_block_are_small(spark):
    rng = random.Random(9)
    texts = ["".join(rng.choice("abcdefgh jklmno pqrstuv \n") for _ in range(size)) for size in [70_000] * 40 + [CHUNK + 9, 0, 5]]
    got = _blocks(frame(spark, texts).coalesce(1)).collect()
    assert {r.block for r in got} == {0}
    held = [r for r in got if r.body is not None]
    assert [i for r in held for i in r.doc_ids] == list(range(len(texts)))
    assert [n for r in held for n in r.sizes] == [len(t) for t in texts]
    assert all(sum(r.sizes) <= CHUNK or len(r.sizes) == 1 for r in held)
    found = Counter()
    for i, text in enumerate(texts):
        data = bytes([END]) * DEPTH + plain(text)[0]
        grams = [data[n : n + DEPTH + 1] for n in range(len(data) - DEPTH)]
        found.update(grams if zlib.crc32(str(i).encode()) % 10 else dict.fromkeys(grams, 0))
    of = [r for r in got if r.body is None]
    assert all(0 < len(r["keys"]) == len(r["counts"]) <= ROW_KEYS for r in of) and len(of) > 2
    keys = [k for r in of for k in r["keys"]]
    assert keys == sorted(set(keys))
    assert {k.to_bytes(DEPTH + 1, "big"): n for r in of for k, n in zip(r["keys"], r["counts"]) if k >= 0} == dict(found)
