"""Packing: documents into token sequences, balanced by estimated attention cost.

The cost of a piece of ``n`` tokens is ``linear * n + quadratic * n * n``. Documents are tokenised
and packed where they are read: a task packs blocks of its own rows, so no token crosses the
network and memory is bounded by a block. In a block, whole sequences are cut off the front of
documents that are longer than one; what remains of every document is assigned in descending order
to the sequence of the lowest cost that still has room for it. A remainder that no sequence can hold
fills the roomiest one and goes on with the rest, so all sequences of a block end up full. Tokens
that do not make a whole sequence go to shorter ones whose lengths are powers of two.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from tidewheel.llm.common import batch_of, chunks, documents, filled

#: Runs of white space from this length on are cut off before the encoder, whose pattern looks ahead at their end
#: and needs stack for it. White space as the pattern means it, which leaves out four control characters.
LONG_BLANK = re.compile(r"[^\S\x1c-\x1f]{10000,}")
#: Strings that the vocabulary's own library turns into one id (fixed value).
SPECIAL = {"<|endoftext|>": 50256}


class Encoder:
    """Token ids of texts under a rank file; strings of ``special`` in a text become their ids."""

    def __init__(self, ranks: str, special: dict[str, int]):
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens=special)
        self.special = set(special)

    def _part(self, text: str) -> list[int]:
        if any(s in text for s in self.special):
            return self.encoding.encode(text, allowed_special=self.special)
        return self.encoding.encode_ordinary(text)

    def encode(self, text: str, end: int) -> np.ndarray:
        """The ids of a text, then ``end``. A long run of white space is a piece of its own in the pattern, all
        but its last character if a word follows, so it is encoded alone and what follows as a new text."""
        ids, at = [], 0
        for run in LONG_BLANK.finditer(text):
            last = run.end() if run.end() == len(text) else run.end() - 1
            ids += self._part(text[at : run.start()])
            ids += self.encoding._encode_single_piece(text[run.start() : last].encode())
            at = last
        ids += self._part(text[at:] if at else text)
        ids.append(end)
        return np.array(ids, np.uint32)


def place(sizes: np.ndarray, capacity: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """Pack documents of the given sizes: (document, start, length, sequence, offset) per piece.

    Every sequence is full: of ``capacity`` tokens, or of a power of two for what is left over.
    """
    pieces, sequence = [], 0
    for doc, size in enumerate(sizes.tolist()):
        for start in range(0, size - capacity + 1, capacity):
            pieces.append((doc, start, capacity, sequence, 0))
            sequence += 1
    rest = sizes % capacity
    total = int(rest.sum())
    room = [capacity] * (total // capacity) + [1 << b for b in reversed(range(capacity.bit_length())) if (total % capacity) >> b & 1]
    room = np.array(room, np.int64)
    used, cost = np.zeros(len(room), np.int64), np.zeros(len(room))
    for doc in np.argsort(-rest, kind="stable").tolist():
        left, start = int(rest[doc]), int(sizes[doc] - rest[doc])
        while left:
            fits = np.flatnonzero(room >= left)
            to = int(fits[np.argmin(cost[fits])]) if len(fits) else int(np.argmax(room))
            n = min(left, int(room[to]))
            pieces.append((doc, start, n, sequence + to, int(used[to])))
            room[to] -= n
            used[to] += n
            cost[to] += linear * n + quadratic * n * n
            left, start = left - n, start + n
    return pieces


def pack(
    docs: DataFrame,
    ranks: str,
    *,
    special: dict[str, int] = SPECIAL,
    capacity: int = 1024,
    end: int = 0,
    linear: float = 1.0,
    quadratic: float = 1 / 1024,
    block_tokens: int = 4_000_000,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and the
    ids themselves if ``with_ids``.

    ``docs`` needs doc_id and text; other columns are ignored. A null or empty text is one ``end``
    token. A null doc_id is kept as null, repeated rows are packed once each, ties go to the row read
    first. An empty table gives no rows. ``ranks`` is the path of a vocabulary as ranks, ``special`` the
    strings that become one id wherever they stand in a text.
    """
    fields = [(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    schema = pa.schema(fields + [("ids", pa.list_(pa.int64()))] * with_ids)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, base = Encoder(ranks, special), TaskContext.get().partitionId() << 36
        held, keys, sizes, number = [], [], [], 0

        def flush():
            nonlocal held, keys, sizes, number
            size, ids = np.concatenate(sizes), np.concatenate(held)
            first = np.cumsum(size) - size
            doc, start, length, sequence, offset = np.array(place(size, capacity, linear, quadratic), np.int64).T
            begin = first[doc] + start
            of = pa.chunked_array(keys).combine_chunks()
            cut = [ids[a : a + n] for a, n in zip(begin.tolist(), length.tolist())]
            more = {"ids": pa.array([c.astype(np.int64) for c in cut], pa.list_(pa.int64()))} if with_ids else {}
            out = batch_of(
                schema, doc_id=of.take(pa.array(doc)), start=start, length=length,
                ids_crc32=np.array([zlib.crc32(c.astype("<u4").tobytes()) for c in cut], np.int64),
                doc_tokens=size[doc], sequence_id=base + number + sequence, offset=offset, **more,
            )
            number += int(sequence.max()) + 1
            held, keys, sizes = [], [], []
            return [out.slice(k, 50_000) for k in range(0, out.num_rows, 50_000)]

        waiting = 0
        for chunk in chunks(batches):
            found = [encoder.encode(t, end) for t in filled(chunk.column("text"), "").to_pylist()]
            ids = np.concatenate(found)
            held.append(ids)
            sizes.append(np.array([len(x) for x in found], np.int64))
            keys.append(chunk.column("doc_id").cast(pa.int64()))
            waiting += len(ids)
            if waiting >= block_tokens:
                yield from flush()
                waiting = 0
        if waiting:
            yield from flush()

    names = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return docs.select("doc_id", "text").mapInArrow(packed, names + ", ids array<long>" * with_ids)


def op8_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the ranks give the ids of byte_bpe_50k.json, which the tests compare, in a third of the time
    return pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"))
