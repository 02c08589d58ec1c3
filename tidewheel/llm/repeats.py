"""Removal of repeated byte strings, by blockwise suffix sorting with a difference cover.

A string of ``length`` bytes that starts at two places is found without sorting every suffix:

1. Cover samples. ``COVER`` is a difference cover modulo ``PERIOD``: for any two places some shift under
   ``PERIOD`` puts both on sampled places of their documents. A block of ``length - PERIOD + 1`` bytes from
   there on lies within both strings. The samples are ranked by their blocks, one bucket of blocks at a
   time; a rank that only one sample has is no rank at all.
2. Suffix buckets. A suffix can share its first ``length`` bytes with another only if a sampled block in
   these bytes has a rank (the shift that samples both): the sample ranks alone settle that nearly all
   suffixes have no long tie, and these leave here. Of the rest, the first ``length`` bytes are sorted as 64-bit hashes, again one bucket at a
   time, and equal neighbours are repeats.
3. The repeats go back to the chunks of documents they came from and are cut out.

Only hashes cross the network (32 bits and the bucket for a sample block, where a chance match costs only
a needless suffix in step 2; 64 bits and more for a suffix), sorted and distinct per chunk, so a string
that stands everywhere is one entry per chunk. The number of buckets follows the input, so a bucket has a
bounded size. Buckets are ranges of hashes, not of first bytes, which would be of very unequal sizes; the
order within a bucket is that of the hashes, as only ties matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm.common import Hashes, chunks, documents, stored, stored_by, text_bytes

LENGTH = 200
PERIOD = 133
#: Differences of these take every value modulo 133 (a Singer difference set).
COVER = np.array([0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109])
assert len(np.unique((COVER[:, None] - COVER) % PERIOD)) == PERIOD
#: Bytes of entries that a bucket is made for.
BUCKET_BYTES = 24 << 20
CHUNK = 4 << 20
#: Ids of copies that are broadcast at most; more are joined by a shuffle.
BROADCAST_IDS = 300_000
EMPTY_SHA = hashlib.sha256(b"").hexdigest()



def _chunked(docs: DataFrame) -> DataFrame:
    """chunk, doc_ids, wholes (a copy stands elsewhere), sizes (bytes of each text) and body (the texts end
    to end, compressed)."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 30
        ids, wholes, sizes, parts, held = [], [], [], [], 0

        def row() -> pa.RecordBatch:
            nonlocal number, ids, wholes, sizes, parts, held
            body = b"".join(parts)
            packed = pa.compress(body, codec="zstd", asbytes=True)
            out = pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([ids], pa.list_(pa.int64())), pa.array([wholes], pa.list_(pa.bool_())), pa.array([sizes], pa.list_(pa.int64())), pa.array([packed], pa.binary())],
                ["chunk", "doc_ids", "wholes", "sizes", "body"],
            )
            number += 1
            ids, wholes, sizes, parts, held = [], [], [], [], 0
            return out

        for piece in chunks(batches, most=CHUNK // 4):
            data, at = text_bytes(piece.column("text"))
            if held and held + len(data) > CHUNK:
                yield row()
            ids += piece.column("doc_id").to_pylist()
            wholes += [bool(w) for w in piece.column("whole").to_pylist()]
            sizes += np.diff(at).tolist()
            parts.append(data.tobytes())
            held += len(data)
        if ids:
            yield row()

    return docs.select("doc_id", "text", "whole").mapInArrow(made, "chunk long, doc_ids array<long>, wholes array<boolean>, sizes array<long>, body binary")


class Chunk:
    """One chunk of documents: its bytes, its samples, and its suffixes with a long tie."""

    def __init__(self, row: dict):
        self.ids, self.wholes, sizes = row["doc_ids"], row["wholes"], np.array(row["sizes"], np.int64)
        total = int(sizes.sum())
        self.data = np.frombuffer(pa.decompress(row["body"], total, codec="zstd") if total else b"", np.uint8)
        self.at = np.concatenate([[0], np.cumsum(sizes)])
        self.hashes = Hashes(self.data)

    def samples(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the sampled blocks and the hashes of the blocks."""
        block = length - PERIOD + 1
        places = []
        for a, b in zip(self.at[:-1].tolist(), self.at[1:].tolist()):
            if b - a >= length:
                p = (np.arange(0, b - a, PERIOD)[:, None] + COVER).ravel() + a
                places.append(p[p <= b - block])
        places = np.concatenate(places) if places else np.zeros(0, np.int64)
        return places, self.hashes.of(places, places + block)

    def tied(self, places: np.ndarray, ranked: np.ndarray, length: int) -> np.ndarray:
        """The suffixes with a ranked block within reach of a shift."""
        seen = np.zeros(len(self.data) + 1, np.int32)
        seen[places[ranked] + 1] = 1
        np.cumsum(seen, out=seen)
        ok = np.zeros(len(self.data), bool)
        for a, b in zip(self.at[:-1].tolist(), self.at[1:].tolist()):
            if b - a >= length:
                ok[a : b - length + 1] = seen[a + PERIOD : b - length + 1 + PERIOD] > seen[a : b - length + 1]
        return np.flatnonzero(ok)


def _entries(number: int, found: np.ndarray, kind: str, buckets: int) -> list[tuple[int, int, bytes, bytes]]:
    """Per bucket: the distinct hashes of a chunk, and which of them stand there more than once."""
    value, times = np.unique(found, return_counts=True)
    bits = buckets.bit_length() - 1
    bucket = (value >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(value), np.int64)
    cut = np.searchsorted(bucket, np.arange(buckets + 1))
    if kind == "<u4":
        value = (value >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFF)
    out = []
    for k in range(buckets):
        a, b = int(cut[k]), int(cut[k + 1])
        if a < b:
            out.append((k, number, value[a:b].astype(kind).tobytes(), np.packbits(times[a:b] > 1).tobytes()))
    return out


_ENTRY = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("entries", pa.binary()), ("twice", pa.binary())])
_MARK = pa.schema([("chunk", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int32()), ("marks", pa.binary())])


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table([list(c) for c in zip(*rows)], schema=schema) if rows else schema.empty_table()


def _shared(entries: DataFrame, kind: str, number: int) -> DataFrame:
    """chunk, kind, bucket and a bit per entry: whether it stands in another place. One bucket at a time."""

    def judged(bucket: pa.Table) -> pa.Table:
        rows = bucket.to_pylist()
        values = [np.frombuffer(r["entries"], kind) for r in rows]
        order = np.sort(np.concatenate(values))
        many = np.unique(order[1:][order[1:] == order[:-1]])
        out = []
        for r, v in zip(rows, values):
            at = np.searchsorted(many, v)
            hit = many[np.minimum(at, len(many) - 1)] == v if len(many) else np.zeros(len(v), bool)
            hit |= np.unpackbits(np.frombuffer(r["twice"], np.uint8), count=len(v)).astype(bool)
            out.append((r["chunk"], number, r["bucket"], np.packbits(hit).tobytes()))
        return _table(out, _MARK)

    return entries.groupBy("bucket").applyInArrow(judged, "chunk long, kind int, bucket int, marks binary")


def _marked(found: np.ndarray, marks: dict[int, bytes], buckets: int) -> np.ndarray:
    """For each hash of a chunk, whether its entry is marked."""
    value, inverse = np.unique(found, return_inverse=True)
    bits = buckets.bit_length() - 1
    bucket = (value >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(value), np.int64)
    cut = np.searchsorted(bucket, np.arange(buckets + 1))
    flag = np.zeros(len(value), bool)
    for k, packed in marks.items():
        a, b = int(cut[k]), int(cut[k + 1])
        flag[a:b] = np.unpackbits(np.frombuffer(packed, np.uint8), count=b - a).astype(bool)
    return flag[inverse]


def _buckets(entries_bytes: float) -> int:
    """A power of two."""
    return 1 << max(0, int(np.ceil(np.log2(max(entries_bytes, 1) / BUCKET_BYTES))))


def remove(docs: DataFrame, *, length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the remaining ``text`` (as binary) if
    ``with_text``.

    Every byte covered by a string of ``length`` bytes that also starts anywhere else in the table goes,
    judged on the input. ``docs`` needs doc_id and text; other columns are ignored. A null text is empty;
    texts under ``length`` bytes lose nothing. A null doc_id is kept as null. Repeated rows are copies of
    each other and come back once each. An empty table gives no rows. ``length`` is more than ``PERIOD``.
    """
    if length <= PERIOD + 16:
        raise ValueError(f"length must be over {PERIOD + 16}")
    spark = docs.sparkSession
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    sizes = plain.select("doc_id", F.octet_length("text").alias("n"), F.unhex(F.sha2("text", 256)).alias("sha"))
    # all of a text that stands elsewhere as a whole goes; its first copy stays among the chunks, for others
    groups = sizes.where(F.col("n") >= length).groupBy("sha").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first"))
    copies = sizes.join(groups.where("copies > 1"), "sha").where("doc_id is not null")
    copies = stored(copies.select("doc_id", "sha", (F.col("doc_id") == F.col("first")).alias("whole")).distinct(), "copies")
    copies = F.broadcast(copies) if copies.count() <= BROADCAST_IDS else copies
    named = plain.withColumn("sha", F.unhex(F.sha2("text", 256))).join(copies, ["doc_id", "sha"], "left")
    rest = named.where("whole is null or whole")
    n = F.octet_length("text").cast("long")
    settled = named.where("not whole").select("doc_id", n.alias("n_bytes"), n.alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.lit(EMPTY_SHA).alias("kept_sha256"))

    # the chunks are written in buckets by chunk, so that marks can come to them and the texts stay
    table = stored_by(_chunked(rest), "chunk", "chunks")
    total = table.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    n_samples, n_suffixes = _buckets(total * len(COVER) / PERIOD * 4), _buckets(total * 0.3 * 8)

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, found = Chunk(row).samples(length)
                for part in _sliced(_entries(row["chunk"], found, "<u4", n_samples)):
                    yield part

    entry = "bucket int, chunk long, entries binary, twice binary"
    ranks = stored(_shared(table.mapInArrow(sampled, entry), "<u4", 1), "ranks")

    def suffixes(rows: pa.Table, marks: pa.Table) -> pa.Table:
        out = []
        of = _by_chunk(marks)
        for row in rows.to_pylist():
            chunk = Chunk(row)
            places, found = chunk.samples(length)
            tied = chunk.tied(places, _marked(found, of.get((row["chunk"], 1), {}), n_samples), length)
            out += _entries(row["chunk"], chunk.hashes.of(tied, tied + length), "<u8", n_suffixes)
        return _table(out, _ENTRY)

    ties = table.groupBy("chunk").cogroup(ranks.groupBy("chunk")).applyInArrow(suffixes, entry)
    marks = stored(ranks.union(_shared(ties, "<u8", 2)), "marks")
    kind = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    result = pa.schema(kind + [("text", pa.binary())] * with_text)

    def cut(rows: pa.Table, marks: pa.Table) -> pa.Table:
        out = []
        of = _by_chunk(marks)
        for row in rows.to_pylist():
            chunk = Chunk(row)
            places, found = chunk.samples(length)
            tied = chunk.tied(places, _marked(found, of.get((row["chunk"], 1), {}), n_samples), length)
            start = tied[_marked(chunk.hashes.of(tied, tied + length), of.get((row["chunk"], 2), {}), n_suffixes)]
            cover = np.zeros(len(chunk.data) + 1, np.int32)
            cover[start] += 1  # places are distinct
            cover[start + length] -= 1
            gone = np.cumsum(cover)[:-1] > 0
            for doc_id, whole, a, b in zip(chunk.ids, chunk.wholes, chunk.at[:-1].tolist(), chunk.at[1:].tolist()):
                g = gone[a:b] | whole
                kept = chunk.data[a:b][~g].tobytes()
                spans = int(g[:1].sum() + (g[1:] & ~g[:-1]).sum())
                out.append((doc_id, b - a, int(g.sum()), spans, hashlib.sha256(kept).hexdigest(), kept)[: len(result)])
        return _table(out, result)

    text = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", text binary" * with_text
    cleaned = table.groupBy("chunk").cogroup(marks.groupBy("chunk")).applyInArrow(cut, text)
    return cleaned.unionByName(settled.withColumn("text", F.lit(b"")) if with_text else settled)


def _by_chunk(marks: pa.Table) -> dict[tuple[int, int], dict[int, bytes]]:
    out: dict[tuple[int, int], dict[int, bytes]] = {}
    for r in marks.to_pylist():
        out.setdefault((r["chunk"], r["kind"]), {})[r["bucket"]] = r["marks"]
    return out


def _sliced(rows: list[tuple], at_once: int = 64) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(rows), at_once):
        yield from _table(rows[k : k + at_once], _ENTRY).combine_chunks().to_batches()


def op4_cover_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove(documents(spark, sf_dir))


#: Every string of 200 bytes counted by its hash; texts as hexadecimal digits, which SQL can cut at any byte.
OP4_SQL = r"""
WITH raw AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS body FROM documents
), places AS (
  SELECT rid, unnest(range(0, len(body) // 2 - 199)) AS place FROM raw WHERE len(body) >= 400
), strings AS MATERIALIZED (
  SELECT rid, place, hash(substr(body, 2 * place + 1, 400)) AS string FROM places JOIN raw USING (rid)
), doubled AS (
  SELECT string FROM strings GROUP BY string HAVING count(*) > 1
), starts AS (
  SELECT rid, place FROM strings SEMI JOIN doubled USING (string)
), marked AS (
  SELECT rid, place, CASE WHEN place - lag(place) OVER (PARTITION BY rid ORDER BY place) <= 200 THEN 0 ELSE 1 END AS new FROM starts
), numbered AS (
  SELECT rid, place, sum(new) OVER (PARTITION BY rid ORDER BY place) AS run FROM marked
), spans AS (
  SELECT rid, run, min(place) AS first, max(place) + 200 AS past FROM numbered GROUP BY rid, run
), gaps AS (
  SELECT rid, first AS past, coalesce(lag(past) OVER (PARTITION BY rid ORDER BY first), 0) AS first FROM spans
  UNION ALL
  SELECT rid, len(body) // 2, coalesce(past, 0) FROM raw LEFT JOIN (SELECT rid, max(past) AS past FROM spans GROUP BY rid) USING (rid)
), kept AS (
  SELECT rid, string_agg(substr(body, 2 * first + 1, 2 * (past - first)), '' ORDER BY first) AS body FROM gaps JOIN raw USING (rid) GROUP BY rid
), removed AS (
  SELECT rid, CAST(sum(past - first) AS BIGINT) AS n_removed, count(*) AS n_spans FROM spans GROUP BY rid
)
SELECT doc_id, CAST(len(raw.body) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(kept.body)) AS kept_sha256
FROM raw JOIN kept USING (rid) LEFT JOIN removed USING (rid)
"""
