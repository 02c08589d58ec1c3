"""Shared pieces: stored intermediate tables, Arrow chunks, words and hashes in numpy."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.session import shared_folder

#: Bytes of text that one numpy pass works on; a single longer text is a pass of its own.
CHUNK_BYTES = 4 << 20

#: The bytes between words: space, and tab to carriage return.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

#: Lower case of A-Z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER_TABLE = LOWER.tobytes()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and go on from the written copy, so
    that lost executors cost no recomputation and the lineage is cut."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, key: str, name: str) -> DataFrame:
    """Like ``stored``, but the copy is kept in buckets of ``key``: what is grouped or joined by it later
    comes to these rows, and they are not shuffled. Written without a shuffle."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = df.write.bucketBy(parts, key).option("compression", "zstd")
    out.option("path", f"{shared_folder(spark)}/{table}").saveAsTable(table)
    return spark.table(table)


#: Rows of one or two numbers that are broadcast at most.
BROADCAST_ROWS = 500_000


def bounded(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A written table, to be broadcast if it is proven small; beyond the bound Spark joins it by a
    shuffle."""
    return F.broadcast(df) if df.count() <= most else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def filled(column: pa.Array, blank) -> pa.Array:
    """The column as one array, nulls replaced."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column, blank) if column.null_count else column


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a string column end to end as bytes, and where each begins (one more offset
    than rows). A null text is empty."""
    column = filled(column, "")
    _, offsets, data = column.buffers()
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    at = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if not len(at) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``most`` bytes of text each, or one row."""
    for batch in batches:
        column = filled(batch.column(batch.schema.get_field_index(text)), "")
        ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < batch.num_rows:
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + most, "right")))
            yield batch.slice(first, last - first)
            first = last


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64), in place of weak low bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Hashes:
    """Hashes of any byte ranges of a text, from sums of ``table[byte] * BASE**position``."""

    BASE = 0x9E3779B97F4A7C15
    INVERSE = pow(BASE, -1, 1 << 64)
    TABLE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
    _powers: dict[int, np.ndarray] = {}

    @classmethod
    def powers(cls, base: int, n: int) -> np.ndarray:
        have = cls._powers.get(base)
        if have is None or len(have) < n:
            size = 1 << max(20, int(n).bit_length())
            have = np.ones(size, np.uint64)
            if size > 1:
                have[1:] = np.uint64(base)
                np.multiply.accumulate(have, out=have)
            cls._powers[base] = have
        return have[:n]

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.TABLE[data] * self.powers(self.BASE, len(data)), out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        shift = self.powers(self.INVERSE, len(self.sums))[starts]
        return mixed((self.sums[ends] - self.sums[starts]) * shift + (ends - starts).astype(np.uint64))


def word_ranges(data: np.ndarray, at: np.ndarray, spaces: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word, by default ``[^\\x20\\x09-\\x0D]+``; words end where their text
    ends."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~spaces[data]
    firsts = at[:-1][at[:-1] < len(data)]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    before[firsts] = False
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[firsts[firsts > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(at, starts, "right") - 1


def gathered(flat: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The runs ``flat[first[i] : first[i] + count[i]]`` end to end."""
    ends = np.cumsum(count)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(first - (ends - count), count) + np.arange(total)]


class Lookup:
    """Places of 64-bit keys among sorted distinct ones that hold them all: by a table of hashes, which is
    several times as fast as a search, and by a search where two keys share a slot."""

    def __init__(self, names: np.ndarray):
        self.names = names
        self.shift = np.uint64(64 - max(4, int(8 * len(names) + 1).bit_length()))
        self.table = np.zeros(1 << (64 - int(self.shift)), np.int32)
        self.table[self._slot(names)] = np.arange(len(names), dtype=np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def of(self, keys: np.ndarray) -> np.ndarray:
        at = self.table[self._slot(keys)]
        miss = np.flatnonzero(self.names[at] != keys) if len(self.names) else np.arange(0)
        at[miss] = np.searchsorted(self.names, keys[miss])
        return at


def crc_text(ids: list) -> np.ndarray:
    """crc32 of each id's decimal text; -1 for null, which belongs to no fold."""
    import zlib

    return np.array([-1 if i is None else zlib.crc32(str(i).encode()) for i in ids], np.int64)


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name].cast(f.type) for f in schema], schema=schema)
