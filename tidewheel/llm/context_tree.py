"""Language-model scores by context-tree weighting over bytes.

A document is read as its words in lower case, each closed by a space, and an end byte. Every byte is
eight binary decisions, each with its own context tree over the ``DEPTH`` bytes before. A node's counts
give a Krichevsky-Trofimov estimate; context-tree weighting mixes the estimates of all depths with the
weights that the training text gives them, computed for the whole text at once. Bits after a context that
training never had fall to one half from there on down.

Counting is by distinct byte strings: blocks of documents bring the strings of ``DEPTH + 1`` bytes and the
words they hold, these are summed over all blocks, trees are computed per group of contexts with the same
last two bytes (bounded by the alphabet, not by the corpus; all trees below two bytes are in one group), and the log probability of each string goes
back to the blocks that hold it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm.common import LOWER, SPACES, Hashes, Lookup, chunks, crc_text, documents, stored, stored_by, text_bytes, word_ranges

DEPTH = 5
END = 10
BLOCK_BYTES = 32 << 20
CHUNK = 1 << 20
#: Keys that a row of a block holds.
ROW_KEYS = 1 << 16
LN2 = np.log(2.0)
#: Keys of words are negative, those of strings of bytes are not.
WORD_BIT = np.int64(-1 << 63)
#: The key of the end token among the words.
END_KEY = WORD_BIT
#: Log probabilities travel as whole numbers of this part of a decade: half as many bytes that do not compress.
GRAIN = 1 << 28
#: Strings that one group of trees is made for.
GROUP_STRINGS = 100_000


def plain(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes that are scored, where each document's begin, and the key and row of each word."""
    rows = len(at) - 1
    place = at + 2 * np.arange(rows + 1)  # two more bytes after each text
    wide = np.full(place[-1], 32, np.uint8)
    own = np.ones(len(wide), bool)
    own[place[1:] - 1] = own[place[1:] - 2] = False
    wide[own] = LOWER[data]
    starts, ends, row = word_ranges(wide, place)
    keys = Hashes(wide).of(starts, ends).view(np.int64) | WORD_BIT
    keep = ~SPACES[wide]
    wide[ends] = 32  # what follows a word
    keep[ends] = True
    wide[place[1:] - 1] = END
    keep[place[1:] - 1] = True
    counts = np.add.reduceat(keep, place[:-1], dtype=np.int64) if rows else np.zeros(0, np.int64)
    return wide[keep], np.concatenate([[0], np.cumsum(counts)]), keys, row


def strings(out: np.ndarray, begin: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """For each byte: the ``depth`` bytes before it and the byte itself as one number; END before a text."""
    value = out.astype(np.int64)
    for k in range(1, depth + 1):
        value[k:] |= out[:-k].astype(np.int64) << np.int64(8 * k)
        value[:k] |= np.int64(END) << np.int64(8 * k)
    for k in range(depth):  # the first bytes of a text see nothing of the text before
        first = begin[:-1] + k
        first = first[first < begin[1:]]
        beyond = ((1 << 8 * (depth - k)) - 1) << 8 * (k + 1)
        padding = sum(END << 8 * j for j in range(k + 1, depth + 1))
        value[first] = (value[first] & ~np.int64(beyond)) | np.int64(padding)
    return value


def _distinct(sorted_keys: np.ndarray) -> np.ndarray:
    new = np.ones(len(sorted_keys), bool)
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    return np.flatnonzero(new)


def _counted(keys: np.ndarray, trained: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys and how often each stands in training text."""
    order, own = np.sort(keys), np.sort(keys[trained])
    values, first = order[_distinct(order)], _distinct(own)
    counts = np.zeros(len(values), np.int64)
    counts[np.searchsorted(values, own[first])] = np.diff(np.append(first, len(own)))
    return values, counts


def _merged(one: tuple, two: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and counts of both; the counts of ``one`` are added to in place."""
    keys, counts = one
    at = np.searchsorted(keys, two[0])
    old = at < len(keys)
    old[old] = keys[at[old]] == two[0][old]
    counts[at[old]] += two[1][old]
    return tuple(np.insert(have, at[~old], more[~old]) for have, more in zip((keys, counts), two))


def _blocks(docs: DataFrame) -> DataFrame:
    """Rows of a block: of each chunk, doc_ids, trained, sizes and body (texts end to end, compressed); then
    slices of the block's distinct words and strings (keys) with their counts in training documents. What a
    row does not have is null, so no row is much larger than a chunk."""
    schema = pa.schema(
        [("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("trained", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int64())), ("body", pa.binary()),
         ("keys", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))]
    )

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 30, 0
        found = none = (np.zeros(0, np.int64), np.zeros(0, np.int64))

        def row(**values) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([values.get(f.name)], f.type) for f in schema], schema=schema)

        def strings_found() -> Iterator[pa.RecordBatch]:
            for first in range(0, len(found[0]), ROW_KEYS):
                keys, counts = (x[first : first + ROW_KEYS] for x in found)
                yield row(block=number, keys=keys, counts=counts)

        for chunk in chunks(batches, most=CHUNK):
            data, at = text_bytes(chunk.column("text"))
            doc_ids = chunk.column("doc_id").to_pylist()
            train = crc_text(doc_ids) % 10 != 0
            body = pa.compress(data.tobytes(), codec="zstd", asbytes=True)
            yield row(block=number, doc_ids=doc_ids, trained=train, sizes=np.diff(at), body=body)
            out, begin, keys, of = plain(data, at)
            words = np.concatenate([keys, np.full(len(train), END_KEY)])
            found = _merged(found, _counted(words, np.concatenate([train[of], train])))
            found = _merged(found, _counted(strings(out, begin), np.repeat(train, np.diff(begin))))
            held += len(data)
            if held >= BLOCK_BYTES:
                yield from strings_found()
                number, held, found = number + 1, 0, none
        yield from strings_found()

    fields = "block long, doc_ids array<long>, trained array<boolean>, sizes array<long>, body binary, keys array<long>, counts array<long>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(made, fields)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, after eight steps of the recurrence; for x > 0."""
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    z = x + 8
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - shift


def estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """The log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - np.log(np.pi) - log_gamma(zeros + ones + 1.0)


class Trees:
    """The nodes of all trees below contexts of ``top`` bytes, for strings that share these."""

    def __init__(self, value: np.ndarray, count: np.ndarray, top: int, depth: int = DEPTH):
        self.value, self.top, self.depth, self.count = value, top, depth, count
        self.byte = value & 0xFF

    def bit(self, j: int) -> tuple[np.ndarray, np.ndarray]:
        """The tree that decides bit ``j`` of each string's byte, and the bit."""
        return (1 << j) | (self.byte >> (8 - j)), (self.byte >> (7 - j)) & 1

    def level(self, j: int, d: int) -> dict[str, np.ndarray]:
        tree, bit = self.bit(j)
        node = (((self.value >> 8) & ((1 << 8 * d) - 1)) << 8) | tree
        names, of = np.unique(node, return_inverse=True)
        ones = np.bincount(of, self.count * bit, len(names))
        total = np.bincount(of, self.count, len(names))
        return {"names": names, "of": of, "ones": ones, "zeros": total - ones, "log": estimate(total - ones, ones)}

    def weighted(self, j: int) -> list[dict[str, np.ndarray]]:
        """The levels ``top`` to ``depth`` with their weighted log probability and stopping weight."""
        levels = [self.level(j, d) for d in range(self.top, self.depth + 1)]
        below = None
        for here in reversed(levels):
            if below is None:
                here["weighted"], here["stop"] = here["log"], np.ones(len(here["names"]))
            else:
                parent = np.zeros(len(below["names"]), np.int64)
                parent[below["of"]] = here["of"]
                children = np.bincount(parent, below["weighted"], len(here["names"]))
                here["weighted"] = np.logaddexp(here["log"], children) - LN2
                here["stop"] = np.exp(here["log"] - LN2 - here["weighted"])
            below = here
        return levels

    def mixed(self, j: int) -> np.ndarray:
        """The probability of each string's bit ``j``, mixed over the levels ``top`` to ``depth``."""
        _, bit = self.bit(j)
        q = None
        for here in reversed(self.weighted(j)):
            n = np.where(bit == 1, here["ones"][here["of"]], here["zeros"][here["of"]])
            own = (n + 0.5) / ((here["ones"] + here["zeros"])[here["of"]] + 1)
            stop = here["stop"][here["of"]]
            q = own if q is None else stop * own + (1 - stop) * q
        return q


TOP = 2  # last bytes of a context that a group of strings shares


def _tops(counts: DataFrame, groups: int) -> dict[str, np.ndarray]:
    """Per last byte (row) and tree (column), and for the root: stopping weight, zeros and ones. At most 256 x
    256 numbers each."""

    def roots(group: pa.Table) -> pa.Table:
        value, count = group.column("key").to_numpy(), group.column("n").to_numpy()
        order = np.argsort(value)
        trees = Trees(value[order], count[order], TOP)
        out = []
        for j in range(8):
            here = trees.weighted(j)[0]
            names = here["names"]
            out.append(((names >> 8) & 0xFF, names & 0xFF, here["zeros"], here["ones"], here["weighted"]))
        last, tree, zeros, ones, log = (np.concatenate(x) for x in zip(*out))
        return pa.table({"last": last.astype(np.int32), "tree": tree.astype(np.int32), "zeros": zeros, "ones": ones, "log": log})

    below = counts.groupBy(_group(groups)).applyInArrow(roots, "last int, tree int, zeros double, ones double, log double")
    got = below.groupBy("last", "tree").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "log")]).toArrow()
    at = got.column("last").to_numpy().astype(np.int64), got.column("tree").to_numpy().astype(np.int64)
    grid = {c: np.zeros((256, 256)) for c in ("zeros", "ones", "log")}
    for c in grid:
        grid[c][at] = got.column(c).to_numpy()
    own = estimate(grid["zeros"], grid["ones"])
    weighted = np.logaddexp(own, grid["log"]) - LN2
    out = {"zeros1": grid["zeros"], "ones1": grid["ones"], "stop1": np.exp(own - LN2 - weighted)}
    zeros, ones = grid["zeros"].sum(0), grid["ones"].sum(0)
    own = estimate(zeros, ones)
    weighted = np.logaddexp(own, weighted.sum(0)) - LN2
    return out | {"zeros0": zeros, "ones0": ones, "stop0": np.exp(own - LN2 - weighted)}


def _group(groups: int):
    """Contexts with the same last bytes are in one group; a group has several of them."""
    context = F.shiftright("key", 8).bitwiseAND(F.lit((1 << 8 * TOP) - 1))
    return F.pmod(F.xxhash64(context), F.lit(groups)).alias("contexts")


def string_scores(counts: DataFrame) -> DataFrame:
    """key and log10 probability (in parts of ``GRAIN``) of the last byte of each string after the bytes before
    it. ``counts`` has distinct strings (key) and how often training has them (n, zero for the others)."""
    groups = max(1, counts.count() // GROUP_STRINGS)
    top = _tops(counts, groups)

    def scored(group: pa.Table) -> pa.Table:
        value, count = group.column("key").to_numpy(), group.column("n").to_numpy()
        order = np.argsort(value)
        trees = Trees(value[order], count[order], TOP)
        last = (trees.value >> 8) & 0xFF
        log = np.zeros(len(value))
        for j in range(8):
            tree, bit = trees.bit(j)
            q = trees.mixed(j)
            own1 = (np.where(bit == 1, top["ones1"][last, tree], top["zeros1"][last, tree]) + 0.5) / (top["ones1"][last, tree] + top["zeros1"][last, tree] + 1)
            q = top["stop1"][last, tree] * own1 + (1 - top["stop1"][last, tree]) * q
            own0 = (np.where(bit == 1, top["ones0"][tree], top["zeros0"][tree]) + 0.5) / (top["ones0"][tree] + top["zeros0"][tree] + 1)
            q = top["stop0"][tree] * own0 + (1 - top["stop0"][tree]) * q
            log += np.log10(q)
        return pa.table({"key": trees.value, "value": np.rint(log * GRAIN).astype(np.int64)})

    return counts.groupBy(_group(groups)).applyInArrow(scored, "key long, value long")


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte of every document.

    Documents whose crc32(doc_id) is not divisible by 10 train both models. ``docs`` needs doc_id and text;
    other columns are ignored. A null, empty or wordless text is the end token alone; a null doc_id is kept
    as null and trains; repeated rows come back, and train, once each. An empty table gives no rows.
    """
    blocks = stored_by(_blocks(docs), "block", "scored_blocks")
    held = blocks.select("block", F.explode(F.arrays_zip("keys", "counts")).alias("e")).select(
        "block", F.col("e.keys").alias("key"), F.col("e.counts").alias("n")
    )
    counts = stored(held.groupBy("key").agg(F.sum("n").alias("n")).sortWithinPartitions("key"), "counts")
    words = counts.where("key < 0")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1))).first()
    values = words.select("key", F.col("n").alias("value")).unionByName(string_scores(counts.where("key >= 0")))
    wanted = held.select(F.col("block").alias("asked"), "key").join(stored(values, "values"), "key")
    fields = [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
              ("base_score", pa.float64()), ("score", pa.float64()), ("bits_per_byte", pa.float64())]
    schema = pa.schema(fields)
    most = np.log10(total + 0.1 * (distinct + 1))

    def summed(rows: pa.Table, found: pa.Table) -> pa.Table:
        key, value = (found.column(c).to_numpy() for c in ("key", "value"))
        order = np.argsort(key)
        names, value = Lookup(key[order]), value[order]
        out = []
        for one in rows.select(["doc_ids", "trained", "sizes", "body"]).to_batches(max_chunksize=1):
            row = one.to_pylist()[0]
            sizes = np.array(row["sizes"], np.int64)
            body = np.frombuffer(pa.decompress(row["body"], int(sizes.sum()), codec="zstd") if sizes.sum() else b"", np.uint8)
            at = np.concatenate([[0], np.cumsum(sizes)])
            first = 0
            while first < len(sizes):
                last = max(first + 1, int(np.searchsorted(at, at[first] + CHUNK, "right")) - 1)
                data, begin, keys, of = plain(body[at[first] : at[last]], at[first : last + 1] - at[first])
                n = last - first
                at_byte = np.repeat(np.arange(n), np.diff(begin))
                log = np.bincount(at_byte, value[names.of(strings(data, begin))], n) / GRAIN
                of = np.concatenate([of, np.arange(n)])
                c = value[names.of(np.concatenate([keys, np.full(n, END_KEY)]))]
                base = np.bincount(of, np.log10(c + 0.1) - most, n)
                tokens = np.bincount(of, minlength=n)
                known = np.bincount(of[c > 0], minlength=n)
                held_out = ~np.array(row["trained"][first:last], bool)
                out.append(
                    pa.table(
                        [pa.array(row["doc_ids"][first:last], pa.int64()), held_out, tokens, known, np.full(n, total), base, log, -log / np.log10(2) / np.diff(begin)],
                        schema=schema,
                    )
                )
                first = last
        return pa.concat_tables(out) if out else schema.empty_table()

    text = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    texts = blocks.where("body is not null").select("block", "doc_ids", "trained", "sizes", "body")
    return texts.groupBy("block").cogroup(wanted.groupBy("asked")).applyInArrow(summed, text)


def op9_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir))
