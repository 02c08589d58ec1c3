"""Near-duplicate documents by an LSH forest over MinHash signatures.

A document is the set of its five-word shingles. Documents with equal sets are one node. Each tree of
the forest sorts the nodes by its own run of minhashes; nodes with a longest common prefix of two or
more values are in one region. The depth adapts to the region: a small region is compared whole at the
depth where it is small. In a larger one a node meets its neighbour in the sorted order, which shares the
longest prefix, those with which it lies in a small region further down, and the first nodes of the widest
and the deepest region it lies in. Regions are never gathered: the order is cut into ranges
anywhere, and a task keeps a few rows.

Candidates whose signatures agree too little are dropped, the rest are confirmed on the full sets. As a
component needs no more than a spanning tree, the most alike pair of each node is confirmed first, then
of each pair of components, and last every candidate that still lies between two components: no candidate
between different components goes unchecked.

That leaves the pairs that met in large regions only. Their nodes are joined exactly: the shingles of a set are
ordered from rare to common, and two sets that are similar enough share one among the first of each, how many
follows from both sizes. What a family of documents has in common comes last in that order, so members that
are not alike enough share none of the first ones. Nodes of one shingle are compared only across components,
the small ones with all, in blocks of bounded size; most shingles lie in one component and are dropped whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm.common import LOWER, Hashes, chunks, documents, mixed, stored, text_bytes, word_ranges

WORDS = 5
TREES = 16
DEPTH = 8
LEAST_PREFIX = 2
#: Neighbours in the sorted order, on either side, that a node meets in each tree.
REACH = 8
#: Signatures of sets with a similarity of 0.75 agree in fewer than this share of 128 values once in
#: about a million pairs.
LEAST_AGREEMENT = 0.56
#: Rows of one shingle that a task compares with as many others at a time.
BLOCK = 100_000
#: Counters of the sketch that orders shingles by how common they are, as a power of two; four bytes each.
SKETCH_BITS = 21
#: Ids that are broadcast at most, when the sets of candidates are fetched; more are joined by a shuffle.
BROADCAST_IDS = 500_000

_rng = np.random.default_rng(74207281)
_A = _rng.integers(1, 1 << 63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64)


def shingles(column: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text, sorted per text, and where each text's begin."""
    data, at = text_bytes(column)
    data = LOWER[data]
    starts, ends, row = word_ranges(data, at)
    rows = len(at) - 1
    word = Hashes(data).of(starts, ends)
    n_words = np.bincount(row, minlength=rows)
    first = np.cumsum(n_words) - n_words
    n = np.where(n_words >= words, n_words - words + 1, np.minimum(n_words, 1))
    begin = np.cumsum(n) - n
    of = np.repeat(np.arange(rows), n)
    at_word = first[of] + np.arange(len(of)) - begin[of]
    size = np.minimum(n_words[of], words)
    value = mixed(size.astype(np.uint64))
    for k in range(words):
        has = size > k
        value[has] = mixed(value[has] * np.uint64(0x9E3779B97F4A7C15) + word[at_word[has] + k])
    for a, b in zip(begin.tolist(), (begin + n).tolist()):
        value[a:b].sort()
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
    count = np.bincount(of[new], minlength=rows)
    return value[new], np.concatenate([[0], np.cumsum(count)])


def signatures(value: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A row of 32-bit minhashes for each set; sets are not empty."""
    out = np.empty((len(at) - 1, TREES * DEPTH), np.uint32)
    if len(value):
        for k in range(TREES * DEPTH):
            out[:, k] = np.minimum.reduceat((value * _A[k] + _B[k]) >> np.uint64(32), at[:-1])
    return out


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, digest of the set, and signature (null without shingles)."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, most=2 << 20):
            value, at = shingles(chunk.column("text"))
            n = np.diff(at)
            some = np.flatnonzero(n)
            signed = signatures(value, np.append(at[:-1][some], len(value))).astype(">u4")
            raw = [None] * len(n)
            digest = [None] * len(n)
            for k, r in zip(some.tolist(), signed):
                raw[k] = r.tobytes()
                digest[k] = hashlib.blake2b(value[at[k] : at[k + 1]].tobytes(), digest_size=16).digest()
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id").cast(pa.int64()), pa.array(n.astype(np.int64)), pa.array(digest, pa.binary()), pa.array(raw, pa.binary())],
                ["doc_id", "n_shingles", "digest", "signature"],
            )

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return plain.mapInArrow(made, "doc_id long, n_shingles long, digest binary, signature binary")


class _Wide:
    """Nodes in regions of the least depth that are larger than what is compared whole, or that reach an end of
    the rows of a task, where their size is not known."""

    def __init__(self) -> None:
        self.run, self.held, self.length, self.first = None, np.zeros(0, np.int64), 0, True

    def _closed(self) -> np.ndarray:
        out = self.held if self.first or self.length > REACH + 1 else self.held[:0]
        self.first = False
        return out

    def add(self, tree: np.ndarray, path: np.ndarray, node: np.ndarray) -> np.ndarray:
        key = np.column_stack([tree, path[:, :LEAST_PREFIX].astype(np.int64)])
        starts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(1)))
        ends = np.append(starts[1:], len(node))
        out = []
        if self.run is not None and (key[0] == self.run).all():
            self.length += int(ends[0])
            self.held = np.concatenate([self.held, node[: ends[0]]])
            starts, ends = starts[1:], ends[1:]
        if len(starts):
            if self.run is not None:
                out.append(self._closed())
            size = ends - starts
            if self.run is None and len(starts) > 1:  # the first of the task
                out.append(node[: ends[0]])
                size[0] = 0
            self.first = self.run is None and len(starts) == 1
            size[-1] = 0
            large = np.repeat(size > REACH + 1, ends - starts)
            out.append(node[starts[0] :][large])
            self.held, self.length = node[starts[-1] : ends[-1]], int(ends[-1] - starts[-1])
        self.run = key[-1]
        if self.length > REACH + 1:
            out.append(self.held)
            self.held = self.held[:0]
        return np.concatenate(out) if out else node[:0]


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs from rows (tree, path, node) in sorted order; a node of a wide region as (null, node)."""
    wide = _Wide()
    tree, path, node = np.zeros(0, np.int64), np.zeros((0, DEPTH), ">u4"), np.zeros(0, np.int64)
    heads = [None] * (DEPTH + 1)  # of the region, per depth, that the last row lies in
    for batch in batches:
        if not batch.num_rows:
            continue
        kept = len(tree)
        more = np.frombuffer(b"".join(batch.column("path").to_pylist()), ">u4").reshape(-1, DEPTH)
        tree = np.concatenate([tree, batch.column("tree").to_numpy()])
        path = np.concatenate([path, more])
        node = np.concatenate([node, batch.column("node").to_numpy()])
        marks = wide.add(tree[kept:], path[kept:], node[kept:])
        size = len(tree)
        common = np.zeros(size, np.int64)  # values shared with the row before
        same = tree[1:] == tree[:-1]
        for d in range(DEPTH):
            same = same & (path[1:, d] == path[:-1, d])
            common[1:][same] = d + 1
        index = np.arange(size)
        starts = np.zeros((DEPTH + 1, size), np.int64)  # where the region of each depth begins
        for d in range(LEAST_PREFIX, DEPTH + 1):
            starts[d] = np.maximum.accumulate(np.where(common >= d, 0, index))
        pairs = []
        within = np.full(size, DEPTH, np.int64)  # shared with the row k before
        for k in range(1, min(REACH, size - 1) + 1):
            within[k:] = np.minimum(within[k:], common[1 : size - k + 1])
            within[:k] = 0
            hit = np.flatnonzero(within >= LEAST_PREFIX)
            hit = hit[hit >= max(kept, k)]
            if k > 1:  # whole, as far as the region that both are in is small
                hit = hit[hit - starts[within[hit], hit] <= REACH]
            pairs.append((node[hit], node[hit - k]))
        for d in range(LEAST_PREFIX, DEPTH + 1):
            head = node[starts[d]]
            if kept and heads[d] is not None:
                head = np.where(starts[d] == 0, heads[d], head)  # begun before the rows kept
            far = index[kept:][(index[kept:] - starts[d, kept:] > REACH) | ((starts[d, kept:] == 0) & (kept > 0))]
            if d > LEAST_PREFIX:  # of the widest region and of the deepest
                far = far[common[far] == d]
            pairs.append((node[far], head[far]))
            heads[d] = int(head[-1])
        a, b = (np.concatenate(x) for x in zip(*pairs))
        low, high = np.minimum(a, b), np.maximum(a, b)
        both = np.unique(np.column_stack([low, high])[low != high], axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])
        marks = np.unique(marks)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(marks), pa.int64()), pa.array(marks)], ["a", "b"])
        tree, path, node = tree[-REACH:], path[-REACH:], node[-REACH:]
    if len(wide.held):
        rest = np.unique(wide.held)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(rest), pa.int64()), pa.array(rest)], ["a", "b"])


def candidates(nodes: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of nodes (node, signature) that meet in some tree, and (null, b) for each node of a
    region that is too large to be compared whole."""
    width = 4 * DEPTH
    paths = F.array(*[F.struct(F.lit(t).cast("long").alias("tree"), F.substring("signature", 1 + t * width, width).alias("path")) for t in range(TREES)])
    rows = nodes.select("node", F.explode(paths).alias("p")).select("p.tree", "p.path", "node")
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "tree", "path", "node").sortWithinPartitions("tree", "path", "node")
    return ordered.mapInArrow(_neighbours, "a long, b long").distinct()


def _short(nodes: DataFrame) -> DataFrame:
    """node and the last byte of each value of its signature: enough to compare, and a quarter to move."""

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = [r[3::4] for r in b.column("signature").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(values, pa.binary())], ["node", "bytes"])

    return nodes.mapInArrow(short, "node long, bytes binary")


def _agreeing(pairs: DataFrame, small: DataFrame, least: float) -> DataFrame:
    """a, b and in how many values the signatures agree, where they agree enough."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(b.num_rows, -1) for c in ("of_a", "of_b"))
            agree = (x == y).sum(1)
            near = np.flatnonzero(agree >= least * TREES * DEPTH)
            yield pa.RecordBatch.from_arrays([b.column("a").take(pa.array(near)), b.column("b").take(pa.array(near)), pa.array(agree[near])], ["a", "b", "agree"])

    both = pairs.join(small.select(F.col("node").alias("a"), F.col("bytes").alias("of_a")), "a").join(
        small.select(F.col("node").alias("b"), F.col("bytes").alias("of_b")), "b"
    )
    return both.mapInArrow(compared, "a long, b long, agree long")


def _sketch(sets: DataFrame) -> np.ndarray:
    """Roughly how many of the sets hold a shingle, by its first bits: a table of fixed size, summed block by
    block. It only orders shingles; any order gives the same pairs."""
    block = 1 << 14

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for b in batches:
            for raw in b.column("hashes"):
                np.add.at(total, np.frombuffer(raw.as_buffer(), np.uint64) >> np.uint64(64 - SKETCH_BITS), 1)
        parts = np.minimum(total, 1 << 30).astype(np.uint32).reshape(-1, block)
        some = np.flatnonzero(parts.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array([parts[k].tobytes() for k in some.tolist()], pa.binary())], ["block", "counts"])

    def summed(part: pa.Table) -> pa.Table:
        total = np.zeros(block, np.int64)
        for raw in part.column("counts"):
            total += np.frombuffer(raw.as_buffer(), np.uint32)
        return pa.table({"block": part.column("block")[:1], "counts": pa.array([np.minimum(total, 1 << 30).astype(np.uint32).tobytes()], pa.binary())})

    rows = sets.mapInArrow(counted, "block long, counts binary").groupBy("block").applyInArrow(summed, "block long, counts binary")
    out = np.zeros((1 << SKETCH_BITS) // block * block, np.uint32).reshape(-1, block)
    for r in rows.collect():  # the sketch, of fixed size
        out[r.block] = np.frombuffer(r.counts, np.uint32)
    return out.ravel()


def _least_overlap(x: np.ndarray, y: np.ndarray, similarity: int) -> np.ndarray:
    """Shingles that sets of these sizes must share to be similar enough in percent."""
    return -(-similarity * (x + y) // (100 + similarity))


def _firsts(sets: DataFrame, sketch: np.ndarray, similarity: int) -> DataFrame:
    """shingle, node, component, size and place of the rarest shingles of every set (node, component, hashes): as
    many as any similar set can make necessary."""
    order = sets.sparkSession.sparkContext.broadcast(sketch)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = order.value
        for b in batches:
            found, sizes = [], []
            for raw in b.column("hashes"):
                value = np.frombuffer(raw.as_buffer(), np.uint64)
                most = len(value) - -(-similarity * len(value) // 100) + 1
                by = np.lexsort((value, counts[value >> np.uint64(64 - SKETCH_BITS)]))
                found.append(value[by[:most]])
                sizes.append(len(value))
            n = np.array([len(v) for v in found], np.int64)
            of = np.repeat(np.arange(len(n)), n)
            place = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            columns = [pa.array(np.concatenate(found or [np.zeros(0, np.uint64)]).view(np.int64)), b.column("node").take(pa.array(of)), b.column("component").take(pa.array(of)), pa.array(np.array(sizes, np.int64)[of]), pa.array(place)]
            yield pa.RecordBatch.from_arrays(columns, ["shingle", "node", "component", "size", "place"])

    return sets.mapInArrow(made, "shingle long, node long, component long, size long, place long")


def _across(firsts: DataFrame, similarity: int) -> DataFrame:
    """Distinct pairs (a, b) of nodes in different components that share one of their first shingles, as far in
    front as their sizes demand.

    Of each shingle the rows outside its largest component ask, all rows answer; both in blocks.
    """
    per = firsts.groupBy("shingle", "component").agg(F.count("*").alias("n"))
    lists = per.groupBy("shingle").agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.max_by("component", F.struct("n", "component")).alias("largest"), F.count("*").alias("parts"))
    lists = lists.where("parts > 1").select("shingle", "largest", F.ceil(F.col("n") / BLOCK).alias("blocks"), F.ceil((F.col("n") - F.col("most")) / BLOCK).alias("asks"))
    rows = firsts.join(lists, "shingle")
    key = ["shingle", "block", "ask"]
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    part = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    plain = ["shingle", "node", "component", "size", "place"]
    asking = rows.where("component <> largest").select(*plain, part("asks").alias("ask"), every("blocks").alias("block"))
    having = rows.select(*plain, part("blocks").alias("block"), every("asks").alias("ask"))
    both = asking.withColumn("asks_", F.lit(True)).unionByName(having.withColumn("asks_", F.lit(False)))

    def compared(rows: pa.Table) -> pa.Table:
        node, component, size, place, asks = (rows.column(c).to_numpy() for c in ("node", "component", "size", "place", "asks_"))
        have = np.flatnonzero(~asks)
        out = [(np.zeros(0, np.int64),) * 2]
        for k in np.flatnonzero(asks).tolist():
            need = _least_overlap(size[have], size[k], similarity)
            fits = (component[have] != component[k]) & (place[have] <= size[have] - need) & (place[k] <= size[k] - need)
            hit = node[have[fits]]
            out.append((np.minimum(hit, node[k]), np.maximum(hit, node[k])))
        a, b = map(np.concatenate, zip(*out))
        pairs = np.unique(np.column_stack([a, b]), axis=0)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return both.groupBy(*key).applyInArrow(compared, "a long, b long").distinct()


def _sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """node and its sorted shingle hashes, for the wanted ids."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            value, at = shingles(chunk.column("text"))
            raw = [value[a:b].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays([chunk.column("node"), pa.array(raw, pa.binary())], ["node", "hashes"])

    wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(wanted, "node")
    return texts.mapInArrow(made, "node long, hashes binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, in percent."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for k, (x, y) in enumerate(zip(batch.column("of_a"), batch.column("of_b"))):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(x) + len(y) - len(np.union1d(x, y))
                if 100 * both >= similarity * (len(x) + len(y) - both):
                    keep.append(k)
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(keep, pa.int64())) for c in ("a", "b")], ["a", "b"])

    of = lambda c: sets.select(F.col("node").alias(c), F.col("hashes").alias(f"of_{c}"))
    return pairs.select("a", "b").join(of("a"), "a").join(of("b"), "b").mapInArrow(compared, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """node and component (the smallest node reachable) of every node of the links (a, b).

    Rounds of large-star and small-star: every node hands the smallest neighbour to the larger ones,
    then to the smaller ones, until nothing changes.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        edges = stored(small.select("e.u", "e.v").where("u <> v").distinct(), "edges")
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(state) == seen:
            roots = edges.select(F.col("v").alias("u"), "v").distinct()
            return edges.union(roots).select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = tuple(state)


def _between(near: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The pairs with the components of their ends, where these differ."""
    if labels is None:
        return near.withColumn("of_a", F.col("a")).withColumn("of_b", F.col("b"))
    of = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}"))
    named = near.join(of("a"), "a", "left").join(of("b"), "b", "left")
    return named.withColumn("of_a", F.coalesce("of_a", "a")).withColumn("of_b", F.coalesce("of_b", "b")).where("of_a <> of_b")


def _merged(labels: DataFrame | None, found: DataFrame) -> DataFrame | None:
    """The components with links (a, b) added. Only components that a link joins are searched, as nodes of a
    graph of their own."""
    if found.isEmpty():
        return labels
    if labels is None:
        return components(found)
    ends = stored(_between(found, labels), "ends")
    roots = components(ends.select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))).select(F.col("component").alias("root"), F.col("node").alias("component"))
    alone = F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("of_a").alias("component")), F.struct(F.col("b").alias("node"), F.col("of_b").alias("component"))))
    members = labels.union(ends.select(alone.alias("e")).select("e.*")).distinct()
    return stored(members.join(roots, "component", "left").select("node", F.coalesce("root", "component").alias("component")), "labels")


def _picked(open_: DataFrame, step: str) -> DataFrame:
    # pairs that are alike for sure meet at the smallest node, others at the most alike
    rank = F.struct((F.col("agree") >= 0.85 * TREES * DEPTH).alias("sure"), F.when(F.col("agree") >= 0.85 * TREES * DEPTH, -F.col("other")).otherwise(F.col("agree")).alias("order"), "a", "b")
    if step == "nodes":
        ends = F.array(F.struct(F.col("of_a").alias("end"), F.col("of_b").alias("other")), F.struct(F.col("of_b").alias("end"), F.col("of_a").alias("other")))
        sides = open_.select("a", "b", "agree", F.explode(ends).alias("e")).select("a", "b", "agree", "e.*")
        return sides.groupBy("end").agg(F.max(rank).alias("r")).select("r.a", "r.b").distinct()
    if step == "components":
        key = [F.least("of_a", "of_b"), F.greatest("of_a", "of_b")]
        return open_.groupBy(*key).agg(F.max(F.struct("agree", "a", "b")).alias("r")).select("r.a", "r.b").distinct()
    return open_.select("a", "b")


def link(docs: DataFrame, *, similarity: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document.

    Documents are linked when 100 * intersection >= ``similarity`` * union of their shingle sets; a
    component's id is its smallest doc_id. ``docs`` needs doc_id and text; other columns are ignored.
    Null, empty and wordless texts have no shingles and are linked with nothing. A null doc_id is linked
    with nothing, has a null component and is kept. Rows are told apart by doc_id: repeated rows come
    back once each with the same component. An empty table gives no rows.
    """
    sketches = stored(sketched(docs), "sketches")
    usable = sketches.where("doc_id is not null and n_shingles > 0")
    groups = usable.groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("signature").alias("signature"))
    groups = stored(groups, "nodes")
    nodes = groups.select("node", "signature")
    small = stored(_short(nodes), "signatures")
    met = stored(candidates(nodes), "met")
    wide = met.where("a IS NULL").select(F.col("b").alias("node"))
    near = stored(_agreeing(met.where("a IS NOT NULL"), small, LEAST_AGREEMENT), "near")
    wanted = near.select(F.explode(F.array("a", "b")).alias("node")).union(wide).distinct()
    sets = stored(_sets(docs, wanted), "sets")
    labels = None

    def settle(pairs: DataFrame, steps: tuple[str, ...]) -> None:
        nonlocal labels
        for step in steps:
            open_ = stored(_between(pairs, labels), "between")
            if open_.isEmpty():
                return
            picked = stored(_picked(open_, step), "picked")
            labels = _merged(labels, stored(_confirmed(picked, sets, similarity), "found"))
            pairs = open_.select("a", "b", "agree").join(picked, ["a", "b"], "left_anti")

    settle(near, ("nodes", "components", "all"))
    members = sets.join(wide, "node")
    if labels is not None:
        members = members.join(labels, "node", "left")
    else:
        members = members.withColumn("component", F.col("node"))
    members = members.select("node", F.coalesce("component", "node").alias("component"), "hashes")
    if not wide.isEmpty():
        firsts = stored(_firsts(members, _sketch(members), similarity), "firsts")
        labels = _merged(labels, stored(_confirmed(stored(_across(firsts, similarity), "more"), sets, similarity), "found"))
    named = groups.select("digest", "node")
    if labels is not None:
        named = named.join(labels, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
    else:
        named = named.select("digest", F.col("node").alias("component"))
    rows = sketches.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op2_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(documents(spark, sf_dir))


#: All pairs with a shingle in common, linked, and every node with the smallest one that reaches it.
OP2_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), sets AS MATERIALIZED (
  SELECT doc_id, list_distinct(CASE WHEN len(words) >= 5 THEN list_transform(range(1, len(words) - 3), lambda k: array_to_string(words[k : k + 4], ' '))
                                    WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingles
  FROM worded
), sizes AS (
  SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles FROM sets
), held AS MATERIALIZED (
  SELECT doc_id, unnest(shingles) AS shingle FROM sets
), met AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM held a JOIN held b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY ALL
), links AS MATERIALIZED (
  SELECT a, b FROM met JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common >= 75 * (x.n_shingles + y.n_shingles - common)
), reached AS (
  SELECT DISTINCT a AS root, a AS node FROM (SELECT a FROM links UNION SELECT b FROM links)
  UNION
  SELECT r.root, e.b FROM reached r JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) e ON e.a = r.node WHERE e.b > r.root
), components AS (
  SELECT node, min(root) AS component FROM reached GROUP BY node
)
SELECT doc_id, n_shingles, coalesce(component, doc_id) AS component_id, coalesce(component, doc_id) = doc_id AS kept
FROM sizes LEFT JOIN components ON node = doc_id
"""
