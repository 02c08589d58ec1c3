"""A Merkle manifest of a table: one hash for the whole, and a proof for every row.

Rows are leaves. The leaves of a part (a language, say) are numbered in order, every ``fanout`` consecutive ones
become the hash of their hashes, and so on until one remains; these, one per part, make a last tree in the same
way. A level is a pivot: conditional aggregates spread the children of a parent into a column per slot, the
columns end to end are hashed, and for a child all columns but its own are its siblings. One grouping takes
several levels at once: it spreads the descendants into columns and hashes neighbouring columns level by level,
so that a table needs few shuffles, each a fraction of the one before. On the way back every group hands its
children what lies beside them, after which its own siblings follow.

Rows are numbered by a range sort, never by a window over a part: a part may hold most of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewheel.llm.common import bounded, documents, stored

#: Slots that one grouping spreads into columns, at most (or one level, if the fanout is larger).
SLOTS = 16
LEAF = ("doc_id", "source", "lang", "n_chars", "text")


def encoded(value: Column) -> Column:
    """``-`` for null, else the length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*map(encoded, values)), 256)


def numbered(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """The rows with ``idx``, their place in their tree, and ``n``, the rows of the tree.

    Sorted by ranges and written; then the ranges' counts, at most one per range and one per tree, say where
    each begins. ``tree`` is not null and sorts first.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, tree, *order).sortWithinPartitions(tree, *order)
    placed = stored(ordered.withColumn("__at", F.monotonically_increasing_id()).withColumn("__range", F.shiftright("__at", 33)), "numbered")
    runs = placed.groupBy(tree, "__range").agg(F.min("__at").alias("__first"), F.count("*").alias("__rows"))
    of_tree = Window.partitionBy(tree)
    before = F.sum("__rows").over(of_tree.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(tree, "__range", (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"), F.sum("__rows").over(of_tree).alias("n"))
    joined = placed.join(bounded(stored(runs, "runs")), [tree, "__range"])
    return joined.withColumn("idx", F.col("__at") + F.col("__shift")).drop("__at", "__range", "__shift")


def _levels(fanout: int) -> int:
    levels = 1
    while fanout ** (levels + 1) <= SLOTS:
        levels += 1
    return levels


def _spread(nodes: DataFrame, fanout: int) -> DataFrame:
    """One row per group of nodes (tree, idx, n, node.hash): ``slots``, an array of (slot, node, path), where a
    path holds what lies left and right of the slot level by level, and the group as a node: idx, n and hash."""
    levels = _levels(fanout)
    width = fanout**levels
    slots = range(width)
    pivot = [F.expr(f"max(CASE WHEN slot = {s} THEN node END) AS node_{s}") for s in slots]
    grouped = nodes.selectExpr("tree", "n", "node", f"idx % {width} AS slot", f"idx div {width} AS idx").groupBy("tree", "idx").agg(F.max("n").alias("n0"), *pivot)
    grouped = grouped.selectExpr("*", *[f"node_{s}.hash AS h0_{s}" for s in slots])
    side = lambda level, run: "concat('', " + ", ".join(f"coalesce(h{level}_{k}, '')" for k in run) + ")" if run else "''"
    for level in range(levels):  # n{level}: nodes of the tree on that level; one alone is not hashed again
        runs = [range(p * fanout, (p + 1) * fanout) for p in range(fanout ** (levels - level - 1))]
        made = [f"CASE WHEN h{level}_{r[0]} IS NULL OR n{level} = 1 THEN h{level}_{r[0]} ELSE sha2({side(level, r)}, 256) END AS h{level + 1}_{p}" for p, r in enumerate(runs)]
        grouped = grouped.selectExpr("*", *made, f"(n{level} + {fanout - 1}) div {fanout} AS n{level + 1}")

    def beside(s: int) -> str:
        out = []
        for level in range(levels):
            at = s // fanout**level
            first = at - at % fanout
            pair = f"named_struct('left', {side(level, range(first, at))}, 'right', {side(level, range(at + 1, first + fanout))})"
            out.append(f"CASE WHEN n{level} > 1 THEN {pair} END")
        return f"array_compact(array({', '.join(out)}))"

    children = [f"CASE WHEN node_{s} IS NOT NULL THEN named_struct('slot', {s}L, 'node', node_{s}, 'path', {beside(s)}) END" for s in slots]
    return grouped.selectExpr("tree", "idx", f"array_compact(array({', '.join(children)})) AS slots", f"n{levels} AS n", f"h{levels}_0 AS hash")


def proofs(leaves: DataFrame, *, fanout: int = 2) -> tuple[DataFrame, DataFrame]:
    """From leaves (tree, idx, n, node), ``node`` a struct that begins with ``hash``: the leaves as (tree, node,
    path), and the roots as (tree, hash). A path is an array of (left, right), from the leaf to the root."""
    width = fanout ** _levels(fanout)
    most = leaves.agg(F.max("n")).first()[0] or 0
    steps = []
    while True:
        steps.append(stored(_spread(leaves, fanout), "spread"))
        if most <= width:
            break
        most = -(-most // width)
        leaves = steps[-1].select("tree", "idx", "n", F.struct("hash").alias("node"))
    roots = steps[-1].select("tree", "hash")
    above = steps[-1].select("tree", "idx", F.array().cast("array<struct<left:string,right:string>>").alias("above"))
    for step in reversed(steps):
        inside = step.select("tree", "idx", "slots").join(above, ["tree", "idx"]).select("tree", "idx", "above", F.explode("slots").alias("s"))
        below = inside.select("tree", (F.col("idx") * width + F.col("s.slot")).alias("idx"), F.col("s.node").alias("node"), F.concat("s.path", "above").alias("above"))
        above = below.select("tree", "idx", "above")
    return below.select("tree", "node", F.col("above").alias("path")), roots


def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and what lies beside it, level by level."""
    return F.aggregate(path, leaf, lambda h, p: F.sha2(F.concat(p["left"], h, p["right"]), 256))


def manifest(rows: DataFrame, *, part: str = "lang", order: str = "doc_id", columns: tuple[str, ...] = LEAF, keep: dict[str, Column] | None = None, fanout: int = 2) -> DataFrame:
    """Per row: ``order``, leaf, subroot (of the row's part), root, path (array of left and right, to the root),
    and the columns of ``keep``.

    A leaf is the hash of its encoded ``columns``; leaves of a part ascend by ``order``, nulls first; parts ascend
    bytewise, null first. Rows equal in ``order`` ascend by leaf, so that their places do not matter: equal
    rows get a proof each. A lone leaf is its subroot, a lone subroot the root. Columns that are not named are
    ignored. An empty table gives no rows. Long texts are hashed where they lie and not moved.
    """
    keep = keep or {}
    own = F.struct(leaf_hash(*[F.col(c) for c in columns]).alias("hash"), F.col(order).alias("id"), *[c.alias(f"keep_{k}") for k, c in keep.items()])
    leaves = rows.select(encoded(F.col(part)).alias("tree"), own.alias("node"), F.col(order).alias("by"), F.col(part).cast("string").alias("label"))
    leaves = numbered(leaves.withColumn("leaf", F.col("node.hash")), "tree", ["by", "leaf"])
    below, subroots = proofs(leaves, fanout=fanout)
    labels = leaves.groupBy("tree").agg(F.first("label").alias("label"))
    tops = subroots.join(labels, "tree").select(F.lit("").alias("tree"), F.struct("hash", F.col("tree").alias("id")).alias("node"), "label")
    beyond, root = proofs(numbered(tops, "tree", ["label"]), fanout=fanout)
    whole = beyond.join(root, "tree").select(F.col("node.id").alias("tree"), F.col("node.hash").alias("subroot"), F.col("hash").alias("root"), F.col("path").alias("beyond"))
    out = below.join(bounded(stored(whole, "subroots")), "tree")
    kept = [F.col(f"node.keep_{k}").alias(k) for k in keep]
    return out.select(F.col("node.id").alias(order), F.col("node.hash").alias("leaf"), "subroot", "root", F.concat("path", "beyond").alias("path"), *kept)


def op13_slot_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    other = leaf_hash(*[F.col(c) + 1 if c == "n_chars" else F.col(c) for c in LEAF])
    hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    rows = manifest(docs, keep={"tampered": F.when(hit, other)})
    beside = F.array_join(F.transform("path", lambda p: F.concat(p["left"], p["right"])), "")
    rows = rows.select("doc_id", "leaf", "subroot", "root", F.sha2(beside, 256).alias("proof_sha256"), fold(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def _tree_sql(leaves: str, name: str) -> str:
    """All nodes of the trees of a view (tree, idx, n, hash)."""
    return f"""{name} AS (
  SELECT tree, CAST(0 AS BIGINT) AS level, idx, n, hash FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, idx // 2, (any_value(n) + 1) // 2, sha256(string_agg(hash, '' ORDER BY idx)) FROM {name} WHERE n > 1 GROUP BY tree, level, idx // 2
)"""


def _encoded_sql(value: str) -> str:
    return f"coalesce(CAST(strlen(CAST({value} AS VARCHAR)) AS VARCHAR) || ':' || CAST({value} AS VARCHAR), '-')"


#: crc32 of a number's decimal text, bit by bit.
_CRC_SQL = """xor(list_reduce(list_transform(string_split(CAST({} AS VARCHAR), ''), lambda t: CAST(ascii(t) AS BIGINT)),
           lambda h, b: list_reduce(range(8), lambda x, i: xor(x >> 1, (x & 1) * 3988292384), xor(h, b)), CAST(4294967295 AS BIGINT)), 4294967295)"""

#: Trees level by level, siblings by their place, proofs folded level by level.
OP13_SQL = f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, {_encoded_sql('lang')} AS tree, lang AS label, row_number() OVER (ORDER BY doc_id) AS leaf_id,
         sha256({' || '.join(_encoded_sql(c) for c in LEAF)}) AS leaf,
         sha256({' || '.join(_encoded_sql('n_chars + 1' if c == 'n_chars' else c) for c in LEAF)}) AS other
  FROM documents
), leaves AS (
  SELECT *, leaf AS hash, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n FROM rows
), {_tree_sql('leaves', 'nodes')}, tops AS (
  SELECT r.tree, r.hash AS subroot, row_number() OVER (ORDER BY l.label NULLS FIRST) - 1 AS place
  FROM nodes r JOIN (SELECT DISTINCT tree, label FROM leaves) l USING (tree) WHERE r.n = 1
), top_leaves AS (
  SELECT '' AS tree, place AS idx, count(*) OVER () AS n, subroot AS hash FROM tops
), {_tree_sql('top_leaves', 'top_nodes')}, root AS (
  SELECT hash AS root FROM top_nodes WHERE n = 1
), heights AS (
  SELECT tree, max(level) AS height FROM nodes GROUP BY tree
), steps AS (
  SELECT l.leaf_id, v.level AS step, (l.idx >> v.level) & 1 AS slot, coalesce(s.hash, '') AS beside
  FROM leaves l JOIN (SELECT DISTINCT tree, level FROM nodes WHERE n > 1) v USING (tree)
  LEFT JOIN nodes s ON s.tree = l.tree AND s.level = v.level AND s.idx = xor(l.idx >> v.level, 1)
  UNION ALL
  SELECT l.leaf_id, h.height + v.level, (t.place >> v.level) & 1, coalesce(s.hash, '')
  FROM leaves l JOIN heights h USING (tree) JOIN tops t USING (tree), (SELECT DISTINCT level FROM top_nodes WHERE n > 1) v
  LEFT JOIN top_nodes s ON s.level = v.level AND s.idx = xor(t.place >> v.level, 1)
), whole AS (
  SELECT l.leaf_id, l.doc_id, l.leaf, t.subroot, r.root, l.tree,
         CASE WHEN {_CRC_SQL.format('l.doc_id')} % 7 = 0 THEN l.other ELSE l.leaf END AS start
  FROM leaves l JOIN tops t USING (tree), root r
), proof AS (
  SELECT w.leaf_id, sha256(coalesce(string_agg(s.beside, '' ORDER BY s.step), '')) AS proof_sha256
  FROM whole w LEFT JOIN steps s USING (leaf_id) GROUP BY w.leaf_id
), folded AS (
  SELECT leaf_id, CAST(0 AS BIGINT) AS step, start AS hash FROM whole
  UNION ALL
  SELECT f.leaf_id, f.step + 1, sha256(CASE WHEN s.slot = 0 THEN f.hash || s.beside ELSE s.beside || f.hash END)
  FROM folded f JOIN steps s ON s.leaf_id = f.leaf_id AND s.step = f.step
)
SELECT w.doc_id, w.leaf, w.subroot, w.root, p.proof_sha256, f.hash AS folded_root, f.hash = w.root AS verified
FROM whole w JOIN proof p USING (leaf_id)
JOIN (SELECT leaf_id, max_by(hash, step) AS hash FROM folded GROUP BY leaf_id) f USING (leaf_id)
"""
