"""A Merkle manifest of a dataset in van Emde Boas layout (operator 13).

1. Every row is a leaf: the SHA-256 of its fields, computed by Spark's own
   functions. Narrow leaf rows get their position within their language by a
   range sort and distributed prefix sums; texts are not shuffled.
2. ``2**HEIGHT`` consecutive leaves are an aligned subtree. One task call builds
   it and stores its nodes as one binary of 32-byte digests in van Emde Boas
   order: a tree is split at half its height into a top tree and bottom trees,
   each stored in one run and split again. ``address`` is the arithmetic of that
   order; construction follows the same recursion.
3. The roots of the subtrees are the leaves of the next level, grouped again,
   until one node is left (level by level, the rows shrink ``2**HEIGHT`` fold).
   The subroots of the languages then go through the same steps as one tree.
4. From the top down, each block turns the path of its root into the paths of
   its entries: siblings are fetched by address. On the lowest level each leaf
   gets its siblings and is folded up again.

The tables of nodes are the manifest: a stage a level, a row a block.

Rules: digests are joined as lower-case hex; nodes pair up two by two, a last
one without a partner is hashed alone, while more than one remains.

Defined cases: a null field is ``-``, an empty text ``0:``; the null language is
a tree of its own and comes first; rows with a null id come first in their
tree, rows with equal ids ascend by leaf digest (equal rows are equal leaves);
tampering leaves a null ``n_chars`` and rows with a null id as they are; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm._common import scratch, stage
from lodestar.llm._rank import ranked

#: Levels of a stored subtree above its leaves: 256 leaves, 511 digests, 16 KB.
HEIGHT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: One step of a path: the side of the sibling (b"L", b"R", b"-" for none) and its digest.
STEP = 33

_BLOCKS = "tree string, block long, n long, nodes binary, root string"


def field_text(value: Column) -> Column:
    """``-`` for null, else the value's UTF-8 byte count, a colon and the value."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field_text(v) for v in values]), 256)


# --------------------------------------------------------------------------
# one subtree


def address(levels: int, depth: int, index):
    """Place of node ``index`` (number or array) of ``depth`` in a tree of ``levels`` levels stored in van Emde Boas order."""
    base = index * 0
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        depth -= top
        bottom = index >> depth
        base = base + ((1 << top) - 1) + bottom * ((1 << (levels - top)) - 1)
        index = index - (bottom << depth)
        levels -= top
    return base


def parent(left: str, right: str | None) -> str:
    return sha256((left + (right or "")).encode()).hexdigest()


def build(leaves: list[str], levels: int) -> tuple[bytes, str]:
    """The nodes of one tree of ``levels`` levels in van Emde Boas order (absent ones are zeros), and its root."""
    nodes = np.zeros(((1 << levels) - 1, 32), np.uint8)

    def fill(base: int, levels: int, level: list[str]) -> str:
        if levels == 1:
            nodes[base] = np.frombuffer(bytes.fromhex(level[0]), np.uint8)
            return level[0]
        top = levels // 2
        size, width = (1 << (levels - top)) - 1, 1 << (levels - top - 1)
        roots = [fill(base + (1 << top) - 1 + k * size, levels - top, level[k * width:(k + 1) * width])
                 for k in range(-(-len(level) // width))]
        pairs = [parent(roots[k], roots[k + 1] if k + 1 < len(roots) else None) for k in range(0, len(roots), 2)]
        return fill(base, top, pairs)

    root = fill(0, levels, leaves)
    return nodes.tobytes(), root


def steps(nodes: bytes, m: int, levels: int) -> list[bytes]:
    """For each of the ``m`` leaves of a stored tree its path to the tree's root, ``STEP`` bytes a level."""
    stored = np.frombuffer(nodes, np.uint8).reshape(-1, 32)
    out = np.zeros((m, levels - 1, STEP), np.uint8)
    at, count = np.arange(m), m
    for k in range(levels - 1):
        sibling = at ^ 1
        there = sibling < count
        out[:, k, 0] = np.where(there, np.where(sibling < at, ord("L"), ord("R")), ord("-"))
        out[there, k, 1:] = stored[address(levels, levels - 1 - k, sibling[there])]
        at, count = at >> 1, (count + 1) // 2
    return [x.tobytes() for x in out]


def proof_text(path: bytes) -> str:
    """The siblings of a path as hex text, from the leaf's level up."""
    return "".join(path[k + 1:k + STEP].hex() for k in range(0, len(path), STEP) if path[k] != ord("-"))


def fold(leaf: str, path: bytes) -> str:
    """The root that follows from a leaf and its path."""
    for k in range(0, len(path), STEP):
        sibling = path[k + 1:k + STEP].hex()
        side = path[k]
        leaf = parent(sibling, leaf) if side == ord("L") else parent(leaf, sibling if side == ord("R") else None)
    return leaf


def _levels(n: int, m: int) -> int:
    """Levels of a block with ``m`` of its tree's ``n`` nodes: a block beside others has full height."""
    return HEIGHT + 1 if n > 1 << HEIGHT else (m - 1).bit_length() + 1


# --------------------------------------------------------------------------
# levels of blocks in Spark


def _build_block(table: pa.Table) -> pa.Table:
    order = np.argsort(table.column("pos").to_numpy(), kind="stable")
    leaves = table.column("node").take(pa.array(order)).to_pylist()
    n = table.column("n")[0].as_py()
    nodes, root = build(leaves, _levels(n, len(leaves)))
    return pa.table({"tree": table.column("tree")[:1], "block": table.column("block")[:1],
                     "n": pa.array([n], pa.int64()), "nodes": pa.array([nodes], pa.binary()),
                     "root": pa.array([root])})


def _block(pos: Column) -> Column:
    return F.shiftright(pos, HEIGHT)


def grow(spark: SparkSession, entries: DataFrame, most: int, root: str, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The stored levels over ``entries`` (tree, pos, node, n), lowest first, and (tree, node), each tree's root.

    ``n`` is the number of entries of the tree, ``most`` the largest one.
    """
    levels, tops = [], []
    while True:
        tops.append(entries.where("n = 1").select("tree", "node"))
        if most <= 1:
            break
        blocks = stage(spark, entries.where("n > 1").withColumn("block", _block(F.col("pos")))
                       .select("tree", "block", "pos", "n", "node").groupBy("tree", "block")
                       .applyInArrow(_build_block, _BLOCKS), root, f"{name}{len(levels)}")
        levels.append(blocks)
        entries = blocks.select("tree", F.col("block").alias("pos"), F.col("root").alias("node"),
                                F.shiftright(F.col("n") + ((1 << HEIGHT) - 1), HEIGHT).alias("n"))
        most = (most + (1 << HEIGHT) - 1) >> HEIGHT
    out = tops[0]
    for t in tops[1:]:
        out = out.union(t)
    return levels, out


def _entries(n: int, block: int) -> int:
    return min(n - (block << HEIGHT), 1 << HEIGHT)


def _descend(batches):
    """Blocks with the path of their root to (tree, pos, path) of their entries."""
    for rb in batches:
        for r in rb.to_pylist():
            m = _entries(r["n"], r["block"])
            own = steps(r["nodes"], m, _levels(r["n"], m))
            first = r["block"] << HEIGHT
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["tree"]] * m), pa.array(range(first, first + m), pa.int64()),
                 pa.array([x + r["path"] for x in own], pa.binary())], ["tree", "pos", "path"])


def _rooted(level: DataFrame, paths: DataFrame) -> DataFrame:
    """The blocks of a level with the paths of their roots."""
    up = paths.select("tree", F.col("pos").alias("block"), "path")
    return level.join(up, ["tree", "block"])


def paths_below(spark: SparkSession, levels: list[DataFrame], tops: DataFrame, root: str, name: str) -> DataFrame:
    """Paths (tree, pos, path) of the entries over the lowest of ``levels``, from those of the trees' roots.

    ``tops`` (tree, path); a tree with fewer levels starts where its own nodes end.
    """
    paths = tops.select("tree", F.lit(0).cast("long").alias("pos"), "path")
    for k in reversed(range(1, len(levels))):
        down = _rooted(levels[k], paths).mapInArrow(_descend, "tree string, pos long, path binary")
        ends = paths.join(levels[k].select("tree").distinct(), "tree", "left_anti")
        paths = stage(spark, down.union(ends), root, f"{name}-paths{k}")
    return paths


def _fold_block(leaves: pa.Table, blocks: pa.Table) -> pa.Table:
    """The leaf rows of one block with its stored nodes and path to proofs and folded roots."""
    order = pa.array(np.argsort(leaves.column("pos").to_numpy(), kind="stable"))
    leaves = leaves.take(order)
    paths = [blocks.column("path")[0].as_py()] * leaves.num_rows
    nodes, n = blocks.column("nodes")[0].as_py(), blocks.column("n")[0].as_py()
    if nodes is not None:
        own = steps(nodes, leaves.num_rows, _levels(n, leaves.num_rows))
        paths = [a + b for a, b in zip(own, paths, strict=True)]
    return pa.table({
        "id": leaves.column("id"), "leaf": leaves.column("node"),
        "subroot": pa.array([blocks.column("subroot")[0].as_py()] * leaves.num_rows, pa.string()),
        "proof_sha256": pa.array([sha256(proof_text(p).encode()).hexdigest() for p in paths], pa.string()),
        "folded_root": pa.array([fold(x, p) for x, p in zip(leaves.column("shown").to_pylist(), paths, strict=True)],
                                pa.string())})


def manifest(rows: DataFrame, id_col: str = "doc_id", tree_col: str = "lang",
             fields: Sequence[str] = FIELDS, tampered: dict[str, Column] | None = None) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified), a row per row of ``rows``.

    ``tampered`` maps fields to the values they are verified with; without it
    every row is verified as it is.
    """
    spark = rows.sparkSession
    home = scratch(spark, "merkle")
    kind = rows.schema[id_col].dataType.simpleString()
    shown = [(tampered or {}).get(f, rows[f]) for f in fields]
    tree = F.coalesce(F.concat(F.lit("="), rows[tree_col].cast("string")), F.lit(""))  # null first, then bytewise
    leaves = stage(spark, rows.select(rows[id_col].alias("id"), tree.alias("tree"),
                                      leaf_digest([rows[f] for f in fields]).alias("node"),
                                      leaf_digest(shown).alias("shown"),
                                      F.monotonically_increasing_id().alias("row")), home, "leaves")
    leaves = stage(spark, ranked(spark, leaves, "tree", [F.asc_nulls_first("id"), "node", "row"], home, "rank")
                   .withColumnRenamed("group_rows", "n"), home, "ranked")
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels, subroots = grow(spark, leaves.select("tree", "pos", "node", "n"), most, home, "level")

    forest = stage(spark, ranked(spark, subroots.select(F.lit("").alias("all"), F.col("tree").alias("name"),
                                                        F.col("node").alias("subroot")),
                                 "all", ["name"], home, "forest"), home, "subroots")
    trees = forest.agg(F.max("group_rows")).first()[0] or 0
    above, roots = grow(spark, forest.select(F.col("all").alias("tree"), "pos", F.col("subroot").alias("node"),
                                             F.col("group_rows").alias("n")), trees, home, "above")
    root = (roots.first() or {"node": None})["node"]  # one row: the manifest's root
    tops = roots.select("tree", F.lit(b"").alias("path"))
    tops = paths_below(spark, above, tops, home, "above")
    if above:
        tops = _rooted(above[0], tops).mapInArrow(_descend, "tree string, pos long, path binary")
    tops = stage(spark, forest.join(tops.select("pos", "path"), "pos")
                 .select(F.col("name").alias("tree"), "subroot", "path"), home, "tops")

    paths = paths_below(spark, levels, tops, home, "level").select("tree", F.col("pos").alias("block"), "path")
    if levels:
        blocks = paths.join(levels[0].select("tree", "block", "n", "nodes"), ["tree", "block"], "left")
    else:
        blocks = paths.withColumns({"n": F.lit(1).cast("long"), "nodes": F.lit(None).cast("binary")})
    blocks = blocks.join(tops.select("tree", "subroot"), "tree")
    leaves = leaves.select("tree", _block(F.col("pos")).alias("block"), "pos", "id", "node", "shown")
    out = leaves.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(
        _fold_block, f"id {kind}, leaf string, subroot string, proof_sha256 string, folded_root string")
    return out.select("id", "leaf", "subroot", F.lit(root).cast("string").alias("root"), "proof_sha256",
                      "folded_root", F.col("folded_root").eqNullSafe(F.lit(root)).alias("verified"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    tampered = {"n_chars": F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    return manifest(docs, tampered=tampered).withColumnRenamed("id", "doc_id")


OP13_SQL = r"""
WITH RECURSIVE crc0 AS (
  SELECT range AS i, range::BIGINT AS c FROM range(256)),
crc8 AS (
  SELECT i, c, 0 AS k FROM crc0
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc8 WHERE k < 8),
crc AS (
  SELECT DISTINCT CAST(doc_id AS VARCHAR) AS s, 0 AS k, 4294967295 AS c FROM documents WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT s, crc.k + 1, xor(crc.c >> 8, crc8.c)
  FROM crc JOIN crc8 ON crc8.k = 8 AND crc8.i = xor(crc.c, ascii(substr(s, crc.k + 1, 1))) & 255
  WHERE crc.k < length(s)),
d AS (
  SELECT row_number() OVER () AS row, doc_id, lang, source, n_chars, text,
         CASE WHEN xor(crc.c, 4294967295) % 7 = 0 THEN 1 ELSE 0 END AS hit
  FROM documents LEFT JOIN crc ON crc.s = CAST(doc_id AS VARCHAR) AND crc.k = length(s)),
f AS (
  SELECT row, doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS tree,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
         || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS chars,
         coalesce(strlen(CAST(n_chars + hit AS VARCHAR)) || ':' || (n_chars + hit), '-') AS shown_chars,
         coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM d),
l AS (SELECT row, doc_id, tree, sha256(head || chars || tail) AS leaf, sha256(head || shown_chars || tail) AS shown FROM f),
p AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, row) - 1 AS pos,
         count(*) OVER (PARTITION BY tree) AS n
  FROM l),
t AS (
  SELECT tree, 0 AS lvl, pos, leaf AS h, n FROM p
  UNION ALL
  SELECT tree, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2
  FROM t WHERE n > 1 GROUP BY tree, lvl, pos // 2, n),
s AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (
  SELECT 0 AS lvl, pos, subroot AS h, n FROM s
  UNION ALL
  SELECT lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2
  FROM u WHERE n > 1 GROUP BY lvl, pos // 2, n),
root AS (SELECT h AS root FROM u WHERE n = 1),
steps AS (
  SELECT p.row, t.lvl AS k, t.pos AS at, sib.h AS sib
  FROM p JOIN t ON t.tree = p.tree AND t.pos = p.pos >> t.lvl AND t.n > 1
  LEFT JOIN t sib ON sib.tree = t.tree AND sib.lvl = t.lvl AND sib.pos = xor(t.pos, 1)
  UNION ALL
  SELECT p.row, 1000 + u.lvl, u.pos, sib.h
  FROM p JOIN s ON s.tree = p.tree JOIN u ON u.pos = s.pos >> u.lvl AND u.n > 1
  LEFT JOIN u sib ON sib.lvl = u.lvl AND sib.pos = xor(u.pos, 1)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY k) AS step FROM steps),
proofs AS (SELECT row, sha256(coalesce(string_agg(sib, '' ORDER BY step), '')) AS proof FROM numbered GROUP BY row),
folds AS (
  SELECT row, 0::BIGINT AS step, shown AS h FROM p
  UNION ALL
  SELECT f.row, f.step + 1, sha256(CASE WHEN x.sib IS NULL THEN f.h WHEN x.at % 2 = 1 THEN x.sib || f.h ELSE f.h || x.sib END)
  FROM folds f JOIN numbered x ON x.row = f.row AND x.step = f.step + 1),
folded AS (SELECT row, arg_max(h, step) AS h FROM folds GROUP BY row)
SELECT p.doc_id, p.leaf, s.subroot, root.root, coalesce(proofs.proof, sha256('')) AS proof_sha256,
       folded.h AS folded_root, folded.h = root.root AS verified
FROM p JOIN s ON s.tree = p.tree CROSS JOIN root LEFT JOIN proofs ON proofs.row = p.row JOIN folded ON folded.row = p.row
"""
