"""Near-duplicate documents: banded MinHash with sequential Bayesian verification (operator 8).

1. Each text becomes the set of its 5-word shingles (64-bit hashes) and a
   MinHash signature. Documents with equal sets are one node from here on, so
   a group of exact copies is one row.
2. Bands of the signature are bucket keys. A first round pairs every member of
   a bucket with the bucket's smallest node, not with every other member.
3. A pair's signatures are compared batch by batch. With m matches of n, the
   posterior of the similarity (uniform prior) is Beta(1 + m, 1 + n - m); the
   pair is dropped as soon as P(similarity >= threshold) < ``miss``.
4. Survivors are verified exactly on the full shingle sets.
5. The verified links give components. In buckets that still hold members
   outside the component of their smallest node, these outsiders are compared
   with all members of other components, a block of outsiders with a block of
   members at a time: pruned as above by signatures alone, then the survivors'
   sets join their pair of blocks, are verified exactly, and one link of an
   outsider to each component goes out.
   Pairs inside a component need no look: a link there changes nothing. So no
   pair of a bucket is lost, and none goes out for copies.

Buckets with the same members (a group of near copies has many) are one.

Defined cases: texts without words (null, empty) have an empty set, link with
nothing and are kept; texts of fewer than ``width`` words have their whole word
sequence as one shingle; very long texts are hashed in parts; rows that repeat
a doc_id with another text are linked by their texts only, and all rows of a
component with its smallest id are ``kept`` (``deduplicated`` keeps one of
them); a row with a null id takes the smallest id of its component (null if
there is none) and is ``kept`` only then (``deduplicated`` drops it like any other row); an
empty table gives an empty result; other columns are ignored by
``near_duplicates`` and passed through by ``deduplicated``. Ids must be of an orderable type.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm._common import fresh, scratch, small, stage
from lodestar.llm._hashing import U64, mix, rolling, slices, word_hashes
from lodestar.llm.components import components

#: Nodes (8 bytes each) up to which the list of texts to verify is broadcast.
MAX_BROADCAST_NODES = 1_000_000
#: Rows of a block, of outsiders or of members, in the comparison inside a bucket, and shingles
#: (8 bytes each) of their sets: blocks are dealt by hash so that both stay near these.
BLOCK = 1024
BLOCK_SHINGLES = 1 << 20


def shingles(text: bytes | None, width: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    h = word_hashes(text, lower=True)
    if not len(h):
        return h
    return np.unique(mix(rolling(h, min(width, len(h))) + U64(min(width, len(h)))))


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return (rng.integers(0, 1 << 63, n, dtype=np.uint64) * U64(2) + U64(1),
            rng.integers(0, 1 << 63, n, dtype=np.uint64))


def signature(sets: list[np.ndarray], n: int) -> np.ndarray:
    """MinHash signatures (rows of n uint32) of non-empty sets."""
    out = np.empty((len(sets), n), np.uint32)
    a, b = _permutations(n)
    begin = 0
    while begin < len(sets):  # about a million hashes at a time
        end, size = begin + 1, len(sets[begin])
        while end < len(sets) and size + len(sets[end]) <= 1 << 18:
            size += len(sets[end])
            end += 1
        x = np.concatenate(sets[begin:end])
        starts = np.cumsum([0] + [len(s) for s in sets[begin:end - 1]])
        y = np.empty_like(x)
        for k in range(n):
            np.multiply(x, a[k], out=y)
            np.add(y, b[k], out=y)
            out[begin:end, k] = np.minimum.reduceat(y, starts) >> U64(32)
        begin = end
    return out


def prune_table(n: int, batch: int, threshold: float, miss: float) -> np.ndarray:
    """least[k]: with fewer matches after k + 1 batches, P(similarity >= threshold) < miss."""
    x = np.linspace(0.0, 1.0, 20_001)[1:-1]
    above = x >= threshold
    least = []
    for seen in range(batch, n + 1, batch):
        for m in range(seen + 1):
            logp = m * np.log(x) + (seen - m) * np.log1p(-x)
            p = np.exp(logp - logp.max())
            if p[above].sum() / p.sum() >= miss:
                break
        least.append(m)
    return np.array(least)


def survives(a: np.ndarray, b: np.ndarray, least: np.ndarray, batch: int) -> np.ndarray:
    """Which rows of two signature arrays pass every look; each look reads only what is still in."""
    alive, found = np.arange(len(a)), np.zeros(len(a), np.int32)
    for k, m in enumerate(least):
        if not len(alive):
            break
        at = slice(k * batch, (k + 1) * batch)
        found[alive] += (a[alive, at] == b[alive, at]).sum(1, dtype=np.int32)
        alive = alive[found[alive] >= m]
    keep = np.zeros(len(a), bool)
    keep[alive] = True
    return keep


def _sign(width: int, n: int):
    def f(batches):
        for rb in slices(batches):
            texts = rb.column("text").cast(pa.large_binary()).to_pylist()
            sets = [shingles(t, width) for t in texts]
            full = [s for s in sets if len(s)]
            rows = iter(signature(full, n)) if full else iter(())
            sigs = [next(rows).tobytes() if len(s) else None for s in sets]
            nodes = [xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [rb.column("id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(nodes, pa.int64()), pa.array(sigs, pa.binary())],
                ["id", "n", "node", "sig"])
    return f


def _bands(bands: int, rows: int):
    def f(batches):
        for rb in batches:
            if not rb.num_rows:
                continue
            sig = np.frombuffer(b"".join(rb.column("sig").to_pylist()), np.uint32)
            sig = sig.reshape(rb.num_rows, -1)[:, :bands * rows].astype(U64)
            key = np.zeros((rb.num_rows, bands), U64) + mix(np.arange(1, bands + 1, dtype=U64))
            for r in range(rows):
                key = mix(key * U64(0x9E3779B97F4A7C15) + sig[:, r::rows][:, :bands])
            node = np.asarray(rb.column("node"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64).ravel()), pa.array(np.repeat(node, bands))],
                ["bucket", "node"])
    return f


def _look(least: np.ndarray, batch: int, n: int):
    def f(batches):
        for rb in batches:
            if rb.num_rows:
                a, b = (np.frombuffer(b"".join(rb.column(c).to_pylist()), np.uint32).reshape(-1, n)
                        for c in ("sig_a", "sig_b"))
                yield (pa.RecordBatch.from_arrays([rb.column("a"), rb.column("b")], ["a", "b"])
                       .filter(pa.array(survives(a, b, least, batch))))
    return f


def _sets(width: int):
    def f(batches):
        for rb in slices(batches):
            texts = rb.column("text").cast(pa.large_binary()).to_pylist()
            blobs = [shingles(t, width).tobytes() for t in texts]
            nodes = [xxhash.xxh3_64_intdigest(s) - (1 << 63) if s else None for s in blobs]
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(blobs, pa.large_binary()).cast(pa.binary())],
                ["node", "shingles"])
    return f


def _verify(percent: int):
    def f(batches):
        for rb in batches:
            keep = []
            for x, y in zip(rb.column("set_a"), rb.column("set_b")):
                p, q = (np.frombuffer(s.as_buffer(), U64) for s in (x, y))
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield (pa.RecordBatch.from_arrays([rb.column("a"), rb.column("b")], ["u", "v"])
                   .filter(pa.array(keep, pa.bool_())))
    return f


def weighted(here: DataFrame, most: int) -> DataFrame:
    """``n_out`` and ``size`` as ``_dealt`` counts blocks, raised where the sets of a block would hold over ``most`` shingles.

    ``w_out`` and ``w_all`` are the shingles of the bucket's outsiders and of all its members.
    """
    return here.withColumns({c: F.greatest(F.col(c), F.ceil(F.col(w) / most * BLOCK).cast("long"))
                             for c, w in (("n_out", "w_out"), ("size", "w_all"))})


def _dealt(here: DataFrame) -> DataFrame:
    """Members of open buckets dealt to (bucket, bl, br): a block of outsiders (``left``) and one of members.

    ``here`` has the columns bucket, size, n_out, node, comp and out.
    """
    nl, nr = (F.ceil(F.col(c) / BLOCK).cast("int") for c in ("n_out", "size"))
    block = lambda m: F.pmod(F.xxhash64("node"), m).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), m - 1))
    cols = ["bucket", "bl", "br", "node", "comp"]
    left = here.where("out").withColumn("bl", block(nl)).withColumn("br", every(nr))
    right = here.withColumn("br", block(nr)).withColumn("bl", every(nl))
    return left.select(*cols, F.lit(True).alias("left")).union(right.select(*cols, F.lit(False).alias("left")))


MET = "bucket long, bl int, br int, node long, comp long, partners binary"


def _meet(least: np.ndarray, batch: int, n: int):
    """Two blocks of a bucket: the nodes of pairs whose signatures survive, outsiders with their partners."""
    def f(key: tuple, table: pa.Table) -> pa.Table:
        node, comp = (table.column(c).to_numpy() for c in ("node", "comp"))
        left = table.column("left").to_numpy(zero_copy_only=False)
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint32).reshape(-1, n)
        right, partners, used = np.flatnonzero(~left), {}, {}
        for i in np.flatnonzero(left):
            js = right[comp[right] != comp[i]]
            js = js[survives(np.broadcast_to(sig[i], (len(js), n)), sig[js], least, batch)]
            if len(js):
                partners[node[i]] = node[js].tobytes()
                used[node[i]] = comp[i]
                used.update(zip(node[js], comp[js]))
        own = [pa.array([k.as_py()] * len(used), t) for k, t in zip(key, (pa.int64(), pa.int32(), pa.int32()))]
        return pa.table([*own, pa.array(list(used), pa.int64()), pa.array(list(used.values()), pa.int64()),
                         pa.array([partners.get(x) for x in used], pa.binary())],
                        ["bucket", "bl", "br", "node", "comp", "partners"])
    return f


def _across(percent: int):
    """The nodes of ``_meet`` with their sets: exact links of outsiders, one to each component."""
    def f(table: pa.Table) -> pa.Table:
        node, comp = (table.column(c).to_numpy() for c in ("node", "comp"))
        sets = [np.frombuffer(s, U64) for s in table.column("shingles").to_pylist()]
        size = np.array([len(s) for s in sets])
        starts = np.cumsum(size) - size
        values, code = np.unique(np.concatenate(sets), return_inverse=True)
        mark = np.zeros(len(values), np.int32)
        order, links = np.argsort(node), []
        for i, partners in enumerate(table.column("partners").to_pylist()):
            if partners is None:
                continue
            js = order[np.searchsorted(node, np.frombuffer(partners, np.int64), sorter=order)]
            own = code[starts[i]:starts[i] + size[i]]
            mark[own] = 1
            both = (np.add.reduceat(mark[code], starts)[js] if len(js) > 32 else
                    np.array([mark[code[starts[j]:starts[j] + size[j]]].sum() for j in js]))
            mark[own] = 0
            js = js[100 * both >= percent * (size[i] + size[js] - both)]
            js = js[np.lexsort((node[js], comp[js]))]
            js = js[np.r_[True, comp[js][1:] != comp[js][:-1]]] if len(js) else js
            links += [(node[i], node[j]) for j in js]
        u, v = zip(*links) if links else ((), ())
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})
    return f


def _roots(texts: DataFrame, width: int = 5, percent: int = 75, bands: int = 32, rows: int = 4,
           batch: int = 16, miss: float = 1e-6) -> DataFrame:
    """(id, n, node, component), a row per row of ``texts`` (id, text); node and component are null without words.

    ``bands * rows`` hashes a signature; with the defaults a pair at the
    threshold meets in a bucket with probability 0.999995.
    """
    spark = texts.sparkSession
    root, n = scratch(spark, "minhash"), bands * rows
    least = prune_table(n, batch, percent / 100, miss)
    id_type = texts.schema["id"].dataType.simpleString()
    signed = stage(spark, texts.mapInArrow(
        _sign(width, n), f"id {id_type}, n long, node long, sig binary"), root, "signed")
    nodes = stage(spark, signed.where("node IS NOT NULL").groupBy("node")
                  .agg(F.first("sig").alias("sig"), F.first("n").alias("n")), root, "nodes")
    bucket = nodes.mapInArrow(_bands(bands, rows), "bucket long, node long")
    firsts = (bucket.groupBy("bucket").agg(F.count("*").alias("size"), F.min("node").alias("first"),
                                           F.bit_xor(F.xxhash64("node")).alias("print"))
              .where("size > 1").groupBy("size", "first", "print").agg(F.min("bucket").alias("bucket")))
    firsts = stage(spark, firsts.drop("print"), root, "firsts")
    members = stage(spark, bucket.join(firsts, "bucket"), root, "members")

    def sets_of(wanted: DataFrame, name: str) -> DataFrame:
        """(node, shingles) of the nodes in ``wanted``, from a text of each."""
        chosen = (signed.join(wanted, "node", "left_semi").groupBy("node")
                  .agg(F.min("id").alias("id")).select(F.col("id").alias("chosen")).distinct())
        chosen = small(stage(spark, chosen, root, f"{name}-chosen"), MAX_BROADCAST_NODES)
        found = (texts.join(chosen, texts["id"].eqNullSafe(chosen["chosen"]), "left_semi")
                 .mapInArrow(_sets(width), "node long, shingles binary")
                 .where("node IS NOT NULL").groupBy("node").agg(F.first("shingles").alias("shingles")))
        return stage(spark, found, root, f"{name}-sets")

    star = (members.where("node <> first")
            .select(F.col("first").alias("a"), F.col("node").alias("b")).distinct())
    side = lambda df, old, c: df.select(F.col("node").alias(c), F.col(old).alias(f"{old[:3]}_{c}"))
    looked = stage(spark, star.join(side(nodes, "sig", "a"), "a").join(side(nodes, "sig", "b"), "b")
                   .mapInArrow(_look(least, batch, n), "a long, b long"), root, "looked")
    sets = sets_of(looked.select(F.col("a").alias("node")).union(looked.select("b")).distinct(), "star")
    links = (looked.join(side(sets.withColumnRenamed("shingles", "set"), "set", "a"), "a")
             .join(side(sets.withColumnRenamed("shingles", "set"), "set", "b"), "b")
             .mapInArrow(_verify(percent), "u long, v long"))
    links = stage(spark, links, root, "star-links")
    labels = stage(spark, components(spark, links, root, "star-cc"), root, "star-labels")

    label = labels.withColumnRenamed("component", "comp")
    heads = label.select(F.col("node").alias("first"), F.col("comp").alias("first_comp"))
    here = (members.where("size > 2 AND node <> first").join(label, "node", "left")
            .join(heads, "first", "left")
            .withColumn("comp", F.coalesce("comp", "node"))
            .withColumn("out", F.col("comp") != F.coalesce("first_comp", "first")))
    here = here.join(nodes.select("node", "n"), "node")
    open_ = here.groupBy("bucket").agg(
        F.count_if("out").alias("n_out"), F.sum(F.when(F.col("out"), F.col("n"))).alias("w_out"),
        F.sum("n").alias("w_all")).where("n_out > 0")
    here = stage(spark, weighted(here.join(open_, "bucket"), BLOCK_SHINGLES).drop("n", "w_out", "w_all"), root, "open")
    met = stage(spark, _dealt(here).join(nodes.select("node", "sig"), "node").groupBy("bucket", "bl", "br")
                .applyInArrow(_meet(least, batch, n), MET), root, "open-met")
    sets = sets_of(met.select("node").distinct(), "open")
    more = (met.join(sets, "node").groupBy("bucket", "bl", "br")
            .applyInArrow(_across(percent), "u long, v long").distinct())
    links = links.union(stage(spark, more, root, "open-links"))
    labels = stage(spark, components(spark, links, root, "cc"), root, "labels")

    return (signed.join(labels, "node", "left")
            .select("id", "n", "node", F.coalesce("component", "node").alias("component")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, n_shingles, component_id, kept), a row per row of ``docs``; options as for ``_roots``."""
    roots = _roots(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), **options)
    least_id = roots.where("component IS NOT NULL").groupBy("component").agg(F.min("id").alias("least"))
    full = roots.join(least_id, "component", "left")
    own = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("least"))
    return full.select(F.col("id"), F.col("n").alias("n_shingles"), own.alias("component_id"),
                       F.col("id").eqNullSafe(own).alias("kept"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each component (of those with its smallest id, the first), columns as in ``docs``.

    Rows go one by one, so another text under the id of a dropped row stays.
    A row with a null id goes if its component has another one; of a component whose ids are
    all null the first row stays.
    """
    spark, row = docs.sparkSession, fresh(docs, "row")
    numbered = stage(spark, docs.withColumn(row, F.monotonically_increasing_id()), scratch(spark, "dedup"), "rows")
    roots = _roots(numbered.select(F.col(row).alias("id"), F.col(text_col).alias("text")), **options)
    own = numbered.select(F.col(row).alias("id"), F.col(id_col).alias("own"))
    found = stage(spark, roots.where("component IS NOT NULL").select("id", "component").join(own, "id"),
                  scratch(spark, "dedup"), "found")
    first = found.groupBy("component").agg(F.min(F.struct(F.col("own").isNull().alias("last"), "own", "id")).alias("first"))
    gone = (found.join(first, "component").where(F.col("id") != F.col("first.id"))
            .select(F.col("id").alias(row)))
    return numbered.join(gone, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).withColumnRenamed("id", "doc_id")


OP8_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, row_number() OVER () AS rid,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT rid, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
         ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS h
  FROM w),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
l AS (
  SELECT a.rid AS u, b.rid AS v FROM s a JOIN s b ON a.h = b.h AND a.rid <> b.rid
  JOIN n na ON na.rid = a.rid JOIN n nb ON nb.rid = b.rid
  GROUP BY a.rid, b.rid, na.n, nb.n HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))),
r AS (
  SELECT rid, doc_id AS c FROM w
  UNION
  SELECT l.v, r.c FROM r JOIN l ON l.u = r.rid),
c AS (SELECT rid, min(c) AS c FROM r GROUP BY rid)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.c AS component_id, w.doc_id = c.c AS kept
FROM w JOIN c ON c.rid = w.rid LEFT JOIN n ON n.rid = w.rid
"""
