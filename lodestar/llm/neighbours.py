"""Approximate nearest neighbours by NN-descent and greedy graph search (operator 11).

Nearness is the largest inner product. For the graph every vector is divided by
the largest norm and gets one more coordinate that makes it a unit vector, so
the order by inner product and the order by distance agree; queries are scored
without that coordinate.

1. Rows with equal components are one node with its smallest ids. Nodes are
   ordered by the signs of random projections, numbered in that order and dealt
   into blocks of at most ``BLOCK`` neighbouring ones. A node's number holds its block.
2. Start of the graph: the nearest ``degree`` nodes of each node's own group of blocks, and
   of its groups in two more such orders, so that the groups are connected.
3. NN-descent, rounds of Spark joins: every node deals a sample of its new and old neighbours,
   and of the nodes it is a neighbour of, to its block; the vectors that a block
   needs are joined to it once; a block compares the neighbours of each of its
   nodes with each other (neighbours of neighbours) and offers pairs that beat the
   worst neighbour either has. Offers go to the blocks of their nodes and are merged. The
   rounds end when few neighbours change. Reverse neighbours are thinned by the
   node's in-degree, a partial aggregate, so hubs stay small.
4. Search: a query begins at its own node and keeps its ``beam`` nearest nodes found. Every
   round the nearest ones that are not yet expanded are joined to their links. Those that the query
   has not met go, a list with the query's vector, to the groups of blocks that hold them and come back with their
   nearness, until all of the beam are expanded. So a query asks a group once a round, however many
   nodes it wants there, and vectors of nodes do not travel to queries. A group that is asked much answers in parts.
5. The beam is scored on the original vectors in double precision, in the order of
   the components, and expanded to rows.

A task holds one block: 128 nodes' samples and the vectors these name, a group of 2048 nodes with about 16 MB
of asks, or 128 queries' candidates. Every row is in the index; nothing is fitted to a sample. With at
most ``BLOCK * GROUP`` different vectors of a length there is one group, the start of the graph is
exact and so is the result; beyond that recall is measured (README, tests).

Defined cases: vectors that are null, empty, zero or hold null or non-finite components and rows with a null id
take no part, as queries or candidates; vectors of another length are no
candidates; rows that repeat an id are rows of their own (a row is never its own
candidate, its repetition is); with fewer candidates than asked for all are
returned; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.llm._common import scratch, stage
from lodestar.llm._hashing import U64, mix
from lodestar.llm._rank import ranked

#: Nodes of a block, and blocks next to each other whose nodes are compared with each other for the start.
BLOCK = 128
GROUP = 16
QUERY_BLOCK = 128
#: Bytes of what queries ask of a group that are answered together, about.
ASK_BYTES = 16 << 20
#: Bits of a node's number below its block.
_LOCAL = 12
#: Bits of a block's number below the vector length.
_BLOCKS = 34
#: Bits of a node's number below its area: ``GROUP`` blocks next to each other, which answer queries together.
_AREA = _LOCAL + (GROUP - 1).bit_length()
#: Orders of the nodes that the graph starts from.
ORDERS = 3
#: Rounds of NN-descent at most; they end earlier when fewer than ``STILL`` of the neighbours changed.
ROUNDS = 12
STILL = 0.04
#: Nodes a query expands in one round.
EXPAND = 32

_GRAPH = "node long, vector binary, ids binary, sims binary, fresh binary, low float, changed long"


def _i64(values) -> np.ndarray:
    return np.frombuffer(values, np.int64)


def _f32(values) -> np.ndarray:
    return np.frombuffer(values, np.float32)


def _matrix(column, dtype=np.float32) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), dtype).reshape(len(values), -1)


def _column(table, name: str) -> np.ndarray:
    return table.column(name).to_numpy(zero_copy_only=False) if isinstance(table, pa.RecordBatch) \
        else table.column(name).to_numpy()


# --------------------------------------------------------------------------
# nodes


def _read(batches):
    """(id, embedding) to (id, dim, norm, exact) of the rows that take part."""
    for rb in batches:
        rb = rb.filter(pc.is_valid(rb.column("id")))
        emb = rb.column("embedding")
        lens = np.asarray(pc.fill_null(pc.list_value_length(emb), 0))
        for d in np.unique(lens[lens > 0]).tolist():
            at = np.flatnonzero(lens == d)
            x = np.asarray(emb.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False), np.float64)
            x = x.reshape(len(at), d) + 0.0  # -0.0 is 0.0
            good = np.isfinite(x).all(1) & (x != 0).any(1)
            at, x = at[good], x[good]
            high = np.abs(x).max(1, initial=0)
            norm = high * np.sqrt(((x / high[:, None]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays(
                [rb.column("id").take(pa.array(at)), pa.array([d] * len(at), pa.int32()), pa.array(norm),
                 pa.array([v.tobytes() for v in x], pa.binary())], ["id", "dim", "norm", "exact"])


def _place(longest: float):
    """Nodes with their unit vectors and, for each order, the projections that sort them."""
    def f(batches):
        for rb in batches:
            exact, dims = rb.column("exact").to_pylist(), _column(rb, "dim")
            vectors, codes = [b""] * len(exact), np.zeros((ORDERS, len(exact)), np.int64)
            finer = np.zeros((ORDERS, len(exact)))
            for d in np.unique(dims).tolist():
                at = np.flatnonzero(dims == d)
                x = np.frombuffer(b"".join(exact[i] for i in at), np.float64).reshape(len(at), d) / longest
                more = np.sqrt(np.maximum(0, 1 - (x * x).sum(1)))
                for i, v in zip(at.tolist(), np.c_[x, more].astype(np.float32), strict=True):
                    vectors[i] = v.tobytes()
                for k in range(ORDERS):
                    y = x @ np.random.default_rng([11, k, d]).standard_normal((d, 17))
                    codes[k, at] = (y[:, :16] > 0) @ (1 << np.arange(15, -1, -1))
                    finer[k, at] = y[:, 16]
            yield pa.RecordBatch.from_arrays(
                [rb.column("exact"), rb.column("dim"), rb.column("ids"), pa.array(vectors, pa.binary()),
                 *map(pa.array, codes), *map(pa.array, finer)],
                ["exact", "dim", "ids", "vector", *[f"code{k}" for k in range(ORDERS)], *[f"finer{k}" for k in range(ORDERS)]])
    return f


def _dealt(pos, rows, size: int):
    """(block, place in it) of a position among ``rows``, in even blocks of at most ``size``."""
    blocks = F.ceil(rows / size)
    block = F.floor(pos * blocks / rows).cast("long")
    return block, (pos - F.ceil(block * rows / blocks)).cast("long")


def _block(node: str):
    return F.shiftright(F.col(node), _LOCAL)


def _renewed(df: DataFrame) -> DataFrame:
    """``df`` with columns of its own, so that it can be grouped beside a frame it was made from."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


# --------------------------------------------------------------------------
# the graph


def _nearest(degree: int):
    """The nodes of one group to each node's ``degree`` nearest ones in it."""
    def f(table: pa.Table) -> pa.Table:
        node, x = _column(table, "node"), _matrix(table.column("vector"))
        k = min(degree, len(node) - 1)
        ids, sims = [], []
        for b in range(0, len(node), 512):
            s = x[b:b + 512] @ x.T
            s[np.arange(len(s)), np.arange(b, b + len(s))] = -np.inf
            top = np.argpartition(-s, k - 1, 1)[:, :k] if k else np.empty((len(s), 0), int)
            for i in range(len(s)):
                ids.append(node[top[i]].tobytes())
                sims.append(s[i, top[i]].tobytes())
        return pa.table({"node": table.column("node"), "ids": pa.array(ids, pa.binary()),
                         "sims": pa.array(sims, pa.binary())})
    return f


def _best(ids: np.ndarray, sims: np.ndarray, fresh: np.ndarray, degree: int):
    """The ``degree`` largest of different ids, larger first; of equal ids the first stands."""
    ids, first = np.unique(ids, return_index=True)
    sims, fresh = sims[first], fresh[first]
    order = np.lexsort((ids, -sims))[:degree]
    return ids[order], sims[order], fresh[order]


def _started(degree: int):
    """The starts of one node in all orders, as lists, to its row of the graph."""
    def f(batches):
        for rb in batches:
            out = {c: [] for c in ("ids", "sims", "fresh", "low")}
            for many, values in zip(rb.column("ids").to_pylist(), rb.column("sims").to_pylist(), strict=True):
                ids, sims = _i64(b"".join(many)), _f32(b"".join(values))
                ids, sims, fresh = _best(ids, sims, np.ones(len(ids), bool), degree)
                _put(out, ids, sims, fresh, degree)
            yield _graph_rows(rb.column("node"), rb.column("vector"), out, [0] * rb.num_rows)
    return f


def _put(out: dict, ids, sims, fresh, degree: int) -> None:
    out["ids"].append(ids.tobytes())
    out["sims"].append(sims.astype(np.float32).tobytes())
    out["fresh"].append(fresh.tobytes())
    out["low"].append(float(sims[-1]) if len(ids) >= degree else -np.inf)


def _graph_rows(node, vector, out: dict, changed: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [node, vector, *[pa.array(out[c], pa.binary()) for c in ("ids", "sims", "fresh")],
         pa.array(out["low"], pa.float32()), pa.array(changed, pa.int64())],
        ["node", "vector", "ids", "sims", "fresh", "low", "changed"])


def _sampled(node: int, ids: np.ndarray, fresh: np.ndarray, sample: int, round_: int) -> np.ndarray:
    """Which neighbours a node deals out: ``sample`` new and as many old ones at most, chosen by hash."""
    key = mix(ids.view(U64) ^ mix(np.array([node + 1], np.int64).view(U64) * U64(2 * round_ + 1)))
    chosen = np.zeros(len(ids), bool)
    for of in (fresh, ~fresh):
        at = np.flatnonzero(of)
        chosen[at[np.argsort(key[at], kind="stable")[:sample]]] = True
    return chosen


def _deal(sample: int, round_: int):
    """Graph rows to (u, v, fresh): the neighbours v that u deals out."""
    def f(batches):
        for rb in batches:
            us, vs, fs = [], [], []
            for u, ids, fresh in zip(*[rb.column(c).to_pylist() for c in ("node", "ids", "fresh")], strict=True):
                ids, fresh = _i64(ids), np.frombuffer(fresh, bool)
                chosen = _sampled(u, ids, fresh, sample, round_)
                us.append(np.full(chosen.sum(), u))
                vs.append(ids[chosen])
                fs.append(fresh[chosen])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*x, np.empty(0, t)]).astype(t)) for x, t in
                                              ((us, np.int64), (vs, np.int64), (fs, bool))], ["u", "v", "fresh"])
    return f


def _thinned(links: DataFrame, most: int, by: list[str], salt: int) -> DataFrame:
    """(u, v, ...) turned round, about ``most`` a node: kept with probability most / in-degree, by hash."""
    degree = links.groupBy(*[F.col(c) for c in by]).agg(F.count("*").alias("degree"))
    draw = F.pmod(F.xxhash64("u", "v", F.lit(salt)), F.lit(1 << 20)) / (1 << 20)
    kept = links.join(degree, by).where(draw < most / F.col("degree")).drop("degree")
    turned = {"u": "v", "v": "u"}
    return kept.select(*[F.col(turned.get(c, c)).alias(c) for c in links.columns])


def _compare(refs: pa.Table, supply: pa.Table) -> pa.Table:
    """One block's dealt neighbours, with the vectors they name, to offers (node, other, sim)."""
    known = _column(supply, "v")
    order = np.argsort(known)
    known = known[order]
    vectors = [supply.column("vector")[int(i)].as_py() for i in order]
    low = _column(supply, "low")[order]
    width = np.array([len(v) for v in vectors])
    u, v, fresh = (_column(refs, c) for c in ("u", "v", "fresh"))
    at = np.searchsorted(known, v)
    out = [[], [], []]
    for w in np.unique(width):  # vectors of one length meet only each other
        here = width == w
        place = np.cumsum(here) - 1
        x = _f32(b"".join(vectors[i] for i in np.flatnonzero(here))).reshape(-1, w // 4)
        mine = here[at]
        uu, aa, ff = u[mine], at[mine], fresh[mine]
        sort = np.lexsort((aa, ~ff, uu))  # new ones of a node first
        uu, aa, ff = uu[sort], aa[sort], ff[sort]
        begins = np.flatnonzero(np.r_[True, uu[1:] != uu[:-1]]) if len(uu) else np.empty(0, int)
        for b, e in zip(begins, np.r_[begins[1:], len(uu)], strict=True):
            n = b + int(ff[b:e].sum())
            new, every = np.unique(aa[b:n]), aa[b:e]
            if not len(new):
                continue
            every = np.unique(every)
            s = x[place[new]] @ x[place[every]].T
            differ = new[:, None] != every[None, :]
            i, j = np.nonzero(differ & (s > low[every][None, :]))
            k, m = np.nonzero(differ & (s > low[new][:, None]))
            out[0] += [every[j], new[k]]
            out[1] += [new[i], every[m]]
            out[2] += [s[i, j], s[k, m]]
    to, frm = (np.concatenate([*c, np.empty(0, np.int64)]).astype(np.int64) for c in out[:2])
    sims = np.concatenate([*out[2], np.empty(0, np.float32)]).astype(np.float32)
    pair = np.unique(to * len(known) + frm, return_index=True)[1] if len(to) else np.empty(0, int)
    return pa.table({"node": pa.array(known[to[pair]]), "other": pa.array(known[frm[pair]]), "sim": pa.array(sims[pair])})


def _merge(degree: int, sample: int, round_: int):
    """The graph rows of one block and the offers to them to new graph rows."""
    def f(graph: pa.Table, offers: pa.Table) -> pa.Table:
        node, other, sim = (_column(offers, c) for c in ("node", "other", "sim"))
        order = np.argsort(node, kind="stable")
        node, other, sim = node[order], other[order], sim[order]
        out, changed = {c: [] for c in ("ids", "sims", "fresh", "low")}, []
        for u, ids, sims, fresh in zip(*[graph.column(c).to_pylist() for c in ("node", "ids", "sims", "fresh")], strict=True):
            ids, sims, fresh = _i64(ids), _f32(sims), np.frombuffer(fresh, bool)
            fresh = fresh & ~_sampled(u, ids, fresh, sample, round_)
            b, e = np.searchsorted(node, [u, u + 1])
            more = other[b:e]
            ids2, sims2, fresh2 = _best(np.r_[ids, more], np.r_[sims, sim[b:e]],
                                        np.r_[fresh, np.ones(len(more), bool)], degree)
            changed.append(len(ids2) - int(np.isin(ids2, ids, assume_unique=True).sum()))
            _put(out, ids2, sims2, fresh2, degree)
        rb = _graph_rows(graph.column("node").combine_chunks(), graph.column("vector").combine_chunks(), out, changed)
        return pa.Table.from_batches([rb])
    return f


def graph(spark: SparkSession, nodes: DataFrame, orders: list[DataFrame], root: str, degree: int, sample: int) -> DataFrame:
    """The neighbour graph over ``nodes`` (node, vector); ``orders`` are (block, node, vector) to start from."""
    starts = None
    for blocks in orders:
        near = blocks.groupBy("block").applyInArrow(_nearest(degree), "node long, ids binary, sims binary")
        starts = near if starts is None else starts.union(near)
    starts = starts.groupBy("node").agg(F.collect_list(F.struct("ids", "sims")).alias("s"))  # one an order
    now = stage(spark, nodes.select("node", "vector").join(
        starts.select("node", F.col("s.ids").alias("ids"), F.col("s.sims").alias("sims")), "node")
        .mapInArrow(_started(degree), _GRAPH), root, "graph0")
    total = now.count()
    for k in range(1, ROUNDS + 1):
        dealt = stage(spark, now.select("node", "ids", "fresh").mapInArrow(
            _deal(sample, k), "u long, v long, fresh boolean"), root, f"dealt{k}")
        refs = dealt.union(_thinned(dealt, sample, ["v", "fresh"], k)).select(_block("u").alias("block"), "u", "v", "fresh")
        refs = stage(spark, refs, root, f"refs{k}")
        supply = (refs.select("block", "v").distinct()
                  .join(now.select(F.col("node").alias("v"), "vector", "low"), "v").select("block", "v", "vector", "low"))
        offers = refs.groupBy("block").cogroup(_renewed(supply).groupBy("block")).applyInArrow(
            _compare, "node long, other long, sim float").withColumn("block", _block("node"))
        now = stage(spark, now.withColumn("block", _block("node")).groupBy("block").cogroup(_renewed(offers).groupBy("block"))
                    .applyInArrow(_merge(degree, sample, k), _GRAPH), root, f"graph{k}")
        if (now.agg(F.sum("changed")).first()[0] or 0) <= STILL * degree * total:
            break
    return now


# --------------------------------------------------------------------------
# the search


def _explode_ids(batches):
    for rb in batches:
        ids = [_i64(b) for b in rb.column("ids").to_pylist()]
        n = [len(x) for x in ids]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(_column(rb, "node"), n)), pa.array(np.concatenate([*ids, np.empty(0, np.int64)]))], ["u", "v"])


_STATE = "qblock long, query long, exact binary, vector binary, ids binary, sims binary, done binary, seen binary, open long"
_ARRAYS = ("ids", "sims", "done", "seen")


def _begin(batches):
    """Queries to beams that hold their own node."""
    for rb in batches:
        n = rb.num_rows
        own = pa.array([x.tobytes() for x in _column(rb, "query").reshape(n, 1)], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [*rb.columns, own, pa.array([np.float32(np.inf).tobytes()] * n, pa.binary()), pa.array([b"\0"] * n, pa.binary()),
             own, pa.array([1] * n, pa.int64())], [*rb.schema.names, *_ARRAYS, "open"])


def _frontier(batches):
    """Beams to the nodes that they expand next."""
    for rb in batches:
        q, c, b = [], [], []
        for block, query, ids, done in zip(*[rb.column(x).to_pylist() for x in ("qblock", "query", "ids", "done")], strict=True):
            todo = _i64(ids)[~np.frombuffer(done, bool)][:EXPAND]
            q += [query] * len(todo)
            b += [block] * len(todo)
            c += todo.tolist()
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (b, q, c)], ["qblock", "query", "node"])


_ASKS = "area long, qblock long, query long, vector binary, ids binary"


def _wanted(states: pa.Table, links: pa.Table) -> pa.Table:
    """The beams of one block of queries and the links of what they expand: what each query has not met, a row an area."""
    found: dict[int, list] = {}
    for query, ids in zip(links.column("query").to_pylist(), links.column("ids").to_pylist(), strict=True):
        found.setdefault(query, []).append(_i64(ids))
    rows = []
    for qblock, query, vector, seen in zip(*[states.column(c).to_pylist() for c in ("qblock", "query", "vector", "seen")], strict=True):
        new = np.setdiff1d(np.concatenate(found.get(query, [np.empty(0, np.int64)])), _i64(seen))
        area = new >> _AREA
        begins = np.flatnonzero(np.r_[len(new) > 0, area[1:] != area[:-1]])
        rows += [(int(area[b]), qblock, query, vector, new[b:e].tobytes())
                 for b, e in zip(begins, np.r_[begins[1:], len(new)], strict=False)]
    cols = list(zip(*rows, strict=True)) if rows else [()] * 5
    return pa.table([pa.array(c, t) for c, t in zip(cols, (*[pa.int64()] * 3, *[pa.binary()] * 2), strict=True)],
                    ["area", "qblock", "query", "vector", "ids"])


def _near(asks: pa.Table, nodes: pa.Table) -> pa.Table:
    """The nearness of the nodes asked of one area, a list for each row asked."""
    if not asks.num_rows:  # a part may be asked nothing
        return pa.table([pa.array([], t) for t in (*[pa.int64()] * 2, *[pa.binary()] * 2)], ["qblock", "query", "ids", "sims"])
    known, x = _column(nodes, "node"), _matrix(nodes.column("vector"))
    order = np.argsort(known)
    lists = asks.column("ids").to_pylist()
    n = np.array([len(ids) // 8 for ids in lists])
    at = order[np.searchsorted(known[order], _i64(b"".join(lists)))]
    q, row = _matrix(asks.column("vector")), np.repeat(np.arange(len(n)), n)
    s = np.concatenate([np.einsum("ij,ij->i", x[at[b:b + (1 << 16)], :-1], q[row[b:b + (1 << 16)], :-1])
                        for b in range(0, len(at), 1 << 16)])
    sims = [v.tobytes() for v in np.split(s, np.cumsum(n)[:-1])]
    return pa.table([asks.column("qblock"), asks.column("query"), asks.column("ids"), pa.array(sims, pa.binary())],
                    ["qblock", "query", "ids", "sims"])


def _advance(beam: int):
    """The beams of one block of queries and the nodes that they asked for, with their nearness: the next beams."""
    def f(states: pa.Table, answers: pa.Table) -> pa.Table:
        found: dict[int, list] = {}
        for query, ids, sims in zip(*[answers.column(c).to_pylist() for c in ("query", "ids", "sims")], strict=True):
            found.setdefault(query, []).append((ids, sims))
        out = {c: [] for c in _ARRAYS}
        open_ = []
        for query, *arrays in zip(*[states.column(c).to_pylist() for c in ("query", *_ARRAYS)], strict=True):
            ids, sims, done, seen = (np.frombuffer(a, t) for a, t in zip(arrays, (np.int64, np.float32, bool, np.int64), strict=True))
            todo = np.flatnonzero(~done)[:EXPAND]
            done = done.copy()
            done[todo] = True
            if query in found:
                new, s = (np.frombuffer(b"".join(v), t) for v, t in zip(zip(*found[query]), (np.int64, np.float32), strict=True))
                seen = np.union1d(seen, new)
                ids, sims, done = np.r_[ids, new], np.r_[sims, s], np.r_[done, np.zeros(len(new), bool)]
                top = np.lexsort((ids, -sims))[:beam]
                ids, sims, done = ids[top], sims[top].astype(np.float32), done[top]
            for c, a in zip(_ARRAYS, (ids, sims, done, seen), strict=True):
                out[c].append(a.tobytes())
            open_.append(int((~done).sum()))
        return pa.table({**{c: states.column(c) for c in ("qblock", "query", "exact", "vector")},
                         **{c: pa.array(out[c], pa.binary()) for c in _ARRAYS}, "open": pa.array(open_, pa.int64())})
    return f


_FOUND = "query long, near array<struct<score:double,id:long,own:boolean>>"


def _scored(k: int):
    """The beams of one block with the exact vectors and ids of their nodes to each query's first ``k`` + 1 rows."""
    def f(states: pa.Table, supply: pa.Table) -> pa.Table:
        known = _column(supply, "v")
        order = np.argsort(known)
        known = known[order]
        exact = supply.column("exact").take(pa.array(order)).to_pylist()
        rows = supply.column("rows").take(pa.array(order)).to_pylist()
        near = []
        for query, vector, ids in zip(*[states.column(c).to_pylist() for c in ("query", "exact", "ids")], strict=True):
            at = np.searchsorted(known, _i64(ids)).tolist()
            q = np.frombuffer(vector, np.float64)
            x = np.frombuffer(b"".join(exact[i] for i in at), np.float64).reshape(len(at), len(q))
            scores = np.cumsum(x * q, 1)[:, -1].tolist()  # the sum in the order of the components
            found = [(-s, i, known[p] == query) for s, p in zip(scores, at, strict=True) for i in rows[p]]
            near.append([{"score": -s, "id": i, "own": bool(own)} for s, i, own in sorted(found)[:k + 1]])
        kind = pa.list_(pa.struct([("score", pa.float64()), ("id", pa.int64()), ("own", pa.bool_())]))
        return pa.table({"query": states.column("query"), "near": pa.array(near, kind)})
    return f


def search(spark: SparkSession, links: DataFrame, nodes: DataFrame, starts: DataFrame, root: str, beam: int, k: int) -> DataFrame:
    """(query, near) for the nodes ``starts``: the first ``k`` + 1 rows that greedy search from the node itself finds."""
    queries = ranked(spark, starts.select(F.lit(0).alias("all"), "node"), "all", ["node"], root, "queries")
    state = stage(spark, queries.select(F.floor(F.col("pos") / QUERY_BLOCK).cast("long").alias("qblock"), F.col("node").alias("query"))
                  .join(nodes.select(F.col("node").alias("query"), "exact", "vector"), "query")
                  .select("qblock", "query", "exact", "vector").mapInArrow(_begin, _STATE), root, "beams0")
    area = nodes.select(F.shiftright("node", _AREA).alias("area"), "node", "vector")
    step = 0
    while state.where("open > 0").limit(1).count():
        step += 1
        open_ = state.where("open > 0")
        named = (open_.mapInArrow(_frontier, "qblock long, query long, node long").join(links, "node")
                 .select("qblock", "query", "ids"))
        asks = stage(spark, open_.groupBy("qblock").cogroup(_renewed(named).groupBy("qblock")).applyInArrow(_wanted, _ASKS),
                     root, f"asks{step}")
        size = F.sum(F.octet_length("vector") + F.octet_length("ids"))
        parts = stage(spark, asks.groupBy("area").agg(F.ceil(size / ASK_BYTES).cast("int").alias("parts")), root, f"parts{step}")
        split = asks.join(parts, "area").withColumn("part", F.pmod(F.xxhash64("query"), F.col("parts")).cast("int"))
        supply = area.join(parts, "area").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        answers = split.groupBy("area", "part").cogroup(_renewed(supply).groupBy("area", "part")).applyInArrow(
            _near, "qblock long, query long, ids binary, sims binary")
        state = stage(spark, state.groupBy("qblock").cogroup(answers.groupBy("qblock")).applyInArrow(_advance(beam), _STATE),
                      root, f"beams{step}")
    pairs = state.select(F.col("qblock").alias("node"), "ids").mapInArrow(_explode_ids, "u long, v long").distinct()
    supply = (pairs.join(nodes.select(F.col("node").alias("v"), "exact", F.col("ids").alias("rows")), "v")
              .select(F.col("u").alias("qblock"), "v", "exact", "rows"))
    return state.groupBy("qblock").cogroup(_renewed(supply).groupBy("qblock")).applyInArrow(_scored(k), _FOUND)


# --------------------------------------------------------------------------
# the operator


def nearest_neighbours(rows: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
                       degree: int = 40, sample: int = 16, beam: int = 112) -> DataFrame:
    """(query_id, rank, id, score) of the ``k`` nearest rows found for each row where ``is_query`` (a condition on "id") holds."""
    spark = rows.sparkSession
    root = scratch(spark, "neighbours")
    given = stage(spark, rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("embedding"))
                  .mapInArrow(_read, "id long, dim int, norm double, exact binary"), root, "given")
    longest = given.agg(F.max("norm")).first()[0]
    first = Window.partitionBy("exact").orderBy("id")
    ids = (given.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
           .groupBy("exact").agg(F.first("dim").alias("dim"), F.sort_array(F.collect_list("id")).alias("ids")))
    codes = "".join(f", code{i} long" for i in range(ORDERS)) + "".join(f", finer{i} double" for i in range(ORDERS))
    placed = stage(spark, ids.mapInArrow(_place(longest or 1.0), f"exact binary, dim int, ids array<long>, vector binary{codes}"),
                   root, "placed")
    in_order = [["code0", "finer0", "exact"]] + [[f"code{i}", f"finer{i}", "node"] for i in range(1, ORDERS)]
    block, local = _dealt(F.col("pos"), F.col("group_rows"), BLOCK)
    nodes = stage(spark, ranked(spark, placed, "dim", in_order[0], root, "order0").withColumn("node", F.shiftleft(
        F.shiftleft(F.col("dim").cast("long"), _BLOCKS - _LOCAL).bitwiseOR(block), _LOCAL).bitwiseOR(local)), root, "nodes")
    group = lambda b: F.shiftleft(F.col("dim").cast("long"), _BLOCKS).bitwiseOR(b)
    among, _ = _dealt(F.col("pos"), F.col("group_rows"), BLOCK * GROUP)
    orders = [nodes.select(group(among).alias("block"), "node", "vector")]
    for i in range(1, ORDERS):
        narrow = ranked(spark, nodes.select("dim", "node", "vector", f"code{i}", f"finer{i}"), "dim", in_order[i], root, f"order{i}")
        orders.append(narrow.select(group(among).alias("block"), "node", "vector"))
    net = graph(spark, nodes, orders, root, degree, sample)

    edges = stage(spark, net.select("node", "ids").mapInArrow(_explode_ids, "u long, v long"), root, "edges")
    back = _thinned(edges, degree, ["v"], 0).select(F.col("u").alias("node"), "v")
    links = edges.select(F.col("u").alias("node"), "v").union(back).distinct()
    links = stage(spark, links.groupBy("node").agg(F.collect_list("v").alias("vs")).mapInArrow(
        _packed, "node long, ids binary"), root, "links")

    asked = stage(spark, given.where(is_query).select("id", "exact").join(nodes.select("exact", "node"), "exact")
                  .select("id", "node"), root, "asked")
    found = stage(spark, search(spark, links, nodes, asked.select("node").distinct(), root, beam, k), root, "found")
    own = F.array_position("own_first", F.col("id"))
    near = (asked.join(found.withColumnRenamed("query", "node"), "node")
            .withColumn("own_first", F.transform("near", lambda x: F.when(x["own"], x["id"])))
            .withColumn("skip", F.coalesce(own, F.lit(0)).cast("int")))
    near = near.select(F.col("id").alias("query_id"), "skip", F.posexplode("near").alias("at", "hit"))
    at = F.col("at") + 1
    rank = at - F.when((F.col("skip") > 0) & (at > F.col("skip")), 1).otherwise(0)
    return (near.where(at != F.col("skip")).where(rank <= k)
            .select("query_id", rank.cast("int").alias("rank"), F.col("hit.id").alias("id"), F.col("hit.score").alias("score")))


def _packed(batches):
    for rb in batches:
        yield pa.RecordBatch.from_arrays(
            [rb.column("node"), pa.array([np.array(x, np.int64).tobytes() for x in rb.column("vs").to_pylist()], pa.binary())],
            ["node", "ids"])


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    found = nearest_neighbours(rows, F.col("id") % 20 == 0)
    return found.withColumnRenamed("id", "vec_id")


OP11_SQL = r"""
WITH e AS (
  SELECT row_number() OVER () AS row, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (
  SELECT a.vec_id AS query_id, a.row, b.vec_id, list_dot_product(a.v, b.v) AS score
  FROM e a JOIN e b ON a.vec_id % 20 = 0 AND a.row <> b.row AND len(a.v) = len(b.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""
