"""Approximate nearest neighbours by inner product: an NN-descent graph and greedy graph search.

A node keeps two lists: the ``DIRECTION`` nodes nearest by angle, whatever their length, and the ``PRODUCT`` nodes of the
largest inner product with it. Angles lead through the whole graph; a node's answers are among the answers of
the nodes that point its way, however lengths are spread. The direction lists start from ``TREES`` random
partitions of the directions, the product lists from these and from the ``LONGEST`` nodes of all. In ``ROUNDS`` rounds every node
compares all of its neighbours with each other (its lists and up to ``REVERSE`` nodes that have it in their direction
list) and each node keeps its best. A query walks the graph from its own node (or any given one), always expanding
the ``BEAM`` best nodes of its pool of ``POOL`` until all of the pool are expanded.

Nodes live in hash blocks of about ``BLOCK`` rows; rounds and search steps are cogrouped Spark joins of packed blocks, in
which a vector travels to a block once however many of its nodes ask for it. Nodes that many lists hold (long vectors)
are asked for once a block, and serve no reverse product links. Partitions that hold too many vectors are split by a
hash; equal vectors are one node, expanded to their smallest ids at the end. Lists, pool and reverse links are parameters of
the method; recall is measured in the tests, with equal and with widely spread lengths.

Defined cases: vectors that are null, zero, of another length than most, or hold null or non-finite components take no
part; ties go to the smaller vec_id; with fewer candidates than asked for, all come back; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlab.llm.common import arrow_map, blobs, flat_blobs, give_back, importable, shared_path, staged
from reviewlab.llm.words import mix

DIRECTION = 24      # nearest by angle in a node's list
PRODUCT = 40        # largest inner products in a node's list
REVERSE = 24        # reverse direction links of a node in a round
LONGEST = 512       # longest vectors, with which every product list starts
TREES = 8
LEAF = 500          # vectors of a partition
CODES = 1 << 16     # partitions of a tree, at most
ROUNDS = 4
BLOCK = 1024
PAIRS = 1 << 18     # compared pairs that a task holds before it keeps the best
POOL = 160
BEAM = 40
QUERIES = 128       # queries of a group
STEPS = 30          # safety bound on search steps; a walk ends when its pool is expanded
NONE = -1


def valid_vectors(table: DataFrame) -> DataFrame:
    """(vec_id, v) with v array<double>: the rows that take part."""
    v = F.col("v")
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.where("vec_id is not null and v is not null").where(
        F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0))
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (size.n if size else 0))


def directions(column: pa.Array, rows: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """(unit vectors, lengths relative to ``scale``) of a column of lists, in single precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    v = column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)
    top = np.abs(v).max(axis=1, keepdims=True)
    v = v / top
    size = np.sqrt((v * v).sum(1))
    return (v / size[:, None]).astype(np.float32), (size * (top[:, 0] / scale)).astype(np.float32)


def _block_of(ids: np.ndarray, blocks: int) -> np.ndarray:
    return (mix(ids.view(np.uint64)) % np.uint64(blocks)).astype(np.int64)


def _pack(block: np.ndarray, **cols: np.ndarray) -> pa.Table:
    """One row per block: the block and a binary of each column's values there."""
    give_back()
    order = np.argsort(block, kind="stable")
    key, first = np.unique(block[order], return_index=True)
    bounds = np.append(first, len(order))
    out = {"block": pa.array(key.astype(np.int64))}
    for name, c in cols.items():
        c = c[order]
        width = 1 if c.ndim == 1 else c.shape[1]
        out[name] = blobs(c.reshape(-1), bounds * width)
    return pa.table(out)


def _read(table: pa.Table, name: str, dtype, width: int = 0) -> np.ndarray:
    flat = flat_blobs(table.column(name), dtype)[0]
    return flat.reshape(-1, width) if width else flat


def _best(node: np.ndarray, other: np.ndarray, score: np.ndarray, nodes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best different others of every node of the sorted ``nodes``: ids (NONE-padded) and scores."""
    ids, out = np.full((len(nodes), k), NONE, np.int64), np.full((len(nodes), k), -np.inf, np.float32)
    if len(node):
        # among equal scores a hash decides, else the same few of many parallel vectors would stand in all lists
        order = np.lexsort((other, mix(other.view(np.uint64) ^ mix(node.view(np.uint64))), -score, node))
        node, other, score = node[order], other[order], score[order]
        again = np.lexsort((other, node))           # drop repeats of (node, other), keeping score order
        same = np.zeros(len(node), bool)
        same[again[1:]] = (node[again[1:]] == node[again[:-1]]) & (other[again[1:]] == other[again[:-1]])
        node, other, score = node[~same], other[~same], score[~same]
        row = np.searchsorted(nodes, node)
        rank = np.arange(len(node)) - np.searchsorted(node, node)
        keep = rank < k
        ids[row[keep], rank[keep]], out[row[keep], rank[keep]] = other[keep], score[keep]
    return ids, out


def _first_of(key: np.ndarray, other: np.ndarray, k: int) -> np.ndarray:
    """Positions of at most ``k`` entries of every key, taken in hash order."""
    order = np.lexsort((mix(other.view(np.uint64) ^ mix(key.view(np.uint64))), key))
    rank = np.arange(len(order)) - np.searchsorted(key[order], key[order])
    return order[rank < k]


def _both_lists(node: np.ndarray, other: np.ndarray, cosine: np.ndarray, product: np.ndarray) -> dict[str, np.ndarray]:
    """What a merge needs of scored pairs: each node's best by angle (kind 0) and by inner product (kind 1)."""
    who = np.unique(node)
    out = {"node": [], "other": [], "score": [], "kind": []}
    for kind, (points, k) in enumerate(((cosine, DIRECTION), (product, PRODUCT))):
        ids, score = _best(node, other, points, who, k)
        has = ids != NONE
        for name, c in zip(out, (np.repeat(who, k).reshape(-1, k)[has], ids[has], score[has], np.full(has.sum(), kind, np.int8))):
            out[name].append(c)
    return {n: np.concatenate(c) for n, c in out.items()}


def _rows_of(parts: list[tuple[np.ndarray, dict[str, np.ndarray]]], names: dict[str, str]) -> pa.Table:
    """The packed rows of several (block, columns), null where a part has no such column."""
    tables = [_pack(block, **cols) for block, cols in parts]
    return pa.concat_tables([pa.table({n: t.column(n) if n in t.column_names else pa.nulls(t.num_rows, pa.binary() if n != "block" else pa.int64())
                                       for n in names}) for t in tables])


WIDTH = DIRECTION + PRODUCT
STATE = "block long, id binary, vec binary, norm binary, nbr binary, score binary"
FOUND = "block long, node binary, other binary, score binary, kind binary"
MESSAGES = "block long, id binary, vec binary, norm binary, limit binary, at binary, of binary, rat binary, rof binary"


class Graph:
    """A staged neighbour graph: packed blocks of nodes (``state``) and of lists with their vectors (``lists``)."""

    def __init__(self, vectors: DataFrame, rounds: int = ROUNDS):
        """``vectors`` has distinct ids and distinct vectors: (vec_id, v)."""
        importable(vectors.sparkSession)
        # lengths are taken relative to the largest component, so that no square leaves the range of a double
        stats = vectors.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d"),
                            F.max(F.aggregate("v", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x)))).alias("m")).first()
        self.count, self.dim, self.scale = stats.n, stats.d or 0, stats.m or 1.0
        self.blocks = max(1, math.ceil(self.count / BLOCK))
        if not self.count:
            return
        self.state = staged(self._start(vectors), "graph-0")
        for i in range(rounds):
            self.state = staged(self._improved(self.state), f"graph-{i + 1}")
        self.lists = self._bucketed(self._messages(self.state, False))

    def _vectors(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, directions (unit vectors) and relative lengths."""
        unit, norm = directions(batch.column("v"), batch.num_rows, self.scale)
        return batch.column("vec_id").to_numpy(), unit, norm

    def _start(self, vectors: DataFrame) -> DataFrame:
        blocks, dim = self.blocks, self.dim
        codes = min(CODES, max(1, self.count // LEAF))
        levels = 1 if codes <= 256 else 2
        per = max(1, math.ceil(codes ** (1 / levels)))
        read = self._vectors

        def code(x: np.ndarray, tree: int) -> np.ndarray:
            out = np.zeros(len(x), np.int64)
            for level in range(levels):
                directions = np.random.default_rng([tree, level]).standard_normal((dim, per))
                out = out * per + ((x @ directions) / np.sqrt((directions ** 2).sum(0))).argmax(1)
            return out * TREES + tree

        def count(batch: pa.RecordBatch) -> pa.RecordBatch:
            _, x, _ = read(batch)
            key, n = np.unique(np.concatenate([code(x, t) for t in range(TREES)]), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["code", "n"])
        heavy = (arrow_map(vectors, count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
                 .where(F.col("n") > 2 * LEAF).collect())           # at most CODES x TREES entries
        context = vectors.sparkSession.sparkContext
        split = context.broadcast({r.code: math.ceil(r.n / (2 * LEAF)) for r in heavy})
        part = F.col("v") if self.scale == 1.0 else F.transform("v", lambda x: x / F.lit(self.scale))
        length = F.aggregate(part, F.lit(0.0), lambda a, x: a + x * x)
        longest = vectors.orderBy(F.desc(length), "vec_id").limit(LONGEST).toArrow()
        longest = context.broadcast(read(longest.combine_chunks().to_batches()[0]))       # at most LONGEST vectors

        def deal(batch: pa.RecordBatch) -> pa.Table:
            ids, x, norm = read(batch)
            parts = []
            for t in range(TREES):
                c = code(x, t)
                salt = np.array([split.value.get(k, 1) for k in c.tolist()])
                salt = (mix(ids.view(np.uint64) ^ np.uint64(t + 1)) % salt.astype(np.uint64)).astype(np.int64)
                parts.append(_pack(c * (1 << 24) + salt, id=ids, vec=x, norm=norm))
            return pa.concat_tables(parts)

        def leaf(group: pa.Table) -> pa.Table:
            ids, x, norm = _read(group, "id", np.int64), _read(group, "vec", np.float32, dim), _read(group, "norm", np.float32)
            s = x @ x.T
            out = []
            for kind, (points, k) in enumerate(((s, DIRECTION // 2), (s * norm, PRODUCT // 2))):
                k = min(k, len(ids) - 1)
                if k < 1:
                    continue
                np.fill_diagonal(points, -np.inf)
                top = np.argpartition(-points, k - 1, axis=1)[:, :k]
                out.append((np.repeat(ids, k), ids[top].reshape(-1), np.take_along_axis(points, top, 1).reshape(-1), np.full(top.size, kind, np.int8)))
            node, other, score, kind = (np.concatenate(c) for c in zip(*out)) if out else (ids[:0], ids[:0], norm[:0], np.zeros(0, np.int8))
            return _pack(_block_of(node, blocks), node=node, other=other, score=score.astype(np.float32), kind=kind)
        found = arrow_map(vectors, deal, "block long, id binary, vec binary, norm binary").groupBy("block").applyInArrow(leaf, FOUND)

        def own(batch: pa.RecordBatch) -> pa.Table:
            ids, x, norm = read(batch)
            far, y, length = longest.value
            k = min(PRODUCT, len(far))
            nbr, score = np.full((len(ids), WIDTH), NONE, np.int64), np.full((len(ids), WIDTH), -np.inf, np.float32)
            for lo in range(0, len(ids), BLOCK):
                some, to = slice(lo, lo + BLOCK), slice(DIRECTION, DIRECTION + k)
                points = (x[some] @ y.T) * length
                points[ids[some, None] == far] = -np.inf
                top = np.argpartition(-points, k - 1, axis=1)[:, :k]
                nbr[some, to], score[some, to] = far[top], np.take_along_axis(points, top, 1)
            nbr[score == -np.inf] = NONE
            return _pack(_block_of(ids, blocks), id=ids, vec=x, norm=norm, nbr=nbr, score=score)
        return self._merged(arrow_map(vectors, own, STATE), found)

    def _merged(self, state: DataFrame, found: DataFrame) -> DataFrame:
        """Every node's best of its lists and the (node, other, score, kind) found for it."""
        dim = self.dim

        def merge(left: pa.Table, right: pa.Table) -> pa.Table:
            ids, x, norm = _read(left, "id", np.int64), _read(left, "vec", np.float32, dim), _read(left, "norm", np.float32)
            nbr, score = _read(left, "nbr", np.int64, WIDTH), _read(left, "score", np.float32, WIDTH)
            order = np.argsort(ids)
            new, best = [], []
            kinds = _read(right, "kind", np.int8)
            given = [_read(right, n, d) for n, d in (("node", np.int64), ("other", np.int64), ("score", np.float32))]
            for kind, part in enumerate((slice(0, DIRECTION), slice(DIRECTION, WIDTH))):
                has = nbr[:, part] != NONE
                k = has.shape[1]
                old = np.repeat(ids, k).reshape(-1, k)[has], nbr[:, part][has], score[:, part][has]
                a, b = _best(*(np.concatenate([o, g[kinds == kind]]) for o, g in zip(old, given)), ids[order], k)
                new.append(a)
                best.append(b)
            block = left.column("block")[0].as_py() if left.num_rows else 0
            return _pack(np.full(len(ids), block), id=ids[order], vec=x[order], norm=norm[order], nbr=np.hstack(new), score=np.hstack(best))
        return state.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(merge, STATE)

    def _messages(self, state: DataFrame, both: bool) -> DataFrame:
        """Per block: vectors (id, vec, norm, limit: the two scores a new neighbour must beat) and links: node ``at`` of the
        block has ``of`` in a list, node ``rat`` stands in the direction list of ``rof`` (only with ``both``)."""
        blocks, dim = self.blocks, self.dim
        kind = np.float16 if both else np.float32       # half precision will do to find neighbours, not to rank them

        def requests(batch: pa.RecordBatch) -> pa.Table:
            t = pa.Table.from_batches([batch])
            parts = []
            for b, nbr in zip(t.column("block").to_pylist(), t.column("nbr")):
                nbr = np.unique(np.frombuffer(nbr.as_py(), np.int64))
                nbr = nbr[nbr != NONE]
                parts.append(_pack(_block_of(nbr, blocks), want=nbr, need=np.full(len(nbr), b, np.int64)))
            return pa.concat_tables(parts)
        asked = arrow_map(state, requests, "block long, want binary, need binary")

        def send(left: pa.Table, right: pa.Table) -> pa.Table:
            ids, x, norm = _read(left, "id", np.int64), _read(left, "vec", np.float32, dim), _read(left, "norm", np.float32)
            nbr, score = _read(left, "nbr", np.int64, WIDTH), _read(left, "score", np.float32, WIDTH)
            want, need = _read(right, "want", np.int64), _read(right, "need", np.int64)
            order = np.argsort(ids)
            row = order[np.searchsorted(ids[order], want)]
            has = nbr != NONE
            own = np.full(has.sum(), left.column("block")[0].as_py() if left.num_rows else 0)
            parts = [(own, {"at": np.repeat(ids, WIDTH).reshape(-1, WIDTH)[has], "of": nbr[has]})]
            if both:
                near = has.copy()
                near[:, DIRECTION:] = False
                rat, rof, by = nbr[near], np.repeat(ids, WIDTH).reshape(-1, WIDTH)[near], np.nonzero(near)[0]
                some = _first_of(rat, rof, REVERSE)
                rat, rof, by = rat[some], rof[some], by[some]
                block = _block_of(rat, blocks)
                parts.append((block, {"rat": rat, "rof": rof}))
                need, row = np.concatenate([need, block]), np.concatenate([row, by])
            pair = np.unique(need * np.int64(max(1, len(ids))) + row)
            need, row = pair // max(1, len(ids)), pair % max(1, len(ids))
            limit = np.stack([score[row, DIRECTION - 1], score[row, WIDTH - 1]], axis=1)
            parts.append((need, {"id": ids[row], "vec": x[row].astype(kind), "norm": norm[row], "limit": limit}))
            return _rows_of(parts, [c.split()[0] for c in MESSAGES.split(", ")])
        return state.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(send, MESSAGES)

    def _improved(self, state: DataFrame) -> DataFrame:
        blocks, dim = self.blocks, self.dim

        def join(group: pa.Table) -> pa.Table:
            ids, x = _read(group, "id", np.int64), _read(group, "vec", np.float16, dim)
            norm, limit = _read(group, "norm", np.float32), _read(group, "limit", np.float32, 2)
            at, of, rat, rof = (_read(group, n, np.int64) for n in ("at", "of", "rat", "rof"))
            some = _first_of(rat, rof, REVERSE)
            at, of = np.concatenate([at, rat[some]]), np.concatenate([of, rof[some]])
            ids, first = np.unique(ids, return_index=True)          # a vector may come for both kinds of links
            x, norm, limit = x[first], norm[first], limit[first]
            here, place = np.unique(at, return_inverse=True)
            pair = np.unique(place * np.int64(max(1, len(ids))) + np.searchsorted(ids, of))
            place, of = pair // max(1, len(ids)), pair % max(1, len(ids))
            bounds = np.searchsorted(place, np.arange(len(here) + 1))
            held, kept, size = [], [], 0

            def keep_best() -> None:
                if held:
                    kept.append(_both_lists(*(np.concatenate(c) for c in zip(*held))))
                held.clear()
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                m = of[lo:hi]
                v = x[m].astype(np.float32)
                s = v @ v.T
                np.fill_diagonal(s, -np.inf)
                p = s * norm[m]
                a, b = np.nonzero((s > limit[m][:, :1]) | (p > limit[m][:, 1:]))
                held.append((m[a], m[b], s[a, b], p[a, b]))
                size += len(a)
                if size > PAIRS:
                    keep_best()
                    size = 0
            keep_best()
            if not kept:
                return _pack(np.zeros(0, np.int64), node=ids[:0], other=ids[:0], score=norm[:0], kind=np.zeros(0, np.int8))
            out = {n: np.concatenate([k[n] for k in kept]) for n in kept[0]}
            node, other = ids[out["node"]], ids[out["other"]]
            return _pack(_block_of(node, blocks), node=node, other=other, score=out["score"], kind=out["kind"])
        found = self._messages(state, True).groupBy("block").applyInArrow(join, FOUND)
        return self._merged(state, found)

    def _bucketed(self, df: DataFrame) -> DataFrame:
        """The search lists, bucketed by block so that search steps move only requests."""
        spark = df.sparkSession
        path = shared_path(spark, "graph-lists")
        made = "llm_" + path.rsplit("/", 1)[1].replace("-", "_")
        n = min(self.blocks, max(12, int(spark.conf.get("spark.sql.shuffle.partitions"))))
        df.repartition(n, "block").write.format("parquet").option("path", path).bucketBy(n, "block").saveAsTable(made)
        return spark.table(made)

    def search(self, queries: DataFrame, k: int, pool: int = POOL, beam: int = BEAM) -> DataFrame:
        """(query_id, node, score) of each query's ``k`` best nodes found, scored in single precision.

        ``queries`` has (query_id, v, start): start is the node where the walk begins."""
        blocks, width = self.blocks, self.dim
        groups = max(1, math.ceil(queries.count() / QUERIES))
        state = "block long, query binary, vec binary, node binary, score binary, open binary, size binary"

        def begin(batch: pa.RecordBatch) -> pa.Table:
            q = batch.column("query_id").to_numpy()
            v, _ = directions(batch.column("v"), len(q), 1.0)      # a query's own length does not change its order
            one = np.ones(len(q), np.int32)
            return _pack(_block_of(q, groups), query=q, vec=v, node=batch.column("start").to_numpy(), score=np.full(len(q), -np.inf), open=one, size=one)
        now = staged(arrow_map(queries.select("query_id", "v", "start"), begin, state), "walk-0")

        def ask(batch: pa.RecordBatch) -> pa.Table:
            t = pa.Table.from_batches([batch])
            q, v, size = _read(t, "query", np.int64), _read(t, "vec", np.float32, width), _read(t, "size", np.int32)
            node, score, opened = _read(t, "node", np.int64), _read(t, "score", np.float64), _read(t, "open", np.int32)
            owner = np.repeat(np.arange(len(q)), size)
            worst = np.full(len(q), -np.inf)
            end = np.cumsum(size)
            full = size >= pool
            worst[full] = score[end[full] - 1]
            left = np.flatnonzero(opened == 1)
            rank = np.arange(len(left)) - np.searchsorted(owner[left], owner[left])
            pick = left[rank < beam]
            block = _block_of(node[pick], blocks)
            pair, inv = np.unique(block * np.int64(len(q)) + owner[pick], return_inverse=True)
            need, row = pair // len(q), pair % len(q)
            a = _pack(need, query=q[row], vec=v[row], worst=worst[row])
            b = _pack(block, node=node[pick], of=q[owner[pick]])
            names = ["block", "query", "vec", "worst", "node", "of"]
            return pa.concat_tables([pa.table({n: t.column(n) if n in t.column_names else pa.nulls(t.num_rows, pa.binary()) for n in names}) for t in (a, b)])

        def answer(left: pa.Table, right: pa.Table) -> pa.Table:
            ids, x = _read(left, "id", np.int64), _read(left, "vec", np.float32, width)
            norm = _read(left, "norm", np.float32)
            at, of = _read(left, "at", np.int64), _read(left, "of", np.int64)
            order = np.argsort(ids)
            ids, x, norm = ids[order], x[order], norm[order]
            order = np.argsort(at, kind="stable")
            at, of = at[order], np.searchsorted(ids, of[order])
            q, v, worst = _read(right, "query", np.int64), _read(right, "vec", np.float32, width), _read(right, "worst", np.float64)
            node, by = _read(right, "node", np.int64), _read(right, "of", np.int64)
            order = np.argsort(q)
            q, v, worst = q[order], v[order], worst[order]
            lo, hi = np.searchsorted(at, node), np.searchsorted(at, node, "right")
            row = np.repeat(np.searchsorted(q, by), hi - lo)
            entry = np.arange((hi - lo).sum()) + np.repeat(lo - (np.cumsum(hi - lo) - (hi - lo)), hi - lo)
            pair = np.unique(row * np.int64(max(1, len(ids))) + of[entry])
            row, col = pair // max(1, len(ids)), pair % max(1, len(ids))
            s = np.concatenate([np.einsum("ij,ij->i", v[row[i:i + 16384]], x[col[i:i + 16384]]) for i in range(0, len(row), 16384)] or [np.zeros(0)]).astype(np.float64) * norm[col]
            keep = s >= worst[row]
            row, col, s = row[keep], col[keep], s[keep]
            return _pack(_block_of(q[row], groups), of=q[row], other=ids[col], points=s)

        def step(left: pa.Table, right: pa.Table) -> pa.Table:
            q, v, size = _read(left, "query", np.int64), _read(left, "vec", np.float32, width), _read(left, "size", np.int32)
            node, score, opened = _read(left, "node", np.int64), _read(left, "score", np.float64), _read(left, "open", np.int32).copy()
            owner = np.repeat(np.arange(len(q)), size)
            left_over = np.flatnonzero(opened == 1)
            rank = np.arange(len(left_over)) - np.searchsorted(owner[left_over], owner[left_over])
            opened[left_over[rank < beam]] = 0
            order = np.argsort(q)
            of = order[np.searchsorted(q[order], _read(right, "of", np.int64))] if right.num_rows else np.zeros(0, np.int64)
            owner = np.concatenate([owner, of])
            node = np.concatenate([node, _read(right, "other", np.int64)])
            score = np.concatenate([score, _read(right, "points", np.float64)])
            opened = np.concatenate([opened, np.ones(len(of), np.int32)])
            # of one node keep the entry with a score, expanded if either is
            by = np.lexsort((opened, -score, node, owner))
            owner, node, score, opened = owner[by], node[by], score[by], opened[by]
            head = np.ones(len(owner), bool)
            head[1:] = (owner[1:] != owner[:-1]) | (node[1:] != node[:-1])
            opened = np.minimum.reduceat(opened, np.flatnonzero(head)) if len(owner) else opened
            owner, node, score = owner[head], node[head], score[head]
            by = np.lexsort((node, -score, owner))
            owner, node, score, opened = owner[by], node[by], score[by], opened[by]
            keep = np.arange(len(owner)) - np.searchsorted(owner, owner) < pool
            owner, node, score, opened = owner[keep], node[keep], score[keep], opened[keep]
            size = np.bincount(owner, minlength=len(q)).astype(np.int32)
            one = pa.table({"block": left.column("block")[:1]} | {n: blobs(np.ascontiguousarray(c).reshape(-1), [0, c.size])
                           for n, c in (("query", q), ("vec", v), ("node", node), ("score", score), ("open", opened), ("size", size))})
            return one
        lists = self.lists.select("block", "id", "vec", "norm", "at", "of")
        for i in range(STEPS):
            asked = arrow_map(now, ask, "block long, query binary, vec binary, worst binary, node binary, of binary")
            answers = lists.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(answer, "block long, of binary, other binary, points binary")
            now = staged(now.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(step, state), f"walk-{i + 1}")

            def waiting(batch: pa.RecordBatch) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array([int(_read(pa.Table.from_batches([batch]), "open", np.int32).sum())])], names=["n"])
            if not (arrow_map(now.select("open"), waiting, "n long").agg(F.sum("n")).first()[0] or 0):
                break

        def result(batch: pa.RecordBatch) -> pa.RecordBatch:
            t = pa.Table.from_batches([batch])
            q, size = _read(t, "query", np.int64), _read(t, "size", np.int32)
            node, score = _read(t, "node", np.int64), _read(t, "score", np.float64)
            rank = np.concatenate([np.arange(n) for n in size.tolist()] or [np.zeros(0, int)])
            keep = (rank < k) & (score > -np.inf)
            return pa.RecordBatch.from_arrays([pa.array(np.repeat(q, size)[keep]), pa.array(node[keep]), pa.array(score[keep])], names=["query_id", "node", "score"])
        return arrow_map(now, result, "query_id long, node long, score double")


def nearest(table: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best other rows found for every row whose id is divisible by ``every``."""
    rows = staged(valid_vectors(table), "vectors")
    # of the copies of a vector only the smallest ids can be answers; the limit on ranks cuts them before the shuffle
    member = rows.distinct().withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("r") <= k + 1)
    member = staged(member.withColumn("node", F.min("vec_id").over(Window.partitionBy("v"))), "members")
    nodes = member.where("r = 1").select("node", "v")
    graph = Graph(nodes.select(F.col("node").alias("vec_id"), "v"))
    spark = table.sparkSession
    if not graph.count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    queries = (rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "v").distinct()
               .join(nodes.select("v", F.col("node").alias("start")), "v"))
    queries = staged(queries, "queries")
    # the walk compares in single precision; twice as many nodes as needed are scored again on the original vectors,
    # and a query's own node, which may stand for other rows too
    found = graph.search(queries, 2 * k + 2).select("query_id", "node").union(queries.select("query_id", F.col("start").alias("node"))).distinct()
    found = (found.join(queries.select("query_id", F.col("v").alias("q")), "query_id").join(nodes.select("node", "v"), "node")
             .select("query_id", "node", F.aggregate(F.zip_with("q", "v", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x).alias("score")))
    member = member.select("node", "vec_id")
    hits = (found.join(member, "node").select("query_id", "vec_id", "score")
            .where("vec_id <> query_id"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
