"""Near-duplicate vectors by cosine, with a navigable small-world graph per shard.

Vectors are dealt to shards by hash and each shard builds a hierarchical graph over its own, in
numpy: points enter in batches that search the graph in lockstep, neighbours are chosen for
diversity. Before a graph is used it is audited: a bounded sample of its own members and one of all
vectors, each with its links in the shard by brute force, are searched for, and the beam widens until
the mean recall over them passes. If no beam that is worth its cost passes, the shard is searched by
plain scans instead, so the audit cannot fail in silence; its figure is kept with the graph. Then
every vector queries every shard; the beam of a query whose hits fill it widens until they don't, and
beyond an eighth of the shard a scan takes its place, so a group of alike vectors is found whole
however large it is. Hits come in blocks of bounded size; they are verified by their cosine in
double precision. Graphs and blocks of queries travel in rows of PIECE bytes; a task holds one graph and
has a span of blocks pass by, and shards are queried SLICE_SHARDS at a time, so that what is shuffled at once
is so many times the vectors. Tasks report counts of links, and of the links themselves only a spanning forest,
which is all that the union into components needs.

Equal vectors are one node with a multiplicity. Defined results: null or empty vectors, zero
vectors and those with null or non-finite components link with nothing; vectors of different
length don't link; repeated vec_ids are rows of their own; a null vec_id never names a component
unless all members have none; vectors are as long as they come, a shard's must fit a task's memory several
times; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.common import bounded_batches, cleared, dropped, staged
from panelforge.llm.components import connected_components

#: A hit needs the threshold in double precision; the beam ranks by single precision.
SLACK = 1e-4
BLOCK = 1 << 21  # numbers in a block of similarities
PIECE = 1 << 19  # bytes of a graph or of queries that travel as one row
SPAN_BLOCKS = 16  # blocks of queries that a task has at most, with one graph
SLICE_SHARDS = 4  # shards that are queried in one job


class Graph:
    """A navigable small world over unit vectors; layers[0] has all points."""

    def __init__(self, vectors: np.ndarray, links: int = 12):
        self.x, self.links = np.ascontiguousarray(vectors, np.float32), links
        self.layers: list[np.ndarray] = []  # neighbours by point, -1 where there are none
        self.entry = 0

    # search -----------------------------------------------------------------

    def _beam(self, q: np.ndarray, start: np.ndarray, layer: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The best `width` points that lockstep searches reach, with their similarities; -1 pads."""
        near, n = self.layers[layer], len(q)
        ids, sims = np.full((n, width), -1), np.full((n, width), -np.inf, np.float32)
        ids[:, 0] = start
        sims[:, 0] = np.einsum("nd,nd->n", self.x[start], q)
        open_ = np.zeros((n, width), bool)
        open_[:, 0] = True
        seen = np.zeros((n, len(self.x)), bool)
        seen[np.arange(n), start] = True
        live = np.arange(n)
        step = min(width, 4)
        while len(live):
            rank = np.where(open_[live], sims[live], -np.inf)
            at = np.argpartition(-rank, step - 1, 1)[:, :step] if step < width else np.broadcast_to(np.arange(width), rank.shape)
            ok = np.take_along_axis(rank, at, 1) > -np.inf
            has = ok.any(1)
            live, at, ok = live[has], at[has], ok[has]
            if not len(live):
                break
            open_[live[:, None], at] = False
            nb = np.where(ok[:, :, None], near[ids[live[:, None], at]], -1).reshape(len(live), -1)
            row = np.broadcast_to(live[:, None], nb.shape)
            new = (nb >= 0) & ~seen[row, np.maximum(nb, 0)]
            seen[row[new], nb[new]] = True
            # a point that two of the expanded list is taken once
            order = np.argsort(np.where(new, nb, -1), 1, kind="stable")
            s = np.take_along_axis(np.where(new, nb, -1), order, 1)
            s[:, 1:][s[:, 1:] == s[:, :-1]] = -1
            r, c = np.nonzero(s >= 0)
            got = np.full(s.shape, -np.inf, np.float32)
            got[r, c] = np.einsum("nd,nd->n", self.x[s[r, c]], q[live[r]])
            all_ids, all_sims = np.concatenate((ids[live], s), 1), np.concatenate((sims[live], got), 1)
            all_open = np.concatenate((open_[live], s >= 0), 1)
            keep = np.argpartition(-all_sims, width - 1, 1)[:, :width]
            ids[live], sims[live] = np.take_along_axis(all_ids, keep, 1), np.take_along_axis(all_sims, keep, 1)
            open_[live] = np.take_along_axis(all_open, keep, 1)
        return ids, sims

    def search(self, q: np.ndarray, width: int, down_to: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """From the entry down through the layers, then a beam of `width` on the last."""
        at = np.full(len(q), self.entry)
        for layer in range(len(self.layers) - 1, down_to, -1):
            ids, sims = self._beam(q, at, layer, 4)
            at = ids[np.arange(len(q)), sims.argmax(1)]
        return self._beam(q, at, down_to, max(width, 4))

    # building -----------------------------------------------------------------

    def _diverse(self, base: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """For each base point, candidates nearer to it than to any chosen before; the nearest fill up."""
        order = np.argsort(-sims, 1, kind="stable")[:, : 4 * most]
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        v = self.x[np.maximum(ids, 0)]
        between = v @ v.transpose(0, 2, 1)
        chosen = np.zeros(ids.shape, bool)
        for j in range(ids.shape[1]):
            rival = np.where(chosen, between[:, j], -np.inf).max(1)
            chosen[:, j] = (sims[:, j] > -np.inf) & (rival < sims[:, j]) & (chosen.sum(1) < most)
        first = np.argsort(~chosen, 1, kind="stable")[:, :most]
        out = np.full((len(base), most), -1)
        out[:, : first.shape[1]] = np.where(np.take_along_axis(sims, first, 1) > -np.inf, np.take_along_axis(ids, first, 1), -1)
        return out

    def _connect(self, layer: int, points: np.ndarray, ids: np.ndarray, sims: np.ndarray) -> None:
        """Links the points to diverse candidates and back; full neighbours choose anew."""
        near = self.layers[layer]
        most = near.shape[1]
        chosen = self._diverse(points, ids, sims, self.links)
        near[points, : self.links] = chosen
        near[points, self.links :] = -1
        r, c = np.nonzero(chosen >= 0)
        to, frm = chosen[r, c], points[r]
        order = np.argsort(to, kind="stable")
        to, frm = to[order], frm[order]
        where, first, count = np.unique(to, return_index=True, return_counts=True)
        for k in range(0, len(where), 2048):
            w, f, n = where[k : k + 2048], first[k : k + 2048], count[k : k + 2048]
            extra = np.full((len(w), n.max()), -1)
            col = np.arange(n.max())
            inside = col < n[:, None]
            extra[inside] = frm[(f[:, None] + col)[inside]]
            both = np.concatenate((near[w], extra), 1)
            s = np.sort(both, 1)
            s[:, 1:][s[:, 1:] == s[:, :-1]] = -1
            sim = np.where(s >= 0, np.einsum("nkd,nd->nk", self.x[np.maximum(s, 0)], self.x[w]), -np.inf)
            few = (s >= 0).sum(1) <= most
            packed = np.take_along_axis(s, np.argsort(s < 0, 1, kind="stable"), 1)
            if packed.shape[1] < most:
                packed = np.pad(packed, ((0, 0), (0, most - packed.shape[1])), constant_values=-1)
            near[w[few]] = packed[few, :most]
            if not few.all():
                near[w[~few]] = self._diverse(w[~few], s[~few], sim[~few], most)

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int = 1, links: int = 12, beam: int = 32, batch: int = 512) -> Graph:
        g = cls(vectors, links)
        n = len(g.x)
        rng = np.random.default_rng(seed)
        level = np.floor(-np.log(np.maximum(rng.random(n), 1e-12)) / np.log(links)).astype(int)
        order = np.argsort(-level, kind="stable")  # points of high layers first
        g.entry = int(order[0])
        top = int(level[g.entry])
        g.layers = [np.full((n, 2 * links if k == 0 else links), -1) for k in range(top + 1)]
        at, size = 0, 64
        while at < n:
            part = order[at : at + size]
            for layer in range(int(level[part].max()), -1, -1):
                mine = part[level[part] >= layer]
                q = g.x[mine]
                inner = q @ q.T
                np.fill_diagonal(inner, -np.inf)
                k = min(len(mine) - 1, beam)
                best = np.argpartition(-inner, k - 1, 1)[:, :k] if k else np.zeros((len(mine), 0), int)
                ids, sims = mine[best], np.take_along_axis(inner, best, 1)
                if at:
                    old, s = g.search(q, beam, layer)
                    ids, sims = np.concatenate((ids, old), 1), np.concatenate((sims, s), 1)
                if ids.shape[1]:
                    g._connect(layer, mine, ids, sims)
            at, size = at + size, min(batch, 2 * size)
        return g

    # audits and range queries ---------------------------------------------------

    def scan(self, q: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, point) of all pairs with at least `least`, a block of queries at a time."""
        step = max(1, BLOCK // max(1, len(self.x)))
        for k in range(0, len(q), step):
            r, c = np.nonzero(q[k : k + step] @ self.x.T >= least)
            yield r + k, c

    def hits(self, q: np.ndarray, least: float, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, point) found with at least `least`, in blocks; beams as wide as it takes. Width 0: by scans."""
        left, most = np.arange(len(q)), len(self.x) // 8
        while len(left):
            if not 0 < width <= most:
                for r, c in self.scan(q[left], least):
                    yield left[r], c
                return
            full, step = [], max(1, BLOCK // (8 * width))
            for k in range(0, len(left), step):
                part = left[k : k + step]
                ids, sims = self.search(q[part], width)
                over = (sims >= least).sum(1) >= 0.75 * ids.shape[1]
                r, c = np.nonzero((sims >= least) & ~over[:, None])
                yield part[r], ids[r, c]
                full.append(part[over])
            left, width = np.concatenate(full), 4 * width

    def audited_width(self, least: float, start: int, goal: float, others: np.ndarray, sample: int = 512) -> tuple[int, float]:
        """The beam at which queries with links find them, and the mean recall there; 0 if only scans do."""
        own = np.arange(len(self.x))[:: max(1, len(self.x) // sample)][:sample]
        q = np.concatenate((self.x[own], others.astype(np.float32).reshape(-1, self.x.shape[1])))
        truth = [np.zeros(0, np.int64)] * len(q)
        for r, c in self.scan(q, least):
            for i, points in zip(*_grouped(r, c)):
                truth[i] = points
        for i, p in enumerate(own.tolist()):
            truth[i] = truth[i][truth[i] != p]
        tested = np.array([i for i, t in enumerate(truth) if len(t)], np.int64)
        width = start
        while len(tested) and width <= len(self.x) // 8:
            found = np.zeros(len(tested))
            for r, c in self.hits(q[tested], least, width):
                for i, points in zip(*_grouped(r, c)):
                    found[i] += np.isin(points, truth[tested[i]]).sum()
            if (recall := float(np.mean(found / [len(truth[i]) for i in tested]))) >= goal:
                return width, recall
            width *= 2
        return (0, 1.0) if len(tested) or width > len(self.x) // 8 else (width, 1.0)


def _grouped(r: np.ndarray, c: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """The values of r, and c's at each."""
    if not len(r):
        return [], []
    order = np.argsort(r, kind="stable")
    values, first = np.unique(r[order], return_index=True)
    return values.tolist(), np.split(c[order], first[1:])


class _Forest:
    """Those of the links between queries and points that join two trees: fewer than nodes."""

    def __init__(self, queries: np.ndarray, points: np.ndarray):
        self.nodes = np.concatenate((queries, points))
        _, self.tree = np.unique(self.nodes, return_inverse=True)  # a query that is a point too is one node
        self.points_from, self.links = len(queries), []

    def add(self, q: np.ndarray, p: np.ndarray) -> None:
        """Links of queries and points by their places. In rounds: one link for each tree, then the trees are merged."""
        p = p + self.points_from
        while True:
            apart = self.tree[q] != self.tree[p]
            if not apart.any():
                return
            q, p = q[apart], p[apart]
            x, y = self.tree[q], self.tree[p]
            chosen = np.unique(np.concatenate([np.unique(side, return_index=True)[1] for side in (x, y)]))
            root: dict[int, int] = {}

            def find(t: int) -> int:
                while (r := root.get(t, t)) != t:
                    root[t] = root.get(r, r)
                    t = r
                return t

            for i in chosen.tolist():
                if (a := find(int(x[i]))) != (b := find(int(y[i]))):
                    root[max(a, b)] = min(a, b)
                    self.links.append((int(self.nodes[q[i]]), int(self.nodes[p[i]])))
            known = np.array(sorted(root), np.int64)
            now = np.arange(int(self.tree.max()) + 1)
            now[known] = [find(t) for t in known.tolist()]
            self.tree = now[self.tree]


def _normalised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """_uid, vec_id, and the unit vector as bytes of doubles (null if it can't link)."""
    for b in batches:
        out = []
        for v in b.column(2):
            x = v.values.to_numpy(zero_copy_only=False).astype(np.float64) if v.is_valid and len(v.values) else None
            if x is not None and np.isfinite(x).all() and (top := np.abs(x).max()) > 0:
                x = x / top
                x = x / np.sqrt(x @ x)
                out.append(x.tobytes())
            else:
                out.append(None)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())], names=["_uid", "vec_id", "unit"])


def _build(links: int, beam: int, start: int, least: float, goal: float, others: dict[int, bytes]):
    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node")
        x = np.stack([np.frombuffer(u, np.float64) for u in group["unit"]])
        g = Graph.build(x, links=links, beam=beam)
        width, recall = g.audited_width(least - SLACK, start, goal, np.frombuffer(others.get(x.shape[1], b""), np.float64))
        whole = pickle.dumps((x, [layer.astype(np.int32) for layer in g.layers], g.entry, group["node"].to_numpy(np.int64), group["times"].to_numpy(np.int64), width))
        pieces = [whole[i : i + PIECE] for i in range(0, len(whole), PIECE)]
        return pd.DataFrame({"dim": x.shape[1], "shard": group["shard"].iloc[0], "piece": range(len(pieces)), "nodes": None, "data": pieces, "beam": width, "recall": recall})

    return build


#: A graph in pieces, so that no row is large; its beam and its recall are those of the audit.
GRAPH_SCHEMA = "dim int, shard int, piece int, nodes binary, data binary, beam int, recall double"
#: A block of queries in pieces: numbers of the nodes, and their unit vectors.
QUERY_SCHEMA = "dim int, block int, piece int, nodes binary, data binary"


def _queries(group: pd.DataFrame) -> pd.DataFrame:
    """A block's vectors in pieces of some PIECE bytes."""
    dim, block, step = int(group["dim"].iloc[0]), group["block"].iloc[0], max(1, PIECE // (8 * int(group["dim"].iloc[0])))
    parts = [group.iloc[i : i + step] for i in range(0, len(group), step)]
    return pd.DataFrame({"dim": dim, "block": block, "piece": range(len(parts)), "nodes": [p["node"].to_numpy(np.int64).tobytes() for p in parts], "data": [b"".join(p["unit"]) for p in parts]})


def _query(batches: Iterator[pa.RecordBatch], links: int, least: float, lockstep: int) -> Iterator[pa.RecordBatch]:
    """Rows of (dim, shard, block, piece, nodes, data) in this order: first a shard's graph (block -1), then the blocks that query it."""

    def graph(rows: list[tuple]) -> tuple[Graph, np.ndarray, np.ndarray, np.ndarray, int]:
        x, layers, entry, nodes, times, beam = pickle.loads(b"".join(r[1] for r in rows))
        g = Graph(x, links)
        g.layers, g.entry = layers, entry
        return g, x, nodes, times, beam

    def answered(rows: list[tuple], to: tuple[Graph, np.ndarray, np.ndarray, np.ndarray, int]) -> pa.RecordBatch:
        g, x, nodes, times, beam = to
        ids, units = np.concatenate([np.frombuffer(r[0], np.int64) for r in rows]), np.concatenate([np.frombuffer(r[1], np.float64) for r in rows]).reshape(-1, x.shape[1])
        tree, some, counts = _Forest(ids, nodes), [], []
        for k in range(0, len(ids), lockstep):
            q = units[k : k + lockstep]
            mine, n = ids[k : k + lockstep], np.zeros(len(q), np.int64)
            for i, p in g.hits(q.astype(np.float32), least - SLACK, beam):
                for j in range(0, len(i), part := max(1, BLOCK // x.shape[1])):
                    u, v = i[j : j + part], p[j : j + part]
                    sure = (np.einsum("nd,nd->n", q[u], x[v]) >= least) & (mine[u] != nodes[v])
                    u, v = u[sure], v[sure]
                    n += np.bincount(u, times[v], len(q)).astype(np.int64)
                    tree.add(u + k, v)
            on = np.flatnonzero(n)
            some.append(mine[on])
            counts.append(n[on])
        one, two = (np.array([link[side] for link in tree.links], np.int64) for side in (0, 1))
        some, counts = np.concatenate(some), np.concatenate(counts)
        other = pa.array(np.concatenate((np.zeros(len(some), np.int64), two)), mask=np.arange(len(some) + len(two)) < len(some))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate((some, one))), other, pa.array(np.concatenate((counts, np.zeros(len(one), np.int64))))], names=["node", "other", "n"])

    at, held, shard, to = None, [], None, None

    def done() -> Iterator[pa.RecordBatch]:
        nonlocal shard, to
        if held and at[2] < 0:
            shard, to = at[:2], None  # the graph before goes first
            to = graph(held)
        elif held and shard == at[:2]:
            yield answered(held, to)

    for batch in batches:
        for *key, _, nodes, data in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 3, 4, 5))):
            if key != at:
                yield from done()
                at, held = key, []
            held.append((nodes, data))
    yield from done()


def near_vectors(vectors: DataFrame, least: float = 0.95, shard_rows: int = 32768, block_rows: int = 16384, links: int = 12, beam: int = 32, start: int = 16, goal: float = 0.999, lockstep: int = 1024, audit_rows: int = 512) -> DataFrame:
    """A row per vector: vec_id, n_links, component_id, kept.

    audit_rows: vectors of each length, the first by hash, that every shard's audit searches for
    besides its own members; they alone go to the driver and to all tasks.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = vectors.select(F.monotonically_increasing_id().alias("_uid"), F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = staged(rows.mapInArrow(_normalised, "_uid long, vec_id long, unit binary"), "vectors")
    nodes = rows.filter("unit is not null").groupBy("unit").agg(F.min("_uid").alias("node"), F.count("*").alias("times"), F.min("vec_id").alias("least_id"))
    nodes = staged(nodes, "vector-nodes")
    total = nodes.count()
    shards, blocks = max(4, -(-total // shard_rows)), -(-max(total, 1) // block_rows)
    dim = (F.octet_length("unit") / 8).cast("int")
    placed = nodes.select("node", "unit", "times", dim.alias("dim"), F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int").alias("shard"))
    mixed = F.row_number().over(Window.partitionBy("dim").orderBy(F.xxhash64("node", F.lit(2)), "node"))
    chosen = placed.withColumn("_rank", mixed).filter(F.col("_rank") <= audit_rows).select("dim", "unit").collect()
    others: dict[int, bytes] = {}
    for c in chosen:
        others[c["dim"]] = others.get(c["dim"], b"") + bytes(c["unit"])
    graphs = staged(placed.groupBy("dim", "shard").applyInPandas(_build(links, beam, start, least, goal, others), GRAPH_SCHEMA), "vector-graphs")

    block = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(blocks)).cast("int")
    queries = staged(placed.select("node", "unit", "dim", block.alias("block")).groupBy("dim", "block").applyInPandas(_queries, QUERY_SCHEMA), "vector-queries")
    # a task holds one graph and has a span of blocks pass by; shards come in slices, so that what is shuffled is so many times the vectors
    slots = 2 * spark.sparkContext.defaultParallelism
    spans = min(blocks, max(-(-blocks // SPAN_BLOCKS), -(-slots // SLICE_SHARDS)))
    order = ["dim", "shard", "block", "piece"]
    found = []
    for first in range(0, shards, SLICE_SHARDS):
        last = min(first + SLICE_SHARDS, shards) - 1
        one = graphs.filter(F.col("shard").between(first, last)).select("dim", "shard", F.lit(-1).alias("block"), "piece", "nodes", "data", F.explode(F.sequence(F.lit(0), F.lit(spans - 1))).alias("span"))
        two = queries.select("dim", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("shard"), "block", "piece", "nodes", "data", F.pmod("block", F.lit(spans)).alias("span"))
        task = (F.col("shard") - first) * spans + F.col("span") + F.col("dim")
        met = one.unionByName(two).repartitionById(spans * (last - first + 1), task).sortWithinPartitions("dim", "shard", "span", "block", "piece").select(*order, "nodes", "data")
        found.append(staged(met.mapInArrow(partial(_query, links=links, least=least, lockstep=lockstep), "node long, other long, n long"), "vector-links").staged_at)
        cleared(spark)
    dropped(graphs, queries)
    found = spark.read.schema("node long, other long, n long").parquet(*found)

    counts = found.groupBy("node").agg(F.sum("n").alias("_n"))
    roots = connected_components(found.filter("other is not null"), "node", "other").withColumnRenamed("node", "_node")
    named = nodes.join(roots, F.col("node") == F.col("_node"), "left").select("node", "unit", "times", "least_id", F.coalesce("root", "node").alias("root"))
    best = named.groupBy("root").agg(F.min("least_id").alias("_id"))
    named = named.join(best, "root").join(counts, "node", "left")
    named = named.select(F.col("unit").alias("_unit"), "_id", (F.coalesce("_n", F.lit(0)) + F.col("times") - 1).alias("_links"))
    out = rows.join(named, F.col("unit") == F.col("_unit"), "left")
    component = F.when(F.col("unit").isNull(), F.col("vec_id")).otherwise(F.col("_id"))
    return out.select("vec_id", F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept"))
