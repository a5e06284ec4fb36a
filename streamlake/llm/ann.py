"""Approximate nearest neighbours with robust-pruned directed graphs.

Vectors are dealt to shards of about ``shard_rows`` by a hash. Each shard's
task builds a graph: greedy beam searches over the growing graph propose a
node's neighbours, and relaxed distance pruning keeps those that no closer
kept neighbour covers (an edge to c goes if a kept p has alpha * d(p, c) <=
d(node, c)), so edges stay diverse. Searches run in lockstep for a batch of
nodes with numpy. Queries search every shard with a beam, in blocks, and the
shards' finds are merged; distances are computed again in double precision on
the original vectors.

Equal vectors of a shard are one node that lists all its ids; a search needs
only the smallest ones. Every vector is indexed; only the answer's top k is
a limit.

Defined results: vectors that are null, zero, or hold null or non-finite
components take no part; vectors of different length are never neighbours;
rows that repeat id and vector count once; ties go to the smaller id; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import write_table

DEGREE, BEAM, ALPHA, ENTRIES = 24, 48, 1.2, 16
BATCH = 128


def beam_search(x: np.ndarray, graph: np.ndarray, entries: np.ndarray, q: np.ndarray, width: int,
                own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Lockstep greedy search of all rows of ``q``. Returns the beam (node
    ids, -1 where empty; squared distances) and each query's visited nodes.
    ``own`` are nodes that their own query must not return."""
    m = len(q)
    seen = np.zeros((m, len(x) + 1), bool)
    seen[:, -1] = True  # stands for missing edges (-1)
    if own is not None:
        seen[np.arange(m), own] = True
    norm = (x * x).sum(axis=1)
    ids, dist = np.full((m, width), -1), np.full((m, width), np.inf, np.float32)
    open_ = np.zeros((m, width), bool)
    visited: list[list[np.ndarray]] = [[], []]
    active, fresh = np.arange(m), np.broadcast_to(entries, (m, len(entries)))
    while len(active):
        fresh = np.where(seen[active[:, None], fresh], -1, fresh)
        seen[active[:, None], fresh] = True
        near = x[fresh]
        d = norm[fresh] - 2 * np.einsum("qrd,qd->qr", near, q[active])
        d[fresh < 0] = np.inf
        all_ids = np.concatenate([ids[active], fresh], axis=1)
        all_d = np.concatenate([dist[active], d], axis=1)
        all_open = np.concatenate([open_[active], np.isfinite(d)], axis=1)
        order = np.argsort(all_d, axis=1, kind="stable")[:, :width]
        ids[active] = np.take_along_axis(all_ids, order, 1)
        dist[active] = np.take_along_axis(all_d, order, 1)
        open_[active] = np.take_along_axis(all_open, order, 1)
        active = active[open_[active].any(axis=1)]
        if len(active):
            at = open_[active].argmax(axis=1)
            open_[active, at] = False
            node = ids[active, at]
            visited[0].append(active)
            visited[1].append(node)
            fresh = graph[node]
    who = np.concatenate(visited[0]) if visited[0] else np.zeros(0, int)
    what = np.concatenate(visited[1]) if visited[1] else np.zeros(0, int)
    order = np.argsort(who, kind="stable")
    return ids, dist, np.split(what[order], np.searchsorted(who[order], np.arange(1, m)))


def robust_prune(x: np.ndarray, node: int, pool: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Diverse neighbours of ``node`` out of ``pool``."""
    pool = np.unique(pool[(pool >= 0) & (pool != node)])
    if not len(pool):
        return pool
    p = x[pool]
    to_node = ((p - x[node]) ** 2).sum(axis=1)
    order = np.argsort(to_node, kind="stable")[:4 * degree]
    pool, p, to_node = pool[order], p[order], to_node[order]
    norm = (p * p).sum(axis=1)
    between = norm[:, None] + norm[None] - 2 * p @ p.T
    left, kept = np.ones(len(pool), bool), []
    while left.any() and len(kept) < degree:
        k = int(left.argmax())  # the closest that is left
        kept.append(k)
        left &= alpha * alpha * between[k] > to_node
        left[k] = False
    return pool[kept]


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA) -> np.ndarray:
    """Neighbour lists (-1 where there is none) of the rows of ``x`` (distinct).
    A list is pruned to ``degree`` and may grow by half of that through edges
    back to it before it is pruned again."""
    n, most = len(x), degree + degree // 2
    rng = np.random.default_rng(n)
    graph = np.full((n, most), -1)
    if n <= degree + 1:
        for k in range(n):
            graph[k, :n - 1] = np.delete(np.arange(n), k)
        return graph
    graph[:, :degree] = rng.integers(0, n, (n, degree))
    entries = entry_points(n)
    for relax in (1.0, alpha):  # a coarse graph, then the one that stays
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            nodes = order[at:at + BATCH]
            ids, _, visited = beam_search(x, graph, entries, x[nodes], beam if relax > 1 else beam // 2, nodes)
            back: dict[int, list[int]] = {}
            for node, near, passed in zip(nodes, ids, visited):
                kept = robust_prune(x, node, np.concatenate([near, passed, graph[node]]), degree, relax)
                graph[node] = -1
                graph[node, :len(kept)] = kept
                for k in kept:
                    back.setdefault(int(k), []).append(int(node))
            for k, new in back.items():
                have = graph[k][graph[k] >= 0]
                more = np.setdiff1d(new, have)
                if len(have) + len(more) > most:
                    kept = robust_prune(x, k, np.concatenate([have, more]), degree, relax)
                else:
                    kept = np.concatenate([have, more])
                graph[k] = -1
                graph[k, :len(kept)] = kept
    return graph


def entry_points(n: int) -> np.ndarray:
    return np.unique(np.linspace(0, n - 1, ENTRIES).astype(int))


def _valid(vector: Column) -> Column:
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    return vector.isNotNull() & finite & F.exists(vector, lambda v: v != 0)


def vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, v`` (array of doubles) of the rows that take part."""
    v = F.col(vector_col)
    return (table.filter(F.col(id_col).isNotNull() & _valid(v))
            .select(F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("v")).distinct())


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy().reshape(len(flat), -1) if len(flat) else np.zeros((0, 0))


def build_index(points: DataFrame, shards: int, degree: int = DEGREE, beam: int = BEAM,
                alpha: float = ALPHA) -> DataFrame:
    """One row per shard and vector length: ``dim, shard, n, vectors, graph,
    ids, starts`` (node k's ids, ascending, are ids[starts[k]:starts[k + 1]])."""
    def graph(table: pa.Table) -> pa.Table:
        ids, x = table.column("id").to_numpy(), _matrix(table.column("v"))
        order = np.argsort(ids, kind="stable")
        distinct, node = np.unique(x[order], axis=0, return_inverse=True)
        node = node.ravel()
        mixed = np.random.default_rng(0).permutation(len(distinct))  # entry points then lie anywhere
        place = np.empty(len(mixed), int)
        place[mixed] = np.arange(len(mixed))
        by_node = np.argsort(place[node], kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(place[node], minlength=len(distinct)))])
        x = distinct[mixed]
        edges = build(x.astype(np.float32), degree, beam, alpha)
        return pa.table({"dim": table.column("dim")[:1], "shard": table.column("shard")[:1],
                         "n": pa.array([len(x)], pa.int64()),
                         "vectors": pa.array([x.astype("<f8").tobytes()], pa.binary()),
                         "graph": pa.array([edges.astype("<i4").tobytes()], pa.binary()),
                         "ids": pa.array([ids[order][by_node].astype("<i8").tobytes()], pa.binary()),
                         "starts": pa.array([starts.astype("<i8").tobytes()], pa.binary())})

    dealt = points.select("id", "v", F.size("v").alias("dim"),
                          F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"))
    return write_table(dealt.groupBy("dim", "shard").applyInArrow(
        graph, "dim int, shard int, n long, vectors binary, graph binary, ids binary, starts binary"), "ann-index")


def search(index: DataFrame, queries: DataFrame, k: int = 10, width: int = 96,
           block_rows: int = 1024) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every row
    of ``queries`` (id, v), itself excluded."""
    blocks = max(1, -(-queries.count() // block_rows))
    asked = queries.withColumn("dim", F.size("v")).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    places = index.select(F.col("dim").alias("dim"), (F.col("shard") + 0).alias("shard"))
    asked = asked.join(places, "dim")  # each block to each shard of its length
    held = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def beam(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if left.num_rows and right.num_rows:
            row = left.slice(0, 1).to_pylist()[0]
            x = np.frombuffer(row["vectors"], "<f8").reshape(row["n"], -1)
            edges = np.frombuffer(row["graph"], "<i4").reshape(row["n"], -1)
            ids, starts = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["starts"], "<i8")
            asked_ids, q = right.column("id").to_numpy(), _matrix(right.column("v"))
            small = x.astype(np.float32)
            for at in range(0, len(q), BATCH):
                found, _, _ = beam_search(small, edges, entry_points(len(x)),
                                          q[at:at + BATCH].astype(np.float32), width)
                for query, vector, nodes in zip(asked_ids[at:at + BATCH], q[at:at + BATCH], found):
                    nodes = nodes[nodes >= 0]
                    score = np.sqrt(((x[nodes] - vector) ** 2).sum(axis=1))
                    # a node's smallest k + 1 ids are all that a top k without the query itself can hold
                    take = np.minimum(starts[nodes + 1] - starts[nodes], k + 1)
                    near = np.concatenate([ids[starts[v]:starts[v] + t] for v, t in zip(nodes, take)])
                    score = np.repeat(score, take)[near != query]
                    near = near[near != query]
                    best = np.lexsort((near, score))[:k]
                    out.append((np.full(len(best), query), near[best], score[best]))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()),
                         "score": pa.array(columns[2], pa.float64())})

    keys = ("dim", "shard", "block")
    found = (held.groupBy(*keys).cogroup(asked.groupBy(*keys))
             .applyInArrow(beam, "query_id long, vec_id long, score double"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def nearest(table: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
            shard_rows: int = 4096, width: int = 96) -> DataFrame:
    """Index every vector of ``table`` and search the rows where ``is_query`` holds."""
    points = write_table(vectors(table, id_col, vector_col), "ann-points")
    index = build_index(points, max(1, -(-points.count() // shard_rows)))
    asked = table.filter(is_query)
    return search(index, vectors(asked, id_col, vector_col), k, width)
