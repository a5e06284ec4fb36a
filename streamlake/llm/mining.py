"""Hard negatives by bounds along anchor spanning trees.

Components become integers floor(scale * x), so scores are exact inner
products. Rows and anchors are dealt to a grid of cells: a cell holds one group
of rows and one group of anchors, both bounded, and every pair of groups meets
once. In a cell the anchors are cut into blocks of near ones, and a minimum
spanning tree joins each block. With the scores of a tree's root at hand, a
child's score against a row lies within

    score at the parent +- length of the edge * norm of the row,

level by level; only rows whose interval reaches the anchor's window are scored
again, and the exact score then starts the bounds below. Two passes use this:

1. positives: the window is what the k-th best row of the same label so far
   leaves open;
2. negatives: rows of other labels, in ``low`` to ``high`` per cent of a
   positive's score and not below the k-th best found so far for it.

Each cell sends its best rows per anchor (and positive), and a ranking per
anchor over the cells' bests gives the result. Nothing is approximate.

Defined results: rows with a null label, a null vector or any null or
non-finite component take no part; vectors of another length are never
compared; rows that repeat an id are rows of their own (each may be an anchor,
and another row of the anchor's own id may be its positive); a null id is no
anchor and follows all others in ties, then rows tie by position; a positive
without a fitting negative has no rows; scores beyond 64-bit integers raise an
error; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import write_table
from .whitening import usable

BLOCK = 256  # anchors of a tree
STEP = 8192  # rows that go through a tree at a time
CELL_VALUES = 1 << 24  # components of a cell's rows at most, 128 MB in doubles
LEAST_ROWS = 4096  # smaller cells are not worth a task
SPREAD = 32  # cells that rows are spread over at least, where they are enough


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``q`` as bytes of the shortest integers that hold its components."""
    for batch in batches:
        lists = batch.column("q")
        offsets = lists.offsets.to_numpy()
        values = lists.values.to_numpy(zero_copy_only=False)
        out, width = [], np.zeros(batch.num_rows, np.int32)
        for k in range(batch.num_rows):
            v = values[offsets[k]:offsets[k + 1]]
            top = max(int(v.max(initial=0)), -int(v.min(initial=0)) - 1)
            width[k] = 2 if top < 1 << 15 else 4 if top < 1 << 31 else 8
            out.append(v.astype(f"<i{width[k]}").tobytes())
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "label", "anchor")),
                                          pa.array(np.diff(offsets).astype(np.int32)), pa.array(width),
                                          pa.array(out, pa.binary())], ["id", "label", "anchor", "dim", "width", "q"])


def _matrix(table: pa.Table, dim: int) -> np.ndarray:
    out = np.zeros((table.num_rows, dim), np.int64)
    width = table.column("width").to_numpy()
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        joined = b"".join(table.column("q").take(pa.array(rows)).to_pylist())
        out[rows] = np.frombuffer(joined, f"<i{w}").reshape(len(rows), dim)
    return out


def near_blocks(points: np.ndarray, size: int = BLOCK) -> Iterator[np.ndarray]:
    """The points cut at the median of their widest coordinate until blocks hold ``size``."""
    todo = [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        if len(rows) <= size or not points.shape[1]:
            for k in range(0, len(rows), size):
                yield rows[k:k + size]
            continue
        own = points[rows]
        axis = int(own.std(axis=0).argmax())
        rows = rows[np.argsort(own[:, axis], kind="stable")]
        todo += [rows[len(rows) // 2:], rows[:len(rows) // 2]]


def spanning_tree(points: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Minimum spanning tree: nodes by level (the root, nearest to the mean,
    first), each node's parent and the length of the edge to it."""
    m = len(points)
    f = points.astype(np.float64)
    root = int(((f - f.mean(axis=0)) ** 2).sum(axis=1).argmin())
    parent, length, depth = np.full(m, root), np.full(m, np.inf), np.zeros(m, int)
    inside = np.zeros(m, bool)
    at = root
    for _ in range(m):
        inside[at] = True
        if at != root:
            depth[at] = depth[parent[at]] + 1
        d = np.sqrt(((f - f[at]) ** 2).sum(axis=1))
        closer = ~inside & (d < length)
        length[closer], parent[closer] = d[closer], at
        at = int(np.where(inside, np.inf, length).argmin())
    length[root] = 0
    return [np.flatnonzero(depth == k) for k in range(depth.max(initial=0) + 1)], parent, length


def scored(anchors: np.ndarray, tree: tuple, rows: np.ndarray, norms: np.ndarray,
           open_to: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple]:
    """Level by level: the nodes, which rows of theirs were scored, and the
    scores. ``open_to(nodes, low, high)`` says which intervals need a score."""
    levels, parent, length = tree
    low, high = (np.zeros((len(anchors), len(rows)), norms.dtype) for _ in range(2))
    for depth, nodes in enumerate(levels):
        if depth:
            reach = length[nodes][:, None] * norms * (1 + 1e-9) + 1e-3  # more than the rounding of doubles
            need = open_to(nodes, low[parent[nodes]] - reach, high[parent[nodes]] + reach)
            if 4 * need.sum() < need.size:
                low[nodes], high[nodes] = low[parent[nodes]] - reach, high[parent[nodes]] + reach
                i, j = np.nonzero(need)
                for k in range(0, len(i), 1 << 16):
                    a, b = i[k:k + (1 << 16)], j[k:k + (1 << 16)]
                    s = np.einsum("ij,ij->i", anchors[nodes[a]], rows[b])
                    low[nodes[a], b] = high[nodes[a], b] = s
                yield nodes, need, low[nodes]
                continue
        else:
            need = np.ones((len(nodes), len(rows)), bool)
        low[nodes] = high[nodes] = anchors[nodes] @ rows.T
        yield nodes, need, low[nodes]


class _Cell:
    """The rows of a cell in the order of ties, and its anchors in near blocks."""

    def __init__(self, rows: pa.Table, anchors: pa.Table, dim: int):
        missing = rows.column("id").is_null().to_numpy()
        ids = rows.column("id").fill_null(0).to_numpy()
        # by label, then in the order in which ties are settled
        rows = rows.take(pa.array(np.lexsort((rows.column("uid").to_numpy(), ids, missing, rows.column("label").to_numpy()))))
        self.uid, self.label = rows.column("uid").to_numpy(), rows.column("label").to_numpy()
        self.id = rows.column("id")
        missing, ids = self.id.is_null().to_numpy(), self.id.fill_null(0).to_numpy()
        self.tie = np.empty(len(ids), np.int64)
        self.tie[np.lexsort((self.uid, ids, missing))] = np.arange(len(ids))
        q, a = _matrix(rows, dim), _matrix(anchors, dim)
        bound = int(np.abs(q).max(initial=0)) * int(np.abs(a).max(initial=0)) * dim
        if 100 * bound >= 1 << 63:
            raise OverflowError("scores of these vectors do not fit 64-bit integers")
        # scores are held exactly: in doubles where they fit, else in 80 bits
        exact, self.real = (np.float64, np.float64) if bound < 1 << 53 else (np.int64, np.longdouble)
        self.q = q.astype(exact)
        self.norms = np.sqrt((q.astype(self.real) ** 2).sum(axis=1))
        self.anchors, self.a = anchors, a.astype(exact)

    def blocks(self) -> Iterator[tuple[np.ndarray, tuple]]:
        """Anchors of one label and their tree."""
        label = self.anchors.column("label").to_numpy()
        for one in np.unique(label):
            own = np.flatnonzero(label == one)
            for block in near_blocks(self.a[own].astype(np.float64)):
                yield own[block], spanning_tree(self.a[own[block]])

    def steps(self, first: int, end: int) -> Iterator[slice]:
        for k in range(first, end, STEP):
            yield slice(k, min(end, k + STEP))

    def best(self, rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        if len(rows) > 4 * k:  # the k largest and all that tie with the last of them
            edge = np.partition(scores, len(scores) - k)[len(scores) - k]
            rows, scores = rows[scores >= edge], scores[scores >= edge]
        order = np.lexsort((self.tie[rows], -scores))[:k]
        return rows[order], scores[order]


def _positives(cell: _Cell, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Anchor, and its best rows of its own label in the cell with their scores."""
    label, uid = cell.anchors.column("label").to_numpy(), cell.anchors.column("uid").to_numpy()
    for block, tree in cell.blocks():
        held = [(np.zeros(0, int), np.zeros(0, cell.real)) for _ in block]
        least = np.full(len(block), -np.inf, cell.real)
        first, end = np.searchsorted(cell.label, [label[block[0]], label[block[0]] + 1])
        for part in cell.steps(first, end):
            for nodes, need, scores in scored(cell.a[block], tree, cell.q[part], cell.norms[part],
                                              lambda nodes, low, high: high >= least[nodes][:, None]):
                for n, take, s in zip(nodes, need, scores):
                    new = np.flatnonzero(take & (s >= least[n]))
                    new = new[cell.uid[part.start + new] != uid[block[n]]]
                    if len(new):
                        rows, best = cell.best(np.concatenate([held[n][0], part.start + new]),
                                               np.concatenate([held[n][1], s[new]]), k)
                        held[n] = rows, best
                        if len(rows) == k:
                            least[n] = best[-1]
        yield from ((int(a), *h) for a, h in zip(block, held))


def _negatives(cell: _Cell, k: int, low: int, high: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Anchor, number of its positive, and the best fitting rows in the cell."""
    label = cell.anchors.column("label").to_numpy()
    positives = cell.anchors.column("positives").to_pylist()
    for block, tree in cell.blocks():
        width = max(len(positives[a]) for a in block)
        # as integers: the least and the greatest score that fits; an empty window for a missing positive
        least, most = (np.full((len(block), width), edge, cell.real) for edge in (np.inf, -np.inf))
        for n, a in enumerate(block):
            for p, x in enumerate(positives[a]):
                least[n, p], most[n, p] = -(-low * x["score"] // 100), high * x["score"] // 100
        held = {}

        def fits(nodes: np.ndarray, lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
            out = np.zeros(lower.shape, bool)
            for p in range(width):
                out |= (upper >= least[nodes, p][:, None]) & (lower <= most[nodes, p][:, None])
            return out

        first, end = np.searchsorted(cell.label, [label[block[0]], label[block[0]] + 1])
        for part in (*cell.steps(0, first), *cell.steps(end, len(cell.uid))):
            for nodes, need, scores in scored(cell.a[block], tree, cell.q[part], cell.norms[part], fits):
                for n, take, s in zip(nodes, need, scores):
                    for p in range(len(positives[block[n]])):
                        new = np.flatnonzero(take & (s >= least[n, p]) & (s <= most[n, p]))
                        if len(new):
                            old = held.get((n, p), (np.zeros(0, int), np.zeros(0, cell.real)))
                            rows, best = cell.best(np.concatenate([old[0], part.start + new]),
                                                   np.concatenate([old[1], s[new]]), k)
                            held[n, p] = rows, best
                            if len(rows) == k:
                                least[n, p] = max(least[n, p], best[-1])
        yield from ((int(block[n]), p, *h) for (n, p), h in held.items())


def _met(rows: DataFrame, anchors: DataFrame, grid: tuple[int, int], found: Callable, schema: str) -> DataFrame:
    """``found(cell)`` for every cell of the grid; its rows follow ``schema``."""
    across, down = grid
    g = F.pmod(F.xxhash64(F.lit("row"), "uid"), F.lit(across)).cast("int")
    h = F.pmod(F.xxhash64(F.lit("anchor"), "uid"), F.lit(down)).cast("int")
    left = rows.withColumns({"g": g, "h": F.explode(F.sequence(F.lit(0), F.lit(down - 1)))})
    right = anchors.withColumns({"h": h, "g": F.explode(F.sequence(F.lit(0), F.lit(across - 1)))})
    tasks = 3 * across * down  # cells are hashed to tasks
    names = ["dim", "g", "h"]

    def one(key: tuple, rows: pa.Table, anchors: pa.Table) -> pa.Table:
        kind = _schema(schema)
        if not rows.num_rows or not anchors.num_rows:
            return kind.empty_table()
        cell = _Cell(rows, anchors, key[0].as_py())
        return pa.Table.from_batches(list(found(cell)) or [], schema=kind)

    return (left.repartition(tasks, *names).groupBy(*names)
            .cogroup(right.repartition(tasks, *names).groupBy(*names)).applyInArrow(one, schema))


def _schema(fields: str) -> pa.Schema:
    types = {"long": pa.int64(), "int": pa.int32()}
    return pa.schema([(name, types[kind]) for name, kind in (f.split() for f in fields.split(", "))])


def mine(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         scale: int = 256, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
         cell_rows: int | None = None, cell_anchors: int = 65536) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score`` for the rows for which ``anchor`` holds. ``cell_rows``
    sets the grid (by default from the number of rows; results are the same)."""
    whole = (F.col(vector_col).isNotNull() & ((F.size(vector_col) == 0) | usable(F.col(vector_col))))
    rows = vectors.filter(F.col(label_col).isNotNull() & F.coalesce(whole, F.lit(False))).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
        (F.coalesce(anchor, F.lit(False)) & F.col(id_col).isNotNull()).alias("anchor"),
        F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("q"))
    rows = write_table(rows.mapInArrow(_packed, "id long, label long, anchor boolean, dim int, width int, q binary")
                       .withColumn("uid", F.monotonically_increasing_id()), "mine-rows")
    total, asked, dim = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("anchor"), 1)),
                                 F.coalesce(F.max("dim"), F.lit(1))).first()
    cell_rows = cell_rows or max(min(max(total // SPREAD, LEAST_ROWS), CELL_VALUES // max(dim, 1)), 1)
    grid = -(-max(total, 1) // cell_rows), -(-max(asked, 1) // cell_anchors)
    own = rows.select("dim", "uid", "id", "label", "width", "q")
    anchors = rows.filter("anchor").select(own.columns)

    def first(cell: _Cell) -> Iterator[pa.RecordBatch]:
        uid = cell.anchors.column("uid").to_numpy()
        for a, found, scores in _positives(cell, positives):
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(found), uid[a])), pa.array(cell.uid[found]),
                cell.id.take(pa.array(found)).combine_chunks(), pa.array(scores.astype(np.int64))],
                schema=_schema(best_of))

    best_of = "anchor long, uid long, id long, score long"
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("uid")]
    near = (_met(own, anchors, grid, first, best_of)
            .withColumn("k", F.row_number().over(Window.partitionBy("anchor").orderBy(*order))).filter(f"k <= {positives}"))
    # at most ``positives`` entries for each anchor
    lists = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("k", "id", "score"))).alias("positives"))
    asked_rows = write_table(anchors.join(lists, F.col("uid") == F.col("anchor")).drop("anchor"), "mine-positives")

    def second(cell: _Cell) -> Iterator[pa.RecordBatch]:
        uid = cell.anchors.column("uid").to_numpy()
        for a, p, found, scores in _negatives(cell, negatives, low, high):
            n = len(found)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(n, uid[a])), pa.array(np.full(n, p, np.int32)), pa.array(cell.uid[found]),
                cell.id.take(pa.array(found)).combine_chunks(), pa.array(scores.astype(np.int64))],
                schema=_schema(fitting))

    fitting = "anchor long, p int, uid long, id long, score long"
    ranked = (_met(own, asked_rows, grid, second, fitting)
              .withColumn("rank", F.row_number().over(Window.partitionBy("anchor", "p").orderBy(*order)))
              .filter(f"rank <= {negatives}"))
    names = asked_rows.select(F.col("uid").alias("_anchor"), F.col("id").alias("anchor_id"), "positives")
    return ranked.join(names, F.col("anchor") == F.col("_anchor")).select(
        "anchor_id", F.col("positives")[F.col("p")]["id"].alias("positive_id"), "rank",
        F.col("id").alias("negative_id"), F.col("positives")[F.col("p")]["score"].alias("positive_score"),
        F.col("score").alias("negative_score"))
