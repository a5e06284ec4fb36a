"""Whitening of embeddings by a mixed-precision eigendecomposition.

Entries become integers x = floor(scale * c) + offset, so sums and products
over the corpus are exact and agree on every run. The fit list is each distinct
x vector once. Three passes of partial sums over it give the sums S, the Gram
matrix of x minus the rounded mean (centred first, so nothing cancels) and, at
the end, the covariance of the whitened vectors; a task sends one partial
matrix, and Spark adds them entry by entry. Only matrices of dim * dim entries
reach the driver.

The eigenvectors of the covariance come from float32 arithmetic and are then
corrected by Ogita-Aishima iterations, which are a few matrix products each, in
80-bit precision: from the residuals I - X'X and X'VX a first-order correction
X + XE that converges quadratically. Where eigenvalues lie closer than the
current residual, the correction divides by noise; such a cluster is solved by
itself, as the small eigenproblem of X_J' (V - mu) X_J, and the iterations go
on from there. Equal eigenvalues keep an orthonormal basis.

Defined results: rows with a null vector, or a null or non-finite entry, are
left out; so are empty vectors, which have no component. Vectors of another
length are whitened among themselves. Repeated rows count once in the fit and
each get their rows in the result; null ids are carried. A component without
variance (all vectors equal, or fewer vectors than dimensions) has null
``whitened`` values; ``explained`` is null if nothing varies at all. Entries or
deviations beyond 64-bit integers raise an error. An empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import write_table

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
_EXACT = 1 << 53  # doubles hold integers up to here
_LONG = (1 << 63) - 1


def integers(vector: Column, scale: int = SCALE, offset: int = OFFSET) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * scale).cast("long") + F.lit(offset).cast("long"))


def usable(vector: Column) -> Column:
    """Neither null nor empty, all entries finite."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, finite), F.lit(False))


def _blocks(batch: pa.RecordBatch, column: str = "x") -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per length in the batch: the rows and their vectors."""
    lists = batch.column(column)
    if not len(lists):
        return
    offsets = lists.offsets.to_numpy()
    values = lists.values.to_numpy(zero_copy_only=False)
    length = np.diff(offsets)
    for d in np.unique(length):
        rows = np.flatnonzero(length == d)
        yield rows, values[offsets[rows][:, None] + np.arange(d)]


def gram(a: np.ndarray) -> np.ndarray:
    """The exact a' * a of an integer matrix."""
    top = int(np.abs(a).max(initial=0))
    if top * top * max(len(a), 1) < _EXACT:
        f = a.astype(np.float64)
        return (f.T @ f).astype(np.int64)
    if top * top * len(a) <= _LONG:
        return a.T @ a
    raise OverflowError("the products of these entries do not fit 64-bit integers")


def _added(fit: DataFrame, partial: Callable[[np.ndarray], np.ndarray], kind: str) -> dict[int, np.ndarray]:
    """Per vector length the sum over ``fit`` (x) of ``partial`` of a block,
    as an object array; ``kind`` is the type of its entries."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}

        def sent(d: int) -> pa.RecordBatch:
            p = held.pop(d)
            return pa.RecordBatch.from_arrays([pa.array(np.full(p.size, d, np.int32)),
                                               pa.array(np.arange(p.size)), pa.array(p.ravel())], ["dim", "at", "part"])

        for batch in batches:
            for _, a in _blocks(batch):
                d, p = a.shape[1], partial(a)
                if d in held and kind == "long" and (np.abs(held[d].astype(float)) + np.abs(p.astype(float))).max() > 2e18:
                    yield sent(d)
                held[d] = held[d] + p if d in held else p
        for d in list(held):
            yield sent(d)

    total = F.sum(F.col("part").cast("decimal(38,0)")) if kind == "long" else F.sum("part")
    parts = (fit.select("x").mapInArrow(sums, f"dim int, at long, part {kind}")
             .groupBy("dim", "at").agg(total.cast("string" if kind == "long" else "double").alias("sum")).toArrow())
    out: dict[int, np.ndarray] = {}
    read = int if kind == "long" else float
    for d in set(parts.column("dim").to_pylist()):
        own = parts.filter(pc.equal(parts.column("dim"), d))
        flat = np.zeros(own.num_rows, object)
        flat[own.column("at").to_numpy()] = [read(s) for s in own.column("sum").to_pylist()]
        out[d] = flat
    return out


def eigenvectors(v: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and unit eigenvectors (columns) of a symmetric
    matrix, to double precision: float32 start, refinement in 80 bits."""
    d = len(v)
    size = float(np.abs(v).max(initial=0))
    if not size:
        return np.zeros(d), np.eye(d)
    a = v.astype(np.longdouble) / np.longdouble(size)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    eye, best = np.eye(d, dtype=np.longdouble), np.inf
    for _ in range(rounds):
        r, s = eye - x.T @ x, x.T @ (a @ x)
        s = (s + s.T) / 2
        value = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(value)
        noise = 2 * (np.sqrt((off * off).sum()) + np.sqrt((r * r).sum()) * np.abs(value).max())
        order = np.argsort(-value)
        x, value, r, s = x[:, order], value[order], r[np.ix_(order, order)], s[np.ix_(order, order)]
        apart = value[None, :] - value[:, None]
        clear = np.abs(apart) > noise
        e = np.where(clear, (s + value[None, :] * r) / np.where(clear, apart, 1), r / 2)
        change = float(np.abs(e).max())
        x = x + x @ e
        # what lies within the residual of its neighbours is solved by itself
        start = 0
        for k in range(1, d + 1):
            if k < d and value[k - 1] - value[k] <= noise:
                continue
            if k - start > 1:
                j = x[:, start:k]
                mu = value[start:k].mean()
                small = j.T @ (a @ j - mu * j)
                small = (small + small.T) / 2
                top = np.abs(small).max()
                if top > 0:
                    turn = np.linalg.eigh((small / top).astype(np.float64))[1][:, ::-1].astype(np.longdouble)
                    x[:, start:k] = j @ turn
            start = k
        if change < 1e-17 or change >= best / 2 and change < 1e-12:  # the rounding of 80 bits is reached
            break
        best = min(best, change)
    value = np.einsum("ij,ij->j", x, a @ x) / np.einsum("ij,ij->j", x, x)
    order = np.argsort(-value, kind="stable")
    x, value = x[:, order] / np.sqrt((x * x).sum(axis=0))[order], value[order] * np.longdouble(size)
    sign = np.where(x[np.abs(x).argmax(axis=0), np.arange(d)] < 0, -1, 1)
    return value.astype(np.float64), (x * sign).astype(np.float64)


@dataclass
class Model:
    """Whitening of vectors of one length."""

    n: int
    shift: np.ndarray  # floor of the mean, 64-bit integers
    rest: np.ndarray  # n * mean - n * shift, in [0, n)
    values: np.ndarray  # eigenvalues, falling, as many as components
    vectors: np.ndarray  # a column per component
    trace: float
    varies: np.ndarray  # per component: its eigenvalue is not zero
    identity_error: float = 0.0

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Per row and component; nan where the component has no variance."""
        scale = np.where(self.varies, np.sqrt(np.where(self.varies, self.values, 1)), np.nan)
        return ((x - self.shift).astype(np.float64) - self.rest / self.n) @ (self.vectors / scale)

    def deviation(self, x: np.ndarray) -> np.ndarray:
        """Per row the exact sum of (n * x - S) ** 2."""
        c = x - self.shift
        if (int(np.abs(c).max(initial=0)) + 1) ** 2 * self.n ** 2 * x.shape[1] <= _LONG:
            return ((self.n * c - self.rest) ** 2).sum(axis=1)
        wide = self.n * c.astype(object) - self.rest.astype(object)
        out = (wide * wide).sum(axis=1)
        if max(out) > _LONG:
            raise OverflowError("a deviation does not fit a 64-bit integer")
        return out.astype(np.int64)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Model]:
    """The models of ``vectors`` (x: array<long>, none null), by length."""
    distinct = write_table(vectors.select("x").distinct(), "whiten-fit")
    counts = {r["dim"]: r["n"] for r in
              distinct.groupBy(F.size("x").alias("dim")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return {}
    sums = _added(distinct, lambda a: a.sum(axis=0), "long")
    shift = {d: np.array([int(s) // counts[d] for s in sums[d]], np.int64) for d in counts}
    products = _added(distinct, lambda a: gram(a - shift[a.shape[1]]), "long")
    models = {}
    for d, n in counts.items():
        rest = [int(s) - n * int(m) for s, m in zip(sums[d], shift[d])]
        g = products[d].reshape(d, d)
        # the integers' quotient is the correctly rounded entry of the covariance
        v = np.array([[(n * g[i, j] - rest[i] * rest[j]) / (n * n) for j in range(d)] for i in range(d)])
        values, x = eigenvectors(v)
        k = min(components, d)
        models[d] = Model(n, shift[d], np.array(rest, np.int64), values[:k], x[:, :k], float(np.trace(v)),
                          values[:k] > 8 * d * np.finfo(float).eps * max(values[0], 0))

    def second(a: np.ndarray) -> np.ndarray:
        w = models[a.shape[1]].whitened(a)[:, models[a.shape[1]].varies]
        one = np.column_stack([np.ones(len(w)), w])
        return one.T @ one

    for d, flat in _added(distinct, second, "double").items():
        k = int(models[d].varies.sum())
        m = flat.astype(float).reshape(k + 1, k + 1) / counts[d]
        error = np.abs(m[1:, 1:] - np.outer(m[0, 1:], m[0, 1:]) - np.eye(k)).max(initial=0)
        models[d].identity_error = float(error)
    return models


def transform(rows: DataFrame, models: dict[int, Model]) -> DataFrame:
    """``rows`` (id, x): one row per row and component: ``id, component, n,
    deviation, whitened, explained, identity_error``."""
    def rated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, a in _blocks(batch):
                m = models[a.shape[1]]
                k = len(m.values)
                w = m.whitened(a)
                share = m.values / m.trace if m.trace > 0 else np.full(k, np.nan)
                per_row = lambda column: np.repeat(column, k)
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").take(pa.array(per_row(at))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                    pa.array(np.full(len(at) * k, m.n)), pa.array(per_row(m.deviation(a))),
                    pa.array(w.ravel(), from_pandas=True), pa.array(np.tile(share, len(at)), from_pandas=True),
                    pa.array(np.full(len(at) * k, m.identity_error))],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "x").mapInArrow(
        rated, f"id {kind}, component int, n long, deviation long, whitened double, explained double, "
               "identity_error double")


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id",
           vector_col: str = "embedding", scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """One row per usable row and component: id, ``component`` (from 1, by
    falling eigenvalue), ``n``, ``deviation``, ``whitened``, ``explained``,
    ``identity_error`` (of the fit, measured on the whitened fit list)."""
    rows = (vectors.filter(usable(F.col(vector_col)))
            .select(F.col(id_col).alias("id"), integers(F.col(vector_col), scale, offset).alias("x")))
    return transform(rows, fit(rows, components)).withColumnRenamed("id", id_col)
