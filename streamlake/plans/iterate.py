"""Iteration drivers.

Spark plans are acyclic, so an iteration is a driver loop that builds one
plan per round.  Every round's result is cut from its lineage with a
reliable ``checkpoint()`` into the shared folder named by
``spark.checkpoint.dir`` (never a local, executor-bound copy), so a lost
executor costs one round's recomputation, not the whole history, and plan
size stays constant.  The termination test is a bounded ``isEmpty()``
probe -- nothing but a boolean reaches the driver.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keys import join_keys
from ..session import ensure_checkpoint_dir


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and drop its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def iterate(initial: DataFrame, step: Callable[[DataFrame], DataFrame], rounds: int) -> DataFrame:
    """Bulk iteration with a fixed number of rounds."""
    cur = cut(initial)
    for _ in range(rounds):
        cur = cut(step(cur))
    return cur


def _rounds(limit: int | None):
    return itertools.count(1) if limit is None else range(1, limit + 1)


def iterate_with_termination(initial: DataFrame, step: Callable[[DataFrame], DataFrame],
                             criterion: Callable[[DataFrame, DataFrame], DataFrame],
                             max_rounds: int | None = None) -> tuple[DataFrame, bool]:
    """Bulk iteration that stops after the first round whose
    termination set ``criterion(prev, next)`` is empty; an explicit
    ``max_rounds`` stops it earlier.  Returns (result, finished)."""
    cur = cut(initial)
    for _ in _rounds(max_rounds):
        nxt = cut(step(cur))
        if criterion(cur, nxt).isEmpty():
            return nxt, True
        cur = nxt
    return cur, False


def delta_iterate(solution: DataFrame, workset: DataFrame, key,
                  step: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]],
                  max_rounds: int | None = None) -> tuple[DataFrame, bool]:
    """Delta iteration.  ``step(solution, workset)`` returns
    ``(delta, next_workset)``; ``delta`` rows replace the solution rows with
    the same key.  Stops when the workset is empty; an explicit
    ``max_rounds`` stops it earlier.  Returns (solution, finished).  A
    ``delta`` that is already cut may also be the next workset."""
    keys = [key] if isinstance(key, str) else list(key)
    sol, ws = cut(solution), cut(workset)
    for _ in _rounds(max_rounds):
        delta, nws = step(sol, ws)
        same = nws is delta
        delta = cut(delta)
        sol = cut(join_keys(sol, delta.select(*keys), keys, "left_anti").unionByName(delta))
        ws = delta if same else nws
        if ws.isEmpty():
            return sol, True
    return sol, False


def report(df: DataFrame, finished: bool, max_rounds: int | None) -> DataFrame:
    """With an explicit limit the result says whether it is complete."""
    return df if max_rounds is None else df.withColumn("converged", F.lit(finished))


def feedback_loop(initial: DataFrame, step: Callable[[DataFrame], DataFrame],
                  keep_iterating, max_rounds: int = 10_000) -> DataFrame:
    """U07 (re-aimed streaming feedback edge): apply ``step`` to the rows
    still iterating; rows for which ``keep_iterating`` turns false leave the
    loop and are output.  Runs until no row is left in the loop, and fails if
    some are after ``max_rounds`` -- no row is ever left out."""
    out = None
    cur = cut(initial)
    for _ in range(max_rounds):
        nxt = cut(step(cur))
        done = nxt.filter(~keep_iterating)
        out = done if out is None else out.unionByName(done)
        cur = cut(nxt.filter(keep_iterating))
        if cur.isEmpty():
            return out
    raise RuntimeError(f"rows are still in the loop after {max_rounds} rounds")


# ---------------------------------------------------------------- U07 ------
FIB_BOUND = 100


def fibonacci_steps(pairs: DataFrame, a: str = "a", b: str = "b", bound: int = FIB_BOUND) -> DataFrame:
    """From each input pair step ``(x, y) -> (y, x + y)`` until one of
    the two values reaches ``bound``; output the pair and the step count."""
    init = pairs.select(F.col(a).alias("a"), F.col(b).alias("b"), F.col(a).alias("x"),
                        F.col(b).alias("y"), F.lit(0).alias("steps"))
    step = lambda d: d.select("a", "b", F.col("y").alias("x"), (F.col("x") + F.col("y")).alias("y"),
                              (F.col("steps") + 1).alias("steps"))
    res = feedback_loop(init, step, (F.col("x") < bound) & (F.col("y") < bound))
    return res.select("a", "b", "steps")
