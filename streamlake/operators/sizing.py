"""Size checks that guard broadcasts.

A side is broadcast only if the optimizer's own estimate of its bytes (file
sizes and what the plan does to them) is below a bound; beyond it the
caller's plain join (sort-merge / shuffle-hash, AQE-managed) runs.  No job
runs for the check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_BYTES = 64 << 20


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of the size of ``df`` in bytes (an unknown
    size is huge, so an unknown side is never broadcast)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def bounded_broadcast(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast only if it is known to be small."""
    return F.broadcast(df) if plan_bytes(df) <= max_bytes else df


ROWS_PER_TASK = 500_000


def spread(df: DataFrame, *keys: str, rows: int | None = None) -> DataFrame:
    """Partition ``df`` by ``keys`` into tasks of about ``rows`` rows, for steps
    that hold a task's rows several times (an aggregate joined back to its
    input): partitions sized by their compressed bytes take many times these in
    memory, and a fixed number of them grows with the table.  Counts ``df``."""
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // (rows or ROWS_PER_TASK)))
    return df.repartition(tasks, *keys)
