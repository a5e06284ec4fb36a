"""External lookups.

``async_lookup`` enriches rows with the result of a blocking lookup
function (database, service) while keeping many calls in flight: inside
each task a bounded thread pool runs up to ``capacity`` calls at once, with
a per-call timeout.  ``ordered=True`` keeps the input order of each Arrow
batch (orderedWait); ``ordered=False`` emits results as they complete
(unorderedWait).  The data stays partitioned by Spark; only the lookup is
concurrent.
"""

from __future__ import annotations

import concurrent.futures as cf
import time
from collections import deque
from collections.abc import Callable

from pyspark.sql import DataFrame


_FAIL = object()


def async_lookup(df: DataFrame, key: str, fn: Callable, out_col: str, out_type: str,
                 capacity: int = 20, timeout_s: float = 10.0, ordered: bool = True,
                 on_timeout=_FAIL) -> DataFrame:
    """Add ``out_col = fn(key)`` computed with ``capacity`` concurrent calls
    per task.  A call that takes longer than ``timeout_s`` (from its start)
    fails the query, unless a value ``on_timeout`` is given for it.  At most
    ``capacity`` calls are under way at a time, so waiting ones don't expire."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + \
        f", `{out_col}` {out_type}"
    fail = on_timeout is _FAIL
    default = None if fail else on_timeout

    def run(batches):
        def answer(call, started):
            try:
                return call.result(timeout=max(0.0, started + timeout_s - time.monotonic()))
            except cf.TimeoutError:
                if fail:
                    raise TimeoutError(f"lookup took longer than {timeout_s} s") from None
                return default

        pool = cf.ThreadPoolExecutor(max_workers=capacity)
        try:
            for pdf in batches:
                vals, order, waiting = [], [], deque()
                for i, k in enumerate(pdf[key].tolist()):
                    if len(waiting) == capacity:
                        at = 0 if ordered else next((n for n, w in enumerate(waiting) if w[1].done()), 0)
                        waiting.rotate(-at)
                        j, call, started = waiting.popleft()
                        order.append(j)
                        vals.append(answer(call, started))
                        waiting.rotate(at)
                    waiting.append((i, pool.submit(fn, k), time.monotonic()))
                for j, call, started in waiting:
                    order.append(j)
                    vals.append(answer(call, started))
                out = pdf if ordered else pdf.iloc[order].reset_index(drop=True)
                yield out.assign(**{out_col: vals})
        finally:
            pool.shutdown(wait=False, cancel_futures=True)

    return df.mapInPandas(run, schema)
