"""Keyed stateful operators, batch forms.

Two execution shapes:

* ``state_machine_alerts`` (U05): the per-key fold is over a *finite* state
  set, so each block of a key's rows is summarised by its transition
  function (start state -> end state).  Blocks are bounded (``block_rows``),
  functions of consecutive blocks compose associatively, and only the tiny
  per-block table is scanned per key.  A hot key is split into many
  blocks processed in parallel.

* ``keyed_scan`` (U01, T15, T25): folds whose state is not finite.  Rows
  are hash-partitioned by key and sorted inside each partition (an external,
  spillable sort); ``mapInPandas`` then streams the Arrow batches with
  O(1) state per key.  No key's rows are ever held in memory at once.

The streaming forms of the same logic are in ``streamlake.streaming``; both
share the step functions defined here.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keys import join_keys
from .running import order_bucket, running

# ----------------------------------------------------------------- U05 -----
# The state machine's transition table (state, event) -> state.
# Any other (state, event) pair is an invalid transition; reaching Terminal
# clears the key's state (the next event starts again from Initial).
TRANSITIONS = {
    ("Initial", "a"): "W",
    ("Initial", "c"): "X",
    ("W", "b"): "Y",
    ("X", "b"): "Y",
    ("X", "d"): "Z",
    ("Y", "e"): "Z",
    ("Z", "g"): "Terminal",
}
STORED_STATES = ["Initial", "W", "X", "Y", "Z"]
EVENT_TYPES = ["a", "b", "c", "d", "e", "f", "g"]

_SIDX = {s: i for i, s in enumerate(STORED_STATES)}
# NEXT[state][event] -> stored state index after the event; VALID likewise
# (one extra column for unknown event letters: always invalid)
NEXT = [[0] * (len(EVENT_TYPES) + 1) for _ in STORED_STATES]
VALID = [[False] * (len(EVENT_TYPES) + 1) for _ in STORED_STATES]
for _s in STORED_STATES:
    for _j, _e in enumerate(EVENT_TYPES):
        _t = TRANSITIONS.get((_s, _e))
        VALID[_SIDX[_s]][_j] = _t is not None
        NEXT[_SIDX[_s]][_j] = _SIDX[_s] if _t is None else (0 if _t == "Terminal" else _SIDX[_t])
    NEXT[_SIDX[_s]][len(EVENT_TYPES)] = _SIDX[_s]
_EIDX = {e: j for j, e in enumerate(EVENT_TYPES)}
_UNKNOWN = len(EVENT_TYPES)


def state_machine_step(state: str | None, event: str) -> tuple[str | None, bool]:
    """One event: returns (new stored state or None when cleared, is_alert)."""
    s = state or "Initial"
    t = TRANSITIONS.get((s, event))
    if t is None:
        return state, True
    return (None if t == "Terminal" else t), False


def state_machine_alerts(df: DataFrame, key: str, order, event: str, row_id: str,
                         block_rows: int = 200_000, bucket_seconds: float | None = None,
                         ts: str = "ts") -> DataFrame:
    """Alerts (key, row_id, state, event) for every invalid transition
    in each key's event sequence (ordered by ``order``)."""
    order = [order] if isinstance(order, str) else list(order)
    d = df.select(key, row_id, event, *[c for c in order if c not in (row_id,)])
    d = running(d, [key], order, F.lit(1).cast("long"), "sum", "_rn",
                order_bucket(df, order, ts, bucket_seconds))
    d = d.withColumn("_blk", F.floor((F.col("_rn") - 1) / block_rows)).select(key, row_id, event, "_rn", "_blk")
    # read by pass A and pass C: materialise the numbered rows once
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(d.sparkSession)
    d = d.checkpoint(eager=True)
    ktype = d.schema[key].dataType.simpleString()
    rid_type = d.schema[row_id].dataType.simpleString()
    nstates = len(STORED_STATES)
    fcols = ", ".join(f"f{i} int" for i in range(nstates))

    # pass A: transition function of every (key, block), streamed per block
    funcs = keyed_scan(d, [key, "_blk"], ["_rn"], lambda: _BlockFunctionFold(nstates, event),
                       f"{key} {ktype}, _blk long, {fcols}")
    # pass B: compose block functions per key -> start state of each block
    start = keyed_scan(funcs, key, ["_blk"], _BlockStartFold, f"{key} {ktype}, _blk long, _start int")
    # pass C: replay each block from its start state, emit alerts
    joined = join_keys(d, start, [key, "_blk"], "inner")
    return keyed_scan(joined, [key, "_blk"], ["_rn"], lambda: _ReplayFold(key, row_id, event),
                      f"{key} {ktype}, {row_id} {rid_type}, state string, {event} string")


class _BlockFunctionFold:
    """Per (key, block): the state each possible start state ends in."""

    def __init__(self, n, event):
        self.n, self.evt = n, event

    def start(self, key):
        self.key, self.cur = key, list(range(self.n))

    def row(self, rec):
        j = _EIDX.get(rec[self.evt], _UNKNOWN)
        self.cur = [NEXT[s][j] for s in self.cur]
        return []

    def finish(self):
        return [(*self.key, *self.cur)]


class _BlockStartFold:
    def start(self, key):
        self.key, self.s = key, 0

    def row(self, rec):
        out = [(self.key, rec["_blk"], self.s)]
        self.s = rec[f"f{self.s}"]
        return out

    def finish(self):
        return []


class _ReplayFold:
    def __init__(self, key, row_id, event):
        self.k, self.rid, self.evt = key, row_id, event

    def start(self, key):
        self.key, self.s = key, None

    def row(self, rec):
        if self.s is None:
            self.s = rec["_start"]
        j = _EIDX.get(rec[self.evt], _UNKNOWN)
        out = []
        if not VALID[self.s][j]:
            out.append((rec[self.k], rec[self.rid], STORED_STATES[self.s], rec[self.evt]))
        self.s = NEXT[self.s][j]
        return out

    def finish(self):
        return []


# ------------------------------------------------------------ keyed scan ---
def keyed_scan(df: DataFrame, key, order, step_factory: Callable[[], "KeyedFold"],
               schema: str, partitions: int | None = None) -> DataFrame:
    """Run a per-key sequential fold over rows sorted by ``order``.

    ``key`` is a column name or a list of them (the fold then sees a tuple).
    ``step_factory()`` returns an object with ``start(key)``,
    ``row(rec) -> list[tuple]`` and ``finish() -> list[tuple]``; it is
    re-created per partition and reset per key.
    """
    order = [order] if isinstance(order, str) else list(order)
    keys = [key] if isinstance(key, str) else list(key)
    d = df.repartition(partitions, *keys) if partitions else df.repartition(*keys)
    d = d.sortWithinPartitions(*keys, *order)
    cols = df.columns
    single = len(keys) == 1

    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fold = step_factory()
        names = [c.strip().split(" ")[0] for c in schema.split(",")]
        started, cur = False, None
        for pdf in batches:
            out = []
            for tup in pdf[cols].itertuples(index=False, name=None):
                rec = dict(zip(cols, tup))
                for c in keys:
                    if rec[c] != rec[c]:  # pandas shows a null number as NaN, which differs from itself
                        rec[c] = None
                k = rec[keys[0]] if single else tuple(rec[c] for c in keys)
                if not started or k != cur:
                    if started:
                        out.extend(fold.finish())
                    fold.start(k)
                    cur, started = k, True
                out.extend(fold.row(rec))
            if out:
                yield pd.DataFrame(out, columns=names)
        if started:
            tail = fold.finish()
            if tail:
                yield pd.DataFrame(tail, columns=names)

    return d.mapInPandas(fn, schema)


class KeyedFold:
    """Interface for ``keyed_scan`` folds."""

    def start(self, key):  # pragma: no cover - interface
        self.key = key

    def row(self, rec) -> list:  # pragma: no cover
        return []

    def finish(self) -> list:  # pragma: no cover
        return []

    def __init__(self):
        self.key = None


# ----------------------------------------------------------------- U01 -----
class RiseAlertFold(KeyedFold):
    """Alert when a key's value has not fallen for ``interval_ms``.

    A drop deletes the pending timer; a non-drop with no pending timer
    registers one at ``ts + interval``.  A timer fires when the key's next
    row is later than it (the watermark passed it) or at end of input.
    Rows: dict with ``ts_ms`` (long) and ``value``.
    """

    def __init__(self, interval_ms: int = 3000):
        super().__init__()
        self.interval = interval_ms

    def start(self, key):
        self.key, self.last, self.timer = key, None, None

    def row(self, rec):
        out = []
        t, v = rec["ts_ms"], rec["value"]
        if self.timer is not None and self.timer < t:
            out.append((self.key, self.timer))
            self.timer = None
        if self.last is not None:
            if v < self.last:
                self.timer = None
            elif self.timer is None:
                self.timer = t + self.interval
        self.last = v
        return out

    def finish(self):
        return [(self.key, self.timer)] if self.timer is not None else []


def rise_alerts(df: DataFrame, key: str, ts: str, value: str, order, interval_ms: int = 3000) -> DataFrame:
    """U01 batch form: (key, alert time) for every fired timer."""
    d = df.select(F.col(key), F.unix_millis(F.col(ts).cast("timestamp")).alias("ts_ms"),
                  F.col(value).alias("value"), *[c for c in order if c not in (key, ts, value)])
    ktype = df.schema[key].dataType.simpleString()
    r = keyed_scan(d, key, ["ts_ms"] + [c for c in order if c != ts],
                   lambda: RiseAlertFold(interval_ms), f"{key} {ktype}, alert_ms long")
    return r.withColumn("alert_time", F.timestamp_millis("alert_ms"))


class _RiseSegmentFold(KeyedFold):
    """U01 inside one segment (rows from a reset to the next reset): the
    first row only records its value; later rows (never drops) fire a pending
    timer that is earlier than them and register a new one when none is
    pending.  At the end, the pending timer fires if it is earlier than the
    next segment's first row (or there is none)."""

    def __init__(self, interval_ms: int):
        super().__init__()
        self.interval = interval_ms

    def start(self, key):
        self.key, self.timer, self.first, self.next_t = key[0], None, True, None

    def row(self, rec):
        out = []
        t = rec["ts_ms"]
        self.next_t = rec["_tnext"]
        if self.first:
            self.first = False
            return out
        if self.timer is not None and self.timer < t:
            out.append((self.key, self.timer))
            self.timer = None
        if self.timer is None:
            self.timer = t + self.interval
        return out

    def finish(self):
        if self.timer is not None and (self.next_t is None or pd.isna(self.next_t) or self.timer < self.next_t):
            return [(self.key, self.timer)]
        return []


def rise_alerts_segmented(df: DataFrame, key: str, ts: str, value: str, order,
                          interval_ms: int = 3000, bucket_seconds: float | None = None) -> DataFrame:
    """U01 split at resets: a falling value always clears the timer, so the
    rows between two falls form independent segments.  Falls come from a
    bucketed lag, segment numbers from a bucketed running count, and each
    segment learns the next segment's start time by an equi-join on the
    (dense) segment number -- then segments are folded in parallel, so a hot
    key is spread over tasks."""
    from .running import lag_bucketed, running
    order = [order] if isinstance(order, str) else list(order)
    d = df.select(F.col(key), F.col(ts).cast("timestamp").alias("_ts"),
                  F.unix_millis(F.col(ts).cast("timestamp")).alias("ts_ms"),
                  F.col(value).alias("_val"), *[c for c in order if c not in (key, ts, value)])
    o = ["_ts"] + [c for c in order if c != ts]
    b = order_bucket(d, o, "_ts", bucket_seconds)
    d = lag_bucketed(d, [key], o, "_val", "_pv", b)
    d = d.withColumn("_start", (F.col("_pv").isNull() | (F.col("_val") < F.col("_pv"))).cast("long"))
    d = running(d, [key], o, "_start", "sum", "_seg", b)
    nxt = d.filter(F.col("_start") == 1).select(F.col(key).alias("_k2"), (F.col("_seg") - 1).alias("_s2"),
                                                F.col("ts_ms").alias("_tnext"))
    d = d.join(nxt, d[key].eqNullSafe(nxt["_k2"]) & (d["_seg"] == nxt["_s2"]), "left").drop("_k2", "_s2")
    ktype = df.schema[key].dataType.simpleString()
    r = keyed_scan(d.select(key, "_seg", "ts_ms", "_tnext", *o), [key, "_seg"], o,
                   lambda: _RiseSegmentFold(interval_ms), f"{key} {ktype}, alert_ms long")
    return r.withColumn("alert_time", F.timestamp_millis("alert_ms"))
