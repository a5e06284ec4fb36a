"""Stateful processors for ``transformWithStateInPandas`` (streaming forms
of U01, U05, K11, J20, U02, T26, T21/T22).

Each processor keeps O(1) state per key (values, a timer) in the state
store.  Rows of a key inside one micro-batch arrive in no particular order,
so every processor sorts the batch's rows by event time before folding;
the fold logic is shared with the batch forms in
``streamlake.operators.stateful``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql.streaming.stateful_processor import (ExpiredTimerInfo, StatefulProcessor,
                                                      StatefulProcessorHandle, TimerValues)

from ..operators.stateful import state_machine_step


def _sorted(rows: Iterator[pd.DataFrame], by) -> pd.DataFrame:
    frames = list(rows)
    pdf = pd.concat(frames, ignore_index=True) if len(frames) > 1 else frames[0]
    return pdf.sort_values(by, kind="stable")


class StateMachineProcessor(StatefulProcessor):
    """Per address the DFA state; alert on invalid transitions."""

    def __init__(self, event_col: str = "evt", id_col: str = "event_id", order=("ts", "event_id")):
        self.event_col, self.id_col, self.order = event_col, id_col, list(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("dfa", "state string")

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        pdf = _sorted(rows, self.order)
        cur = self.state.get()[0] if self.state.exists() else None
        ids, states, evs = [], [], []
        for rid, e in zip(pdf[self.id_col].tolist(), pdf[self.event_col].tolist()):
            new, alert = state_machine_step(cur, e)
            if alert:
                ids.append(rid)
                states.append(cur or "Initial")
                evs.append(e)
            cur = new
        if cur is None:
            self.state.clear()
        else:
            self.state.update((cur,))
        yield pd.DataFrame({"user_id": [key[0]] * len(ids), "event_id": pd.Series(ids, dtype="int64"),
                            "state": pd.Series(states, dtype=object), "evt": pd.Series(evs, dtype=object)})

    def close(self) -> None:
        pass


class RiseAlertProcessor(StatefulProcessor):
    """Event-time timer ``interval`` after a non-falling value; a drop
    deletes it; a later row of the key or the watermark fires it."""

    def __init__(self, interval_ms: int = 3000):
        self.interval = interval_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "v double")
        self.timer = handle.getValueState("timer", "t long")

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        pdf = _sorted(rows, ["ts_ms"])
        last = self.last.get()[0] if self.last.exists() else None
        timer = self.timer.get()[0] if self.timer.exists() else None
        fired = []
        for t, v in zip(pdf["ts_ms"].tolist(), pdf["value"].tolist()):
            if timer is not None and timer < t:
                fired.append(timer)
                self.handle.deleteTimer(timer)
                timer = None
            if last is not None:
                if v < last:
                    if timer is not None:
                        self.handle.deleteTimer(timer)
                    timer = None
                elif timer is None:
                    timer = t + self.interval
                    self.handle.registerTimer(timer)
            last = v
        self.last.update((float(last),))
        if timer is None:
            self.timer.clear()
        else:
            self.timer.update((int(timer),))
        yield pd.DataFrame({"user_id": [key[0]] * len(fired), "alert_ms": pd.Series(fired, dtype="int64")})

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo):
        t = expiredTimerInfo.getExpiryTimeInMs()
        self.timer.clear()
        yield pd.DataFrame({"user_id": [key[0]], "alert_ms": [int(t)]})

    def close(self) -> None:
        pass


class RetractCountProcessor(StatefulProcessor):
    """Retract changelog of ``COUNT(*) GROUP BY key``: each row emits
    ``(false, old)`` (if any) then ``(true, new)``."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "n long")

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        pdf = _sorted(rows, ["ts", "event_id"])
        n = self.count.get()[0] if self.count.exists() else 0
        out = []
        for rid in pdf["event_id"].tolist():
            if n > 0:
                out.append((False, n, rid, 0))
            n += 1
            out.append((True, n, rid, 1))
        self.count.update((n,))
        o = pd.DataFrame(out, columns=["is_add", "value", "event_id", "seq"])
        o.insert(1, "event_type", key[0])
        yield o

    def close(self) -> None:
        pass


class LatestStatusProcessor(StatefulProcessor):
    """Tagged union of status rows (side 's') and probe rows (side 'p');
    probes are emitted with the latest status seen for the key, and dropped
    while no status exists."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.status = handle.getValueState("status", "s double")

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        pdf = _sorted(rows, ["ts", "side_order"])
        cur = self.status.get()[0] if self.status.exists() else None
        ids, vals = [], []
        for side, rid, v in zip(pdf["side"].tolist(), pdf["event_id"].tolist(), pdf["value"].tolist()):
            if side == "s":
                cur = v
            elif cur is not None:
                ids.append(rid)
                vals.append(cur)
        if cur is not None:
            self.status.update((float(cur),))
        yield pd.DataFrame({"purchase_id": pd.Series(ids, dtype="int64"),
                            "status": pd.Series(vals, dtype="float64")})

    def close(self) -> None:
        pass


class TtlCountProcessor(StatefulProcessor):
    """Running count per key whose state expires after ``ttl_ms`` of
    processing time without updates (idle-state retention)."""

    def __init__(self, ttl_ms: int = 3_600_000):
        self.ttl = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "n long", ttlDurationMs=self.ttl)

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        n = self.count.get()[0] if self.count.exists() else 0
        n += sum(len(p) for p in rows)
        self.count.update((n,))
        yield pd.DataFrame({"key": [key[0]], "cnt": [n]})

    def close(self) -> None:
        pass


class BehaviorCountProcessor(StatefulProcessor):
    """Map state (behaviour -> count) per user; every input row is
    emitted with the updated count of its behaviour."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getMapState("counts", "behavior string", "n long")

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        pdf = _sorted(rows, ["ts", "event_id"])
        out = []
        for rid, b in zip(pdf["event_id"].tolist(), pdf["event_type"].tolist()):
            n = self.counts.getValue((b,))[0] + 1 if self.counts.containsKey((b,)) else 1
            self.counts.updateValue((b,), (n,))
            out.append((rid, b, n))
        o = pd.DataFrame(out, columns=["event_id", "event_type", "cnt"])
        o.insert(1, "user_id", key[0])
        yield o

    def close(self) -> None:
        pass


class LatenessProcessor(StatefulProcessor):
    """T21/T22 on a stream: tag each row against the watermark in force for
    its micro-batch -- ``on_time``, ``late`` (its tumbling window already
    closed, still within allowed lateness) or ``dropped``.  The tagged rows
    feed the main path and a side output (two filters or ``foreachBatch``)."""

    def __init__(self, size_ms: int, lateness_ms: int = 0):
        self.size, self.lateness = size_ms, lateness_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        wm = timerValues.getCurrentWatermarkInMs()
        for pdf in rows:
            end = (pdf["ts_ms"] // self.size + 1) * self.size
            status = pd.Series("on_time", index=pdf.index, dtype=object)
            if wm > 0:
                status[end <= wm] = "late"
                status[end + self.lateness <= wm] = "dropped"
            yield pd.DataFrame({"event_id": pdf["event_id"], "lateness": status})

    def close(self) -> None:
        pass
