"""Custom triggers on streams with event-time timers.

Window-scoped triggers (T25, J19) are keyed by (key, window): a timer at the
window's end fires what is left, once the watermark passes it, and clears the
state, so the last window of every key is emitted although no further row
comes. The global window of T15 has no end; its timer empties the buffer when
everything in it is older than the evictor's span. State is typed and small.
"""

from __future__ import annotations

from collections import deque
from decimal import Decimal

import pandas as pd
from pyspark.sql.streaming.stateful_processor import (ExpiredTimerInfo, StatefulProcessor,
                                                      StatefulProcessorHandle, TimerValues)

from .keyed import in_order


class PriceDropProcessor(StatefulProcessor):
    """T25, keyed by (key, window start): rows ``t`` (microseconds), ``rid``
    and ``p``. A drop of more than ``big`` fires at once; one of more than
    ``small`` at the next boundary, reached by a row or by the watermark; the
    window's end fires the rest."""

    COLUMNS = ["key", "ws", "fire_us", "reason", "n", "avg_price"]

    def __init__(self, size_us: int, boundary_us: int, big: float, small: float):
        self.size, self.boundary, self.big, self.small = size_us, boundary_us, big, small

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "n long, total double, last double")
        self.timers = handle.getListState("timers", "t long")

    def _fire(self, out: list, key, held: list, when: int, why: str) -> None:
        if held[0]:
            out.append((key[0], key[1], when, why, held[0], held[1] / held[0]))
            held[0], held[1] = 0, 0.0

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        pdf = in_order(rows, ["t", "rid"])
        if self.held.exists():
            held, waiting = list(self.held.get()), [r[0] for r in self.timers.get()] if self.timers.exists() else []
        else:
            held, waiting = [0, 0.0, None], []
            self.handle.registerTimer((int(key[1]) + self.size) // 1000)
        out: list = []
        for t, p in zip(pdf["t"].tolist(), pdf["p"].tolist()):
            while waiting and waiting[0] <= t:
                self._fire(out, key, held, waiting.pop(0), "timer")
            held[0], held[1] = held[0] + 1, held[1] + p
            if held[2] is not None:
                if held[2] - p > held[2] * self.big:
                    self._fire(out, key, held, t, "drop")
                elif held[2] - p > held[2] * self.small:
                    due = (t // self.boundary + 1) * self.boundary
                    if due not in waiting:
                        waiting = sorted([*waiting, due])
                        if due < key[1] + self.size:
                            self.handle.registerTimer(due // 1000)
            held[2] = p
        self._keep(held, waiting)
        yield pd.DataFrame(out, columns=self.COLUMNS)

    def _keep(self, held: list, waiting: list) -> None:
        self.held.update(tuple(held))
        if waiting:
            self.timers.put([(t,) for t in waiting])
        else:
            self.timers.clear()

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo):
        out: list = []
        if self.held.exists():
            now, end = expiredTimerInfo.getExpiryTimeInMs() * 1000, key[1] + self.size
            held, waiting = list(self.held.get()), [r[0] for r in self.timers.get()] if self.timers.exists() else []
            while waiting and waiting[0] <= now and waiting[0] < end:
                self._fire(out, key, held, waiting.pop(0), "timer")
            if now >= end:
                self._fire(out, key, held, end, "end")
                self.held.clear()
                self.timers.clear()
            else:
                self._keep(held, waiting)
        yield pd.DataFrame(out, columns=self.COLUMNS)

    def close(self) -> None:
        pass


class CoGroupFireProcessor(StatefulProcessor):
    """J19, keyed by (key, window start): rows ``side`` ('L'/'R') and ``v``.
    Fires on every row once both sides were seen, evicts the left rows after
    each firing, and fires once more at the window's end."""

    COLUMNS = ["user_id", "ws_us", "fire_seq", "trigger", "n_left", "n_right", "sum_left", "sum_right"]

    def __init__(self, size_us: int, order: list[str]):
        self.size, self.order = size_us, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState(
            "held", "seq long, left long, sum_left decimal(38,2), right long, sum_right decimal(38,2), seen boolean")

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        if self.held.exists():
            seq, left, sum_left, right, sum_right, seen = self.held.get()
        else:
            seq, left, sum_left, right, sum_right, seen = 0, 0, None, 0, None, False
            self.handle.registerTimer((int(key[1]) + self.size) // 1000)
        pdf = in_order(rows, self.order)
        out = []
        for side, v in zip(pdf["side"].tolist(), pdf["v"].tolist()):
            seq += 1
            if side == "L":
                seen, left, sum_left = True, left + 1, v if sum_left is None else sum_left + v
            else:
                right, sum_right = right + 1, v if sum_right is None else sum_right + v
            if seen and right:
                out.append((key[0], key[1], seq, "both", left, right, sum_left, sum_right))
                left, sum_left = 0, None
        self.held.update((seq, left, sum_left, right, sum_right, seen))
        yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo):
        seq, left, sum_left, right, sum_right, _ = self.held.get()
        self.held.clear()
        yield self._frame([(key[0], key[1], seq + 1, "end", left, right, sum_left, sum_right)])

    def _frame(self, rows: list) -> pd.DataFrame:
        plain = lambda v: float(v) if isinstance(v, Decimal) else v
        out = pd.DataFrame([tuple(map(plain, r)) for r in rows], columns=self.COLUMNS)
        return out.astype({"sum_left": "float64", "sum_right": "float64"})

    def close(self) -> None:
        pass


class TopSpeedProcessor(StatefulProcessor):
    """T15, keyed by key: rows ``ts_us``, ``row_id``, ``speed`` and ``step``
    (what the row adds to the distance). A row whose distance exceeds that of
    the last firing by more than ``threshold`` fires with the fastest row of
    the last ``evict_ms`` (the earliest of equal ones)."""

    COLUMNS = ["user_id", "fire_us", "fire_id", "max_id", "max_speed"]

    def __init__(self, threshold: float, evict_ms: int):
        self.threshold, self.evict = threshold, evict_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.way = handle.getValueState("way", "distance decimal(38,2), fired decimal(38,2)")
        self.recent = handle.getListState("recent", "t long, id long, speed double")
        self.idle = handle.getValueState("idle", "due long")

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        pdf = in_order(rows, ["ts_us", "row_id"])
        distance, fired = self.way.get() if self.way.exists() else (Decimal(0), None)
        recent = deque(tuple(r) for r in self.recent.get()) if self.recent.exists() else deque()
        out = []
        for t, i, speed, step in zip(*(pdf[c].tolist() for c in ("ts_us", "row_id", "speed", "step"))):
            distance += step
            recent.append((t, i, speed))
            while recent[0][0] <= t - self.evict * 1000:
                recent.popleft()
            if fired is None:
                fired = distance
            elif distance - fired > self.threshold:
                fired = distance
                best = max(recent, key=lambda r: (r[2], -r[0], -r[1]))
                out.append((key[0], t, i, best[1], best[2]))
        self.way.update((distance, fired))
        self.recent.put(list(recent))
        due = recent[-1][0] // 1000 + self.evict + 1
        if self.idle.exists():
            self.handle.deleteTimer(self.idle.get()[0])
        self.handle.registerTimer(due)
        self.idle.update((due,))
        yield pd.DataFrame(out, columns=self.COLUMNS)

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo):
        # no row of the last span is left: the buffer goes, the distance stays
        self.recent.clear()
        self.idle.clear()
        return iter([])

    def close(self) -> None:
        pass
