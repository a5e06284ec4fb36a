"""Keyed state on streams: running aggregates (A03, A04, W01), count windows
(T13), top-N with retraction (W06, W07) and processing-time windows (T10).

Rows of a key inside one micro-batch arrive in no particular order, so the
processors sort them by the declared order first; across micro-batches the
order is that of arrival. State is typed and bounded per key: a total, the
last ``size`` values, the best n rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import (ExpiredTimerInfo, StatefulProcessor,
                                                      StatefulProcessorHandle, TimerValues)


def in_order(rows: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    """All rows of a key in one micro-batch, sorted."""
    return pd.concat(list(rows), ignore_index=True).sort_values(order, kind="stable")


class _Processor(StatefulProcessor):
    def close(self) -> None:
        pass


class RunningSumProcessor(_Processor):
    """Per row the sum of the key's values so far (W02/A20 with the value 1)."""

    def __init__(self, order: list[str], row_id: str, value: str):
        self.order, self.row_id, self.value = order, row_id, value

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "s decimal(38,6)")

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        pdf = in_order(rows, self.order)
        total = self.total.get()[0] if self.total.exists() else Decimal(0)
        out = []
        for v in pdf[self.value]:
            total += v if v is not None else 0
            out.append(total)
        self.total.update((total,))
        yield pd.DataFrame({"key": [key[0]] * len(out), "row_id": pdf[self.row_id].to_numpy(), "total": out})


class RunningMaxProcessor(_Processor):
    """Per row the key's largest value so far, the other field from the key's first row."""

    def __init__(self, order: list[str], row_id: str, value: str, other: str, other_type: str):
        self.order, self.row_id, self.value, self.other, self.other_type = order, row_id, value, other, other_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getValueState("best", f"v double, other {self.other_type}")

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        pdf = in_order(rows, self.order)
        best, other = self.best.get() if self.best.exists() else (None, pdf[self.other].iloc[0])
        out = []
        for v in pdf[self.value]:
            best = v if best is None or (v is not None and v > best) else best
            out.append(best)
        self.best.update((best, other))
        yield pd.DataFrame({"key": [key[0]] * len(out), "row_id": pdf[self.row_id].to_numpy(), "best": out,
                            "other": [other] * len(out)})


class LastRowsProcessor(_Processor):
    """The last ``size`` values of a key in a list state. Every ``slide``-th
    row emits their sum: T13 with ``slide`` > 1, W01 with ``slide`` = 1."""

    def __init__(self, order: list[str], row_id: str, value: str, size: int, slide: int):
        self.order, self.row_id, self.value, self.size, self.slide = order, row_id, value, size, slide

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getListState("held", "v decimal(38,6)")
        self.seen = handle.getValueState("seen", "n long")

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        pdf = in_order(rows, self.order)
        last = [v[0] for v in self.held.get()] if self.held.exists() else []
        n = self.seen.get()[0] if self.seen.exists() else 0
        out = []
        for i, v in zip(pdf[self.row_id].tolist(), pdf[self.value]):
            last.append(v if v is not None else Decimal(0))
            del last[:-self.size]
            n += 1
            if n % self.slide == 0:
                out.append((key[0], i, n, sum(last, Decimal(0))))
        self.held.put([(v,) for v in last])
        self.seen.update((n,))
        yield pd.DataFrame(out, columns=["key", "row_id", "row_count", "total"])


def _with_value(df: DataFrame, key: str, order: list[str], row_id: str, value: str) -> DataFrame:
    cols = dict.fromkeys([*order, row_id])
    return df.select(F.col(key).alias("grouped"), *cols, F.col(value).cast("decimal(18,2)").alias("amount"))


def running_sum_stream(df: DataFrame, key: str, order: list[str], row_id: str, value: str) -> DataFrame:
    """A03 on a stream: one row ``row_id, key, total`` per input row."""
    kinds = {c: df.schema[c].dataType.simpleString() for c in (key, row_id)}
    out = _with_value(df, key, order, row_id, value).groupBy("grouped").transformWithStateInPandas(
        RunningSumProcessor(order, row_id, "amount"),
        f"key {kinds[key]}, row_id {kinds[row_id]}, total decimal(38,6)", "Append", "None")
    return out.select(F.col("row_id").alias(row_id), F.col("key").alias(key), F.col("total").cast("double").alias("total"))


def running_max_stream(df: DataFrame, key: str, order: list[str], row_id: str, value: str, other: str) -> DataFrame:
    """A04 on a stream: one row ``row_id, key, value, other`` per input row."""
    kinds = {c: df.schema[c].dataType.simpleString() for c in (key, row_id, other)}
    rows = df.select(F.col(key).alias("grouped"), *dict.fromkeys([*order, row_id, other]),
                     F.col(value).cast("double").alias("amount"))
    out = rows.groupBy("grouped").transformWithStateInPandas(
        RunningMaxProcessor(order, row_id, "amount", other, kinds[other]),
        f"key {kinds[key]}, row_id {kinds[row_id]}, best double, other {kinds[other]}", "Append", "None")
    return out.select(F.col("row_id").alias(row_id), F.col("key").alias(key), F.col("best").alias(value),
                      F.col("other").alias(other))


def last_rows_sum_stream(df: DataFrame, key: str, order: list[str], row_id: str, value: str, size: int,
                         slide: int = 1) -> DataFrame:
    """T13 / W01 on a stream: every ``slide``-th row of a key emits the sum of
    its last ``size`` rows: ``row_id, key, row_count, total``."""
    kinds = {c: df.schema[c].dataType.simpleString() for c in (key, row_id)}
    out = _with_value(df, key, order, row_id, value).groupBy("grouped").transformWithStateInPandas(
        LastRowsProcessor(order, row_id, "amount", size, slide),
        f"key {kinds[key]}, row_id {kinds[row_id]}, row_count long, total decimal(38,6)", "Append", "None")
    return out.select(F.col("row_id").alias(row_id), F.col("key").alias(key), "row_count",
                      F.col("total").cast("double").alias("total"))


class TopNProcessor(_Processor):
    """A group's best ``n`` rows, kept as a list state in order. A
    micro-batch that changes them emits what left (``is_add`` false) and what
    came, with ranks; a row whose rank alone changes is replaced. If groups
    are windows (``ends``: the key's second part), a timer at their end clears them."""

    def __init__(self, n: int, order: list[str], schema: T.StructType, ends: bool):
        self.n, self.columns, self.schema, self.ends = n, [f.name for f in schema], schema, ends
        self.by = [o.lstrip("-") for o in order]
        self.rising = [not o.startswith("-") for o in order]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getListState("best", self.schema)

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        old = [tuple(r) for r in self.best.get()] if self.best.exists() else []
        if self.ends and not old:
            self.handle.registerTimer(int(key[1]))
        frames = [pdf[self.columns] for pdf in rows]
        if old:
            frames.insert(0, pd.DataFrame(old, columns=self.columns).astype(frames[0].dtypes.to_dict()))
        best = pd.concat(frames, ignore_index=True).sort_values(self.by, ascending=self.rising, kind="stable").head(self.n)
        new = [tuple(r) for r in best.itertuples(index=False, name=None)]
        ranked = lambda held: {(k, *r) for k, r in enumerate(held, 1)}
        gone, come = ranked(old) - ranked(new), ranked(new) - ranked(old)
        if gone or come:
            self.best.put(new)
        out = [(False, key[0], *r) for r in sorted(gone)] + [(True, key[0], *r) for r in sorted(come)]
        yield pd.DataFrame(out, columns=["is_add", "key", "rank", *self.columns])

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo):
        self.best.clear()
        return iter([])


def top_n_stream(df: DataFrame, key: str, order: list[str], n: int, window: str | None = None) -> DataFrame:
    """W06/W07 on a stream: the changelog ``is_add, key, rank, ...`` of the
    best ``n`` rows per ``key`` (``order``: a leading ``-`` sorts descending).
    ``window`` names the window column that ``key`` stands for; the state of a
    window goes when the watermark passes its end."""
    kept = [f for f in df.schema if f.name not in (key, window)]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in kept])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    rows = df.withColumnRenamed(key, "grouped")
    keys = ["grouped"]
    if window:
        rows, keys = rows.withColumn("end_ms", F.unix_millis(F.col(window).getField("end"))), ["grouped", "end_ms"]
    out = rows.groupBy(*keys).transformWithStateInPandas(
        TopNProcessor(n, order, schema, bool(window)),
        f"is_add boolean, key {df.schema[key].dataType.simpleString()}, rank long, {kinds}", "Append",
        "EventTime" if window else "None")
    return out.withColumnRenamed("key", key)


class ClockWindowProcessor(_Processor):
    """Counts per key and window of arrival. A processing-time timer
    closes the window by the clock, whether or not more rows come."""

    def __init__(self, size_ms: int):
        self.size = size_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.window = handle.getValueState("window", "end long, n long")

    def _closed(self, key, end: int, n: int) -> pd.DataFrame:
        return pd.DataFrame({"key": [key[0]], "start_ms": [end - self.size], "end_ms": [end], "cnt": [n]})

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        now = timerValues.getCurrentProcessingTimeInMs()
        end, n = self.window.get() if self.window.exists() else (None, 0)
        if end is not None and end <= now:  # its timer is due in this very batch
            self.handle.deleteTimer(end)
            yield self._closed(key, end, n)
            end, n = None, 0
        if end is None:
            end = (now // self.size + 1) * self.size
            self.handle.registerTimer(end)
        self.window.update((end, n + sum(len(pdf) for pdf in rows)))

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo):
        if self.window.exists():
            end, n = self.window.get()
            if end <= expiredTimerInfo.getExpiryTimeInMs():
                self.window.clear()
                yield self._closed(key, end, n)


def clock_windows_stream(df: DataFrame, key: str, size_ms: int) -> DataFrame:
    """T10 on a stream: ``key, window_start, window_end, cnt`` per tumbling
    window of processing time (run it on a processing-time trigger)."""
    out = df.select(F.col(key).alias("grouped")).groupBy("grouped").transformWithStateInPandas(
        ClockWindowProcessor(size_ms),
        f"key {df.schema[key].dataType.simpleString()}, start_ms long, end_ms long, cnt long", "Append", "ProcessingTime")
    return out.select(F.col("key").alias(key), F.timestamp_millis("start_ms").alias("window_start"),
                      F.timestamp_millis("end_ms").alias("window_end"), "cnt")


def with_source_time(df: DataFrame, delay: str, out: str = "source_ts") -> DataFrame:
    """The timestamp that the source itself emits as the event-time
    column with a watermark: a Kafka record's ``timestamp``, or the time a file
    was written."""
    if "timestamp" in df.columns and {"topic", "partition", "offset"} <= set(df.columns):
        return df.withColumn(out, F.col("timestamp")).withWatermark(out, delay)
    return df.withColumn(out, F.col("_metadata.file_modification_time")).withWatermark(out, delay)
