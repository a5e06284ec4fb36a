"""Joins of two streams.

Both sides carry a watermark, and the condition bounds the time a row can
wait for partners, so Spark drops join state by itself: a row leaves the state
store once the other side's watermark says that no partner can come. Results
are those of the batch forms in ``streamlake.operators.joins`` for rows that
are not later than the declared delay.

The two sides' column names must be distinct, as in any equi-join by name.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import (ExpiredTimerInfo, StatefulProcessor,
                                                      StatefulProcessorHandle, TimerValues)


def _interval(ms: int) -> Column:
    return F.expr(f"INTERVAL '{ms / 1000:.3f}' SECOND")


def interval_join_stream(left: DataFrame, right: DataFrame, key_l: str, key_r: str, ts_l: str, ts_r: str,
                         lower_ms: int, upper_ms: int, lower_inclusive: bool = True,
                         upper_inclusive: bool = True, delay_l: str = "0 seconds",
                         delay_r: str = "0 seconds") -> DataFrame:
    """J14/J15 on streams: ``ts_r`` within [``ts_l`` + lower, ``ts_l`` + upper]
    (either bound may be exclusive).

    The bounds stand on the raw timestamps, from which Spark derives how long
    each side's rows are kept: a left row until the right watermark passes
    ts + upper, a right row until the left one passes ts - lower.
    """
    low, high = F.col(ts_l) + _interval(lower_ms), F.col(ts_l) + _interval(upper_ms)
    t = F.col(ts_r)
    return left.withWatermark(ts_l, delay_l).join(
        right.withWatermark(ts_r, delay_r),
        (F.col(key_l) == F.col(key_r)) & (t >= low if lower_inclusive else t > low)
        & (t <= high if upper_inclusive else t < high))


def window_join_stream(left: DataFrame, right: DataFrame, key_l: str, key_r: str, ts_l: str, ts_r: str,
                       size: str, delay_l: str = "0 seconds", delay_r: str = "0 seconds") -> DataFrame:
    """J17 on streams: pairs of equal key inside the same tumbling window.

    The window itself is a join key, so both sides' rows of a window leave the
    state when the watermark passes its end."""
    def windowed(df: DataFrame, ts: str, delay: str, out: str) -> DataFrame:
        w = df.withWatermark(ts, delay).withColumn(out, F.window(ts, size))
        # the window is the event-time column from here on, the raw time a plain one
        return w.withColumn(ts, F.timestamp_micros(F.unix_micros(ts)))

    l, r = windowed(left, ts_l, delay_l, "_w"), windowed(right, ts_r, delay_r, "_wr")
    return l.join(r, (F.col(key_l) == F.col(key_r)) & (F.col("_w") == F.col("_wr"))) \
            .withColumn("window_start", F.col("_w.start")).drop("_w", "_wr")


class CoGroupProcessor(StatefulProcessor):
    """One list state per side of a (key, window); an event-time timer at
    the window's end emits both lists (either may be empty) and clears them."""

    def __init__(self, value_type: str, size_ms: int):
        self.value_type, self.size = value_type, size_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sides = [handle.getListState(name, f"v {self.value_type}") for name in ("left", "right")]
        self.open = handle.getValueState("open", "o boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues):
        if not self.open.exists():
            self.open.update((True,))
            self.handle.registerTimer(int(key[1]))
        for pdf in rows:
            for side, state in enumerate(self.sides):
                values = pdf.loc[pdf["side"] == side, "v"].tolist()
                if values:
                    state.appendList([(v,) for v in values])
        return iter([])

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo):
        lists = [[v[0] for v in state.get()] if state.exists() else [] for state in self.sides]
        for state in (*self.sides, self.open):
            state.clear()
        end = int(key[1])
        yield pd.DataFrame({"key": [key[0]], "start_ms": [end - self.size], "end_ms": [end],
                            "left_values": [lists[0]], "right_values": [lists[1]]})

    def close(self) -> None:
        pass


def window_cogroup_stream(left: DataFrame, right: DataFrame, key: str, ts: str, size_ms: int, value: str,
                          delay: str = "0 seconds") -> DataFrame:
    """J18 on streams: per (key, tumbling window) both sides' value lists,
    emitted when the watermark (the lesser of the two sides') passes the
    window's end: ``key, window_start, window_end, left_values, right_values``."""
    def tagged(df: DataFrame, side: int) -> DataFrame:
        return df.withWatermark(ts, delay).select(
            F.col(key).alias("key"), ts, F.col(value).alias("v"), F.lit(side).alias("side"),
            ((F.floor(F.unix_millis(ts) / size_ms) + 1) * size_ms).alias("end_ms"))

    kind, vtype = (left.schema[c].dataType.simpleString() for c in (key, value))
    out = tagged(left, 0).unionByName(tagged(right, 1)).groupBy("key", "end_ms").transformWithStateInPandas(
        CoGroupProcessor(vtype, size_ms),
        f"key {kind}, start_ms long, end_ms long, left_values array<{vtype}>, right_values array<{vtype}>",
        "Append", "EventTime")
    return out.select(F.col("key").alias(key), F.timestamp_millis("start_ms").alias("window_start"),
                      F.timestamp_millis("end_ms").alias("window_end"), "left_values", "right_values")
