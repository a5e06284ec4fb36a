"""Streaming forms of keyed stateful operators over an ``events`` stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.event_time import cascade, with_event_time
from .keyed import top_n_stream
from .processors import (LatestStatusProcessor, RetractCountProcessor, RiseAlertProcessor,
                         StateMachineProcessor, TtlCountProcessor, BehaviorCountProcessor, LatenessProcessor)
from .triggers import CoGroupFireProcessor, PriceDropProcessor, TopSpeedProcessor


def state_machine_stream(events: DataFrame, letter) -> DataFrame:
    """U05 on a stream keyed by ``user_id``."""
    e = events.select("user_id", "event_id", "ts", letter.alias("evt"))
    return e.groupBy("user_id").transformWithStateInPandas(
        StateMachineProcessor(), "user_id long, event_id long, state string, evt string",
        "Append", "None")


def rise_alerts_stream(events: DataFrame, interval_ms: int, delay: str = "0 seconds") -> DataFrame:
    """U01 on a stream: event-time timers driven by the watermark."""
    e = events.withWatermark("ts", delay).select(
        "user_id", "ts", F.unix_millis("ts").alias("ts_ms"), "value")
    return e.groupBy("user_id").transformWithStateInPandas(
        RiseAlertProcessor(interval_ms), "user_id long, alert_ms long", "Append", "EventTime")


def retract_count_stream(events: DataFrame) -> DataFrame:
    """K11 on a stream."""
    e = events.select("event_type", "ts", "event_id")
    return e.groupBy("event_type").transformWithStateInPandas(
        RetractCountProcessor(), "is_add boolean, event_type string, value long, event_id long, seq int",
        "Append", "None")


def latest_status_stream(events: DataFrame, probe_type: str, status_type: str) -> DataFrame:
    """J20 on a stream: one tagged union, keyed by user."""
    s = events.filter(F.col("event_type") == status_type).select(
        "user_id", "ts", "event_id", "value", F.lit("s").alias("side"), F.lit(0).alias("side_order"))
    p = events.filter(F.col("event_type") == probe_type).select(
        "user_id", "ts", "event_id", "value", F.lit("p").alias("side"), F.lit(1).alias("side_order"))
    return s.unionByName(p).groupBy("user_id").transformWithStateInPandas(
        LatestStatusProcessor(), "purchase_id long, status double", "Append", "None")


def windowed_counts_stream(events: DataFrame, size: str, delay: str) -> DataFrame:
    """T09/T01 on a stream: append mode emits each window once it is final."""
    return events.withWatermark("ts", delay).groupBy(
        "event_type", F.window("ts", size).alias("w")).agg(F.count(F.lit(1)).alias("cnt")) \
        .select("event_type", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "cnt")


def ttl_counts_stream(events: DataFrame, key: str, ttl_ms: int) -> DataFrame:
    """Per-key counts with idle-state TTL (processing time)."""
    return events.groupBy(key).transformWithStateInPandas(
        TtlCountProcessor(ttl_ms), f"key {events.schema[key].dataType.simpleString()}, cnt long",
        "Update", "ProcessingTime")


def periodic_watermark_stream(events: DataFrame, delay: str, every: str, size: str):
    """Bounded-delay watermark advanced on a periodic trigger: returns
    the windowed counts and the trigger to start them with."""
    return windowed_counts_stream(events, size, delay), {"processingTime": every}


def behavior_counts_stream(events: DataFrame) -> DataFrame:
    """U02 on a stream: map state per user."""
    e = events.select("user_id", "event_id", "ts", "event_type")
    return e.groupBy("user_id").transformWithStateInPandas(
        BehaviorCountProcessor(), "event_id long, user_id long, event_type string, cnt long", "Append", "None")


def top_speed_stream(events: DataFrame, threshold: float, evict_ms: int, delay: str = "0 seconds") -> DataFrame:
    """T15 on a stream: the distance (running total of ``value`` per user) is
    part of the state."""
    e = events.withWatermark("ts", delay).select(
        F.col("user_id").alias("key"), "ts", F.unix_micros("ts").alias("ts_us"), F.col("event_id").alias("row_id"),
        F.col("value").alias("speed"), F.col("value").cast("decimal(18,2)").alias("step"))
    return e.groupBy("key").transformWithStateInPandas(
        TopSpeedProcessor(threshold, evict_ms), "user_id long, fire_us long, fire_id long, max_id long, max_speed double",
        "Append", "EventTime")


def price_drop_stream(events: DataFrame, size_s: int, boundary_s: int, delay: str = "0 seconds") -> DataFrame:
    """T25 on a stream, keyed by event type and window: timers at the boundaries and at the window's end."""
    size = size_s * 10**6
    e = events.withWatermark("ts", delay).select(
        F.col("event_type").alias("key"), "ts", F.unix_micros("ts").alias("t"), F.col("event_id").alias("rid"),
        F.col("value").alias("p")).withColumn("ws", F.floor(F.col("t") / size) * size)
    return e.groupBy("key", "ws").transformWithStateInPandas(
        PriceDropProcessor(size, boundary_s * 10**6, 0.05, 0.01),
        "key string, ws long, fire_us long, reason string, n long, avg_price double", "Append", "EventTime")


def cogroup_fire_stream(events: DataFrame, size_s: int = 3600, delay: str = "0 seconds") -> DataFrame:
    """J19 on a stream: clicks (left) and purchases (right) per user and window."""
    size = size_s * 10**6
    e = events.filter(F.col("event_type").isin("click", "purchase")).withWatermark("ts", delay).select(
        F.col("user_id").alias("key"), "ts", "event_id",
        (F.floor(F.unix_micros("ts") / size) * size).alias("ws_us"),
        F.when(F.col("event_type") == "click", "L").otherwise("R").alias("side"),
        F.col("value").cast("decimal(18,2)").alias("v"))
    out = e.groupBy("key", "ws_us").transformWithStateInPandas(
        CoGroupFireProcessor(size, ["ts", "side", "event_id"]),
        "user_id long, ws_us long, fire_seq long, trigger string, n_left long, n_right long, "
        "sum_left double, sum_right double", "Append", "EventTime")
    return out.withColumn("ws", F.timestamp_micros("ws_us")).drop("ws_us")


def top_users_stream(events: DataFrame, size: str, n: int, delay: str = "0 seconds") -> DataFrame:
    """W07 on a stream: sums per user and window, final when the watermark
    passes the window, then the window's best ``n`` users as a changelog."""
    w = F.window("ts", size)
    sums = (events.withWatermark("ts", delay).groupBy("user_id", w.alias("w"))
            .agg(F.sum(F.col("value").cast("decimal(18,4)")).cast("double").alias("rss")))
    rows = sums.select("user_id", "rss", F.col("w.start").alias("start_time"), "w")
    return top_n_stream(rows, "start_time", ["-rss", "user_id"], n, "w")


def cascade_stream(events: DataFrame, first: str, second: str, keys, delay: str = "0 seconds") -> DataFrame:
    """T20 on a stream: both windows follow one watermark."""
    return cascade(with_event_time(events, "ts", delay), "ts", first, second, keys)


def lateness_stream(events: DataFrame, size_ms: int, delay: str, lateness_ms: int = 0) -> DataFrame:
    """T21/T22 on a stream: per-row lateness tag against the watermark."""
    e = events.withWatermark("ts", delay).select(
        "event_type", "event_id", "ts", F.unix_millis("ts").alias("ts_ms"))
    return e.groupBy("event_type").transformWithStateInPandas(
        LatenessProcessor(size_ms, lateness_ms), "event_id long, lateness string", "Append", "EventTime")


def sliding_counts_stream(events: DataFrame, size: str, slide: str, delay: str) -> DataFrame:
    """T11 on a stream (append: a window is emitted once the watermark passes it)."""
    return events.withWatermark("ts", delay).groupBy(
        "event_type", F.window("ts", size, slide).alias("w")).agg(F.count(F.lit(1)).alias("cnt")) \
        .select("event_type", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "cnt")


def sessions_stream(events: DataFrame, gap: str, delay: str) -> DataFrame:
    """T12 on a stream with Spark's session windows."""
    return events.withWatermark("ts", delay).groupBy(
        "user_id", F.session_window("ts", gap).alias("s")).agg(F.count(F.lit(1)).alias("cnt")) \
        .select("user_id", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "cnt")
