"""Event-time windows, watermarks and lateness as batch operators
(T01-T05, T08-T23, A13).

Window assignment uses Spark's ``window``/``window_time`` so the same
expressions run unchanged inside Structured Streaming with a watermark.
Lateness is decided the way a bounded-out-of-orderness watermark decides it:
a row is late when, at its arrival, the largest event time seen so far
minus the delay has already passed its window's end (+ allowed lateness).
The running max over arrival order uses the bucketed scheme of
``running`` -- no single-task window over the whole stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .keys import join_keys
from .running import order_bucket, running


def with_event_time(df: DataFrame, ts: str, delay: str = "0 seconds") -> DataFrame:
    """Declare ``ts`` the event-time column with a watermark
    delay (``0 seconds`` = ascending timestamps).  No-op for batch input
    apart from the cast; effective on streams."""
    d = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return d.withWatermark(ts, delay) if d.isStreaming else d


def tumbling(df: DataFrame, ts: str, size: str, keys=(), aggs=(), start_offset: str | None = None) -> DataFrame:
    """Tumbling window aggregate; output has ``window_start``,
    ``window_end``."""
    w = F.window(F.col(ts).cast("timestamp"), size, size, start_offset) if start_offset \
        else F.window(F.col(ts).cast("timestamp"), size)
    return df.groupBy(*keys, w.alias("window")).agg(*aggs) \
             .withColumn("window_start", F.col("window.start")) \
             .withColumn("window_end", F.col("window.end")).drop("window")


def sliding(df: DataFrame, ts: str, size: str, slide: str, keys=(), aggs=()) -> DataFrame:
    """Sliding windows; each row counts in size/slide windows."""
    w = F.window(F.col(ts).cast("timestamp"), size, slide)
    return df.groupBy(*keys, w.alias("window")).agg(*aggs) \
             .withColumn("window_start", F.col("window.start")) \
             .withColumn("window_end", F.col("window.end")).drop("window")


def session_ids(df: DataFrame, key: str, ts: str, order, gap_ms: int,
                bucket_seconds: float | None = None, materialize: bool = True) -> DataFrame:
    """T12 (batch): gap-and-island session numbering, skew-safe.

    A row opens a session when it is the key's first row or follows the
    previous row by more than ``gap_ms`` (rows exactly one gap apart merge).
    The previous timestamp is a running max over rows strictly before, and
    the session number a running count of openings -- both bucketed, so a
    hot key never sits in one task.  The open flags are materialised once in
    the shared checkpoint folder (``materialize``), because both branches of
    the second pass read them.
    """
    order = [order] if isinstance(order, str) else list(order)
    t = F.unix_micros(F.col(ts).cast("timestamp"))
    d = df.withColumn("_tms", t)
    b = order_bucket(df, order, ts, bucket_seconds)
    d = running(d, [key], order, "_tms", "max", "_prev", b, include_current=False)
    d = d.withColumn("_open", (F.col("_prev").isNull() |
                               (F.col("_tms") - F.col("_prev") > gap_ms * 1000)).cast("long"))
    if materialize and not d.isStreaming:
        from ..session import ensure_checkpoint_dir
        ensure_checkpoint_dir(d.sparkSession)
        d = d.checkpoint(eager=True)
    d = running(d, [key], order, "_open", "sum", "session_id", b)
    return d.drop("_prev", "_open", "_tms")


def session_windows(df: DataFrame, key: str, ts: str, order, gap_ms: int, aggs=(),
                    bucket_seconds: float | None = None) -> DataFrame:
    """Per session: start (first ts), end (last ts + gap) and ``aggs``."""
    s = session_ids(df, key, ts, order, gap_ms, bucket_seconds)
    t = F.col(ts).cast("timestamp")
    return s.groupBy(key, "session_id").agg(
        F.min(t).alias("session_start"),
        (F.max(t) + F.expr(f"INTERVAL {int(gap_ms)} MILLISECONDS")).alias("session_end"),
        *aggs).drop("session_id")


def count_window_sum(df: DataFrame, key: str, order, value: str, size: int, slide: int,
                     ts: str, bucket_seconds: float | None = None) -> DataFrame:
    """``countWindow(size, slide).sum(value)`` -- every ``slide``-th row of
    a key emits the sum of that key's last ``size`` rows.

    Row numbers and prefix sums come from the bucketed running scheme; the
    windowed sum is ``S(n) - S(n - size)`` by an equi-join on the row number,
    so no per-key frame buffer is needed.
    """
    order = [order] if isinstance(order, str) else list(order)
    b = order_bucket(df, order, ts, bucket_seconds)
    d = running(df, [key], order, F.lit(1).cast("long"), "sum", "_n", b)
    d = running(d, [key], order, value, "sum", "_s", b)
    fire = d.filter(F.col("_n") % slide == 0)
    base = d.select(F.col(key).alias("_k"), (F.col("_n") + size).alias("_n2"),
                    F.col("_s").alias("_s0"))
    out = fire.join(base, fire[key].eqNullSafe(base["_k"]) & (fire["_n"] == base["_n2"]), "left")
    return out.select(key, F.col("_n").alias("row_count"),
                      (F.col("_s") - F.coalesce(F.col("_s0"), F.lit(0).cast(
                          out.schema["_s"].dataType))).alias(f"sum_{value}"))


def window_reduce_last(df: DataFrame, key: str, ts: str, size: str, price: str,
                       volume: str, tie: str) -> DataFrame:
    """Per window the last price (by time, then by ``tie``) and the summed volume."""
    return tumbling(df, ts, size, [key], [F.max_by(price, F.struct(ts, tie)).alias(price),
                                          F.max(ts).alias(ts),
                                          F.sum(volume).alias(volume)])


def window_max_min(df: DataFrame, key: str, ts: str, size: str, value: str) -> DataFrame:
    """Incremental max/min per window plus window end."""
    return tumbling(df, ts, size, [key], [F.max(value).alias("max_value"),
                                          F.min(value).alias("min_value")])


def window_keep_first(df: DataFrame, key: str, ts: str, size: str, arrival: str) -> DataFrame:
    """``reduce((a, b) -> a)`` -- the first-arrived row of each window."""
    others = [c for c in df.columns if c not in (key,)]
    return tumbling(df, ts, size, [key], [F.min_by(F.struct(*others), F.col(arrival)).alias("r")]) \
        .select(key, "window_start", "window_end", "r.*")


def cascade(df: DataFrame, ts: str, first: str, second: str, keys=(), count_alias="cnt") -> DataFrame:
    """Counts per ``first`` window re-windowed into ``second`` windows
    using the first window's rowtime (``window_time`` = end - 1 microsecond)."""
    # a stream's watermark belongs to the column itself, not to a cast of it
    w1 = F.window(F.col(ts) if df.schema[ts].dataType.typeName() == "timestamp" else F.col(ts).cast("timestamp"), first)
    inner = df.groupBy(*keys, w1.alias("w")).agg(F.count(F.lit(1)).alias("_c")) \
              .withColumn("rowtime", F.window_time("w"))
    w2 = F.window(F.col("rowtime"), second)
    return inner.groupBy(*keys, w2.alias("w2")).agg(F.sum("_c").alias(count_alias)) \
                .withColumn("window_start", F.col("w2.start")) \
                .withColumn("window_end", F.col("w2.end")).drop("w2")


def classify_lateness(df: DataFrame, ts: str, arrival, size: str, delay_ms: int,
                      lateness_ms: int = 0, bucket_rows: int = 100_000) -> DataFrame:
    """Label each row ``on_time`` / ``late`` (window already
    fired, still within allowed lateness) / ``dropped``.

    ``arrival`` lists the columns giving arrival order (the first one a long
    used for bucketing).  The watermark at a row's
    arrival is ``max(ts of earlier arrivals) - delay``; the window fires once
    the watermark reaches its end.
    """
    t = F.col(ts).cast("timestamp")
    d = df.withColumn("_w", F.window(t, size)) \
          .withColumn("_end_ms", F.unix_millis(F.col("_w.end"))) \
          .withColumn("_tms", F.unix_millis(t))
    arrival = [arrival] if isinstance(arrival, str) else list(arrival)
    d = running(d, [], arrival, "_tms", "max", "_prev_max",
                F.floor(F.col(arrival[0]) / bucket_rows), include_current=False)
    wm = F.col("_prev_max") - delay_ms
    fired = wm.isNotNull() & (F.col("_end_ms") <= wm)
    too_late = wm.isNotNull() & (F.col("_end_ms") + lateness_ms <= wm)
    status = F.when(~fired, "on_time").when(~too_late, "late").otherwise("dropped")
    return d.withColumn("lateness", status) \
            .withColumn("window_start", F.col("_w.start")) \
            .withColumn("window_end", F.col("_w.end")) \
            .drop("_w", "_end_ms", "_tms", "_prev_max")


def drop_late(classified: DataFrame) -> DataFrame:
    """Only rows that reach their window before it fires."""
    return classified.filter(F.col("lateness") == "on_time")


def late_side_output(classified: DataFrame) -> DataFrame:
    """Rows that arrive after their window fired (beyond lateness)."""
    return classified.filter(F.col("lateness") != "on_time")


def allowed_lateness_firings(classified: DataFrame, key: str, arrival) -> DataFrame:
    """Window results with re-fire: one ``first`` firing with the
    on-time count, then one ``update`` per late (within lateness) row with
    the count so far.  Dropped rows do not fire.  A window without on-time
    rows fires ``first`` on its first late row."""
    arrival = [arrival] if isinstance(arrival, str) else list(arrival)
    grp = [key, "window_start", "window_end"]
    base = classified.groupBy(*grp).agg(
        F.sum((F.col("lateness") == "on_time").cast("long")).alias("_on"))
    first = base.filter(F.col("_on") > 0).select(*grp, F.col("_on").alias("cnt"),
                                                 F.lit("first").alias("firing"),
                                                 F.lit(0).alias("firing_seq"))
    late = classified.filter(F.col("lateness") == "late")
    w = Window.partitionBy(*grp).orderBy(*arrival)
    late = late.withColumn("_i", F.row_number().over(w))
    late = join_keys(late, base, grp, "inner")
    label = F.when((F.col("_on") == 0) & (F.col("_i") == 1), "first").otherwise("update")
    upd = late.select(*grp, (F.col("_on") + F.col("_i")).alias("cnt"),
                      label.alias("firing"), F.col("_i").cast("int").alias("firing_seq"))
    return first.unionByName(upd)


def punctuated_watermark(df: DataFrame, ts: str, arrival, marker: str,
                         bucket_rows: int = 100_000) -> DataFrame:
    """T04 (replay form): the watermark only advances on marker rows; each
    row gets the watermark in force when it arrived (max marker ts before)."""
    mts = F.when(F.col(marker), F.unix_millis(F.col(ts).cast("timestamp")))
    d = df.withColumn("_m", mts)
    arrival = [arrival] if isinstance(arrival, str) else list(arrival)
    d = running(d, [], arrival, "_m", "max", "_wm",
                F.floor(F.col(arrival[0]) / bucket_rows), include_current=False)
    return d.withColumn("watermark", F.timestamp_millis(F.col("_wm"))).drop("_m", "_wm")


def with_ingestion_time(df: DataFrame, col: str = "proctime") -> DataFrame:
    """Stamp rows with the time they enter the job; windows over
    this column are processing-time windows."""
    return df.withColumn(col, F.current_timestamp())
