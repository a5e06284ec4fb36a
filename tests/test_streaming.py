"""Stream-equals-batch: the streaming form of each stateful operator gives
the batch result on the same input."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from streamlake.plans.state_jobs import letter_col
from streamlake.streaming import jobs as SJ
from streamlake.streaming.runner import enable_state_store, run_to_memory, stream_events

from conftest import SF_SMALL, ordered_files


@pytest.fixture(scope="module")
def ordered(spark, tmp_path_factory):
    return ordered_files(spark, tmp_path_factory)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_state_machine_stream_equals_batch(spark):
    """[U05]"""
    enable_state_store(spark)
    s = run_to_memory(SJ.state_machine_stream(stream_events(spark, SF_SMALL), letter_col()), "u05s")
    b = E.queries()["u05_state_machine_alerts"](spark, SF_SMALL)
    assert _rows(s.select("user_id", "event_id", "state", "evt")) == _rows(b.select("user_id", "event_id", "state", "evt"))


def test_retract_stream_equals_batch(spark):
    """[K11 K12]"""
    enable_state_store(spark)
    s = run_to_memory(SJ.retract_count_stream(stream_events(spark, SF_SMALL)), "k11s")
    b = E.queries()["k11_retract_changelog"](spark, SF_SMALL)
    cols = ["is_add", "event_type", "value", "event_id", "seq"]
    assert _rows(s.select(*cols)) == _rows(b.select(*cols))


def test_latest_status_stream_equals_batch(spark):
    """[J20 J24]"""
    enable_state_store(spark)
    s = run_to_memory(SJ.latest_status_stream(stream_events(spark, SF_SMALL), "purchase", "error"), "j20s")
    b = E.queries()["j20_latest_status"](spark, SF_SMALL)
    assert _rows(s) == _rows(b.select("purchase_id", "status"))


def test_rise_alerts_stream_equals_batch_until_watermark(spark):
    """[U01]"""
    enable_state_store(spark)
    ev = stream_events(spark, SF_SMALL)
    s = run_to_memory(SJ.rise_alerts_stream(ev, 3_600_000), "u01s")
    b = E.queries()["u01_rise_alerts"](spark, SF_SMALL)
    max_ms = spark.read.parquet(f"{SF_SMALL}/events.parquet").agg(
        F.max(F.unix_millis(F.col("ts").cast("timestamp")))).first()[0]
    bb = b.select("user_id", F.unix_millis(F.col("alert_time").cast("timestamp")).alias("alert_ms")) \
          .filter(F.col("alert_ms") <= max_ms)
    ss = s.filter(F.col("alert_ms") <= max_ms)
    assert _rows(ss) == _rows(bb)


def test_windowed_counts_stream_equals_batch_cut(spark):
    """[T09 T01 T08 T21]"""
    s = run_to_memory(SJ.windowed_counts_stream(stream_events(spark, SF_SMALL), "1 hour", "5 seconds"), "t09s")
    b = E.queries()["t09_tumbling_counts"](spark, SF_SMALL)
    max_ts = spark.read.parquet(f"{SF_SMALL}/events.parquet").agg(F.max(F.col("ts").cast("timestamp"))).first()[0]
    import datetime
    cut = max_ts - datetime.timedelta(seconds=5)
    bb = b.filter(F.col("window_end").cast("timestamp") <= F.lit(cut)).select(
        "event_type", F.col("window_start").cast("timestamp"), F.col("window_end").cast("timestamp"), "cnt")
    assert _rows(s) == _rows(bb)


def test_map_state_stream_equals_batch(spark):
    """[U02 A20]"""
    enable_state_store(spark)
    s = run_to_memory(SJ.behavior_counts_stream(stream_events(spark, SF_SMALL)), "u02s")
    b = E.queries()["a20_count_per_user_behavior"](spark, SF_SMALL)
    cols = ["event_id", "user_id", "event_type", "cnt"]
    assert _rows(s.select(*cols)) == _rows(b.select(*cols))


def test_top_speed_stream_equals_batch(spark, ordered):
    """[T15]"""
    enable_state_store(spark)
    from streamlake.plans.trigger_jobs import T15_EVICT_MS, T15_THRESHOLD
    from streamlake.streaming.runner import run_with_progress, stream_parquet
    s, progress = run_with_progress(SJ.top_speed_stream(stream_parquet(spark, ordered, max_files=1),
                                                        T15_THRESHOLD, T15_EVICT_MS), "t15s")
    b = E.queries()["t15_delta_trigger_top_speed"](spark, SF_SMALL).select(
        "user_id", F.unix_micros(F.col("fire_time").cast("timestamp")).alias("fire_us"),
        "fire_id", "max_id", "max_speed")
    assert _rows(s.filter("user_id >= 0")) == _rows(b)
    assert len(progress) >= 5


def test_price_drop_stream_equals_batch(spark, ordered):
    """[T25] Every window of every key, the last ones included: a timer ends them."""
    enable_state_store(spark)
    from streamlake.streaming.runner import run_with_progress, stream_parquet
    rows = stream_parquet(spark, ordered, max_files=1)
    s, progress = run_with_progress(SJ.price_drop_stream(rows, 3600, 600), "t25s")
    b = E.queries()["t25_price_drop_trigger"](spark, SF_SMALL).select(
        F.col("event_type").alias("key"), F.unix_micros(F.col("window_start").cast("timestamp")).alias("ws"),
        F.unix_micros(F.col("fire_time").cast("timestamp")).alias("fire_us"), "reason", "n", "avg_price")
    assert _rows(s.filter(F.col("ws") < _end_us(spark))) == _rows(b)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in progress]
    assert held[-1] <= 6 < max(held)  # what is left are the windows of the rows that move the watermark


def test_cogroup_fire_stream_equals_batch(spark, ordered):
    """[J19 J18]"""
    enable_state_store(spark)
    from streamlake.streaming.runner import run_with_progress, stream_parquet
    rows = stream_parquet(spark, ordered, max_files=1)
    s, progress = run_with_progress(SJ.cogroup_fire_stream(rows), "j19s")
    b = E.queries()["j19_cogroup_early_fire"](spark, SF_SMALL).withColumnRenamed("window_start", "ws") \
        .withColumn("ws", F.col("ws").cast("timestamp"))
    cols = ["user_id", "ws", "fire_seq", "trigger", "n_left", "n_right", "sum_left", "sum_right"]
    plain = lambda df: sorted((tuple(r) for r in df.select(*cols).collect() if r["user_id"] >= 0), key=str)
    assert plain(s) == plain(b)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in progress]
    assert held[-1] <= 2 < max(held)


def _end_us(spark):
    return int((_max_ts(spark).timestamp() + 3600) * 1_000_000)


def test_lateness_stream_against_batch_watermarks(spark, tmpdir_path):
    """[T21 T22 T23 U06] Arrival-ordered files, one per micro-batch: a row is late when its
    window ended before the watermark of its batch (max event time of the
    earlier batches minus the delay)."""
    from streamlake.plans.derived import arrival_order
    from streamlake.streaming.runner import stream_parquet
    enable_state_store(spark)
    e = arrival_order(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    rows = sorted(e.select("arrival", "event_id", "ts", "event_type").collect(), key=lambda r: (r.arrival, r.event_id))
    n = 10
    chunks = [rows[i * len(rows) // n:(i + 1) * len(rows) // n] for i in range(n)]
    for i, c in enumerate(chunks):
        spark.createDataFrame(c, e.select("arrival", "event_id", "ts", "event_type").schema) \
            .coalesce(1).write.parquet(f"{tmpdir_path}/in/part{i:02d}")
    import glob, shutil, os
    os.makedirs(f"{tmpdir_path}/flat")
    for i in range(n):
        f = glob.glob(f"{tmpdir_path}/in/part{i:02d}/*.parquet")[0]
        shutil.copy(f, f"{tmpdir_path}/flat/{i:02d}.parquet")
        os.utime(f"{tmpdir_path}/flat/{i:02d}.parquet", (1_000_000 + i, 1_000_000 + i))
    st = stream_parquet(spark, f"{tmpdir_path}/flat", max_files=1).withColumn("ts", F.col("ts").cast("timestamp"))
    out = {r.event_id: r.lateness for r in run_to_memory(
        SJ.lateness_stream(st, 3_600_000, "10 minutes", 1_200_000), "t22s").collect()}
    import datetime
    epoch = datetime.datetime(1970, 1, 1)
    ms = lambda t: int((t - epoch).total_seconds() * 1000)
    exp, seen_max = {}, None
    for c in chunks:
        wm = (seen_max - 600_000) if seen_max is not None else 0
        for r in c:
            end = (ms(r.ts) // 3_600_000 + 1) * 3_600_000
            exp[r.event_id] = ("on_time" if wm <= 0 or end > wm else
                               "late" if end + 1_200_000 > wm else "dropped")
        seen_max = max([seen_max or 0] + [ms(r.ts) for r in c])
    assert sum(v != "on_time" for v in exp.values()) > 0
    assert out == exp


def _max_ts(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet").agg(F.max(F.col("ts").cast("timestamp"))).first()[0]


def test_sliding_stream_equals_batch_cut(spark):
    """[T11]"""
    import datetime
    s = run_to_memory(SJ.sliding_counts_stream(stream_events(spark, SF_SMALL), "1 hour", "10 minutes",
                                               "5 seconds"), "t11s")
    cut = _max_ts(spark) - datetime.timedelta(seconds=5)
    b = E.queries()["t11_sliding_counts"](spark, SF_SMALL)
    bb = b.select("event_type", F.col("window_start").cast("timestamp"), F.col("window_end").cast("timestamp"),
                  "cnt").filter(F.col("window_end") <= F.lit(cut))
    assert _rows(s) == _rows(bb)


def test_sessions_stream_equals_batch_cut(spark):
    """[T12 T02]"""
    import datetime
    s = run_to_memory(SJ.sessions_stream(stream_events(spark, SF_SMALL), "3 hours", "5 seconds"), "t12s")
    cut = _max_ts(spark) - datetime.timedelta(seconds=5)
    b = E.queries()["t12_session_windows"](spark, SF_SMALL)
    bb = b.select("user_id", F.col("session_start").cast("timestamp"), F.col("session_end").cast("timestamp"),
                  "cnt").filter(F.col("session_end") <= F.lit(cut))
    assert _rows(s) == _rows(bb)


def test_periodic_watermark_stream(spark):
    """[T03] bounded-delay watermark advanced on a periodic processing-time trigger."""
    from streamlake.streaming.runner import run_until_idle
    df, trigger = SJ.periodic_watermark_stream(stream_events(spark, SF_SMALL), "1 minute", "1 second", "1 hour")
    assert trigger == {"processingTime": "1 second"}
    s = run_until_idle(df, "t03s", every=trigger["processingTime"])
    assert s.count() > 0


def test_ttl_counts_stream(spark):
    """[T26] per-key counts kept in TTL'd state (processing time)."""
    from streamlake.streaming.runner import run_until_consumed
    enable_state_store(spark)
    n = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    s = run_until_consumed(SJ.ttl_counts_stream(stream_events(spark, SF_SMALL), "event_type", 3_600_000),
                           "t26s", n)
    b = spark.read.parquet(f"{SF_SMALL}/events.parquet").groupBy(F.col("event_type").alias("key")).count()
    got = {r.key: r.cnt for r in s.groupBy("key").agg(F.max("cnt").alias("cnt")).collect()}
    assert got == {r.key: r["count"] for r in b.collect()}
