"""Property tests: bucketed two-level algorithms equal brute force on
generated data with tiny buckets (many boundaries, ties, gaps)."""

import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from streamlake.operators import joins as J
from streamlake.operators import running as RN
from streamlake.operators.event_time import count_window_sum, session_ids

EPOCH = datetime.datetime(2024, 1, 1)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

rows_st = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 40), st.integers(-5, 9)),
                   min_size=1, max_size=30)


def _df(spark, rows):
    data = [(i, k, EPOCH + datetime.timedelta(seconds=t), v) for i, (k, t, v) in enumerate(rows)]
    return spark.createDataFrame(data, "id long, k long, ts timestamp, v long")


def _ordered(rows):
    return sorted(((k, t, i, v) for i, (k, t, v) in enumerate(rows)), key=lambda r: (r[0], r[1], r[2]))


@SETTINGS
@given(rows=rows_st, include=st.booleans(), kind=st.sampled_from(["sum", "max"]))
def test_running_matches_brute_force(spark, rows, include, kind):
    """[A03 W02 W03]"""
    df = _df(spark, rows)
    r = RN.running(df, ["k"], ["ts", "id"], "v", kind, "out", RN.time_bucket("ts", 7), include)
    got = {x.id: x.out for x in r.collect()}
    exp, acc = {}, {}
    for k, t, i, v in _ordered(rows):
        prev = acc.get(k)
        cur = (v if prev is None else (prev + v if kind == "sum" else max(prev, v)))
        exp[i] = cur if include else (prev if kind == "max" else (prev or 0))
        acc[k] = cur
    assert got == exp


@SETTINGS
@given(rows=rows_st)
def test_bucketed_lag_matches_brute_force(spark, rows):
    """[W01]"""
    df = _df(spark, rows)
    r = RN.lag_bucketed(df, ["k"], ["ts", "id"], "v", "prev", RN.time_bucket("ts", 5))
    got = {x.id: x.prev for x in r.collect()}
    exp, last = {}, {}
    for k, t, i, v in _ordered(rows):
        exp[i] = last.get(k)
        last[k] = v
    assert got == exp


@SETTINGS
@given(probes=rows_st, versions=rows_st, bucket=st.sampled_from([3, 10, 86400]))
def test_asof_join_matches_brute_force(spark, probes, versions, bucket):
    """[J16 J20]"""
    p = _df(spark, probes).select(F.col("id").alias("pid"), F.col("k").alias("pk"), F.col("ts").alias("pts"))
    v = _df(spark, versions).select(F.col("id").alias("vid"), F.col("k").alias("vk"), F.col("ts").alias("vts"))
    r = J.asof_join(p, v, "pk", "vk", "pts", "vts", bucket_seconds=bucket, version_order="vid")
    got = sorted((x.pid, x.vid) for x in r.collect())
    exp = []
    for i, (k, t, _) in enumerate(probes):
        cands = [(tv, j) for j, (kv, tv, _) in enumerate(versions) if kv == k and tv <= t]
        if cands:
            exp.append((i, max(cands)[1]))
    assert got == sorted(exp)


@SETTINGS
@given(left=rows_st, right=rows_st, lo=st.integers(-6, 0), hi=st.integers(0, 6),
       lo_inc=st.booleans(), hi_inc=st.booleans())
def test_interval_join_matches_brute_force(spark, left, right, lo, hi, lo_inc, hi_inc):
    """[J14 J15]"""
    a = _df(spark, left).select(F.col("id").alias("aid"), F.col("k").alias("ak"), F.col("ts").alias("ats"))
    b = _df(spark, right).select(F.col("id").alias("bid"), F.col("k").alias("bk"), F.col("ts").alias("bts"))
    r = J.interval_join(a, b, "ak", "bk", "ats", "bts", lo * 1000, hi * 1000, lo_inc, hi_inc)
    got = sorted((x.aid, x.bid) for x in r.collect())
    exp = sorted((i, j) for i, (ka, ta, _) in enumerate(left) for j, (kb, tb, _) in enumerate(right)
                 if ka == kb and (tb >= ta + lo if lo_inc else tb > ta + lo)
                 and (tb <= ta + hi if hi_inc else tb < ta + hi))
    assert got == exp


@SETTINGS
@given(rows=rows_st, gap=st.integers(1, 6))
def test_sessions_match_brute_force(spark, rows, gap):
    """[T12]"""
    df = _df(spark, rows)
    r = session_ids(df, "k", "ts", ["ts", "id"], gap * 1000, bucket_seconds=4)
    got = {x.id: x.session_id for x in r.collect()}
    exp, state = {}, {}
    for k, t, i, v in _ordered(rows):
        prev_t, sid = state.get(k, (None, 0))
        if prev_t is None or t - prev_t > gap:
            sid += 1
        exp[i] = sid
        state[k] = (t, sid)
    assert got == exp


@SETTINGS
@given(rows=rows_st, size=st.integers(1, 5), slide=st.integers(1, 4))
def test_count_window_matches_brute_force(spark, rows, size, slide):
    """[T13]"""
    from streamlake.operators.event_time import count_window_sum
    df = _df(spark, rows)
    r = count_window_sum(df, "k", ["ts", "id"], "v", size, slide, "ts", bucket_seconds=6)
    got = sorted((x.k, x.row_count, x.sum_v) for x in r.collect())
    exp, seen = [], {}
    for k, t, i, v in _ordered(rows):
        seen.setdefault(k, []).append(v)
        n = len(seen[k])
        if n % slide == 0:
            exp.append((k, n, sum(seen[k][-size:])))
    assert got == sorted(exp)


@SETTINGS
@given(rows=rows_st)
def test_running_distinct_matches_brute_force(spark, rows):
    """[W04]"""
    df = _df(spark, rows)
    r = RN.running_distinct(df, "v", ["ts", "id"], "id", "uv", "ts", bucket_seconds=5)
    got = {x.id: x.uv for x in r.collect()}
    exp, seen = {}, set()
    for t, i, v in sorted(((t, i, v) for i, (k, t, v) in enumerate(rows))):
        seen.add(v)
        exp[i] = len(seen)
    assert got == exp


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 1), st.integers(0, 60), st.integers(0, 9)), min_size=1, max_size=30),
       delay=st.integers(0, 8), lateness=st.integers(0, 8))
def test_lateness_matches_brute_force(spark, rows, delay, lateness):
    """[T21 T22 T23]"""
    from streamlake.operators.event_time import classify_lateness
    data = [(i, k, EPOCH + datetime.timedelta(seconds=t), a) for i, (k, t, a) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, k long, ts timestamp, arrival long")
    r = classify_lateness(df, "ts", ["arrival", "id"], "10 seconds", delay * 1000, lateness * 1000, bucket_rows=3)
    got = {x.id: x.lateness for x in r.collect()}
    exp, prev_max = {}, None
    base = int((EPOCH - datetime.datetime(1970, 1, 1)).total_seconds()) * 1000
    for a, i, t in sorted((a, i, t) for i, (k, t, a) in enumerate(rows)):
        end = ((base + t * 1000) // 10_000 + 1) * 10_000
        wm = None if prev_max is None else prev_max - delay * 1000
        exp[i] = ("on_time" if wm is None or end > wm else "late" if end + lateness * 1000 > wm else "dropped")
        prev_max = max(prev_max or 0, base + t * 1000)
    assert got == exp


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 2), st.sampled_from(list("abcdefgx"))), min_size=1, max_size=40),
       block=st.integers(1, 5))
def test_state_machine_blocks_match_model(spark, rows, block):
    """[U05] composed block functions give the sequential fold's alerts."""
    from streamlake.operators import stateful as ST
    data = [(k, i, EPOCH + datetime.timedelta(seconds=i), e) for i, (k, e) in enumerate(rows)]
    df = spark.createDataFrame(data, "k long, id long, ts timestamp, evt string")
    got = sorted(tuple(r) for r in ST.state_machine_alerts(df, "k", ["ts", "id"], "evt", "id",
                                                           block_rows=block, bucket_seconds=3).collect())
    exp, state = [], {}
    for i, (k, e) in enumerate(rows):
        new, alert = ST.state_machine_step(state.get(k), e)
        if alert:
            exp.append((k, i, state.get(k) or "Initial", e))
        state[k] = new
    assert got == sorted(exp)


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 1), st.integers(0, 30), st.integers(0, 3)), min_size=1, max_size=30),
       interval=st.integers(1, 8))
def test_segmented_rise_alerts_match_fold(spark, rows, interval):
    """[U01] the reset-segmented form equals the sequential fold."""
    from streamlake.operators import stateful as ST
    data = [(k, i, EPOCH + datetime.timedelta(seconds=t), float(v)) for i, (k, t, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k long, id long, ts timestamp, v double")
    a = ST.rise_alerts(df, "k", "ts", "v", ["ts", "id"], interval_ms=interval * 1000).select("k", "alert_ms")
    b = ST.rise_alerts_segmented(df, "k", "ts", "v", ["ts", "id"], interval_ms=interval * 1000,
                                 bucket_seconds=5).select("k", "alert_ms")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


# balanced ranges

@st.composite
def skewed_times(draw):
    """Rows with a stray timestamp, a burst of a third at one instant, nulls."""
    n = draw(st.integers(60, 150))
    times = draw(st.lists(st.integers(0, 5000), min_size=n, max_size=n))
    for k in range(n // 3):
        times[k] = 777
    times[-1] = -1_700_000_000
    return times


@settings(SETTINGS, max_examples=6)
@given(skewed_times(), st.integers(5, 15))
def test_ranges_are_balanced_and_monotone(spark, times, rows):
    """[W02 A03] a burst and a stray timestamp are cut as finely as their rows need"""
    from streamlake.operators.ranges import order_range
    df = spark.createDataFrame([(k, datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=t) if k % 17 else None)
                                for k, t in enumerate(times)], "id long, ts timestamp")
    got = df.withColumn("r", order_range(df, ["ts", "id"], rows)).collect()
    got.sort(key=lambda r: (r["ts"] is not None, r["ts"] or datetime.datetime.min, r["id"]))
    numbers = [r["r"] for r in got]
    assert numbers == sorted(numbers)
    sizes = sorted(numbers.count(x) for x in set(numbers))
    assert sizes[-1] < 2 * max(sizes[len(sizes) // 2], 2) and len(sizes) >= len(times) // rows


def test_stray_timestamp_and_burst_keep_tasks_even(spark, monkeypatch):
    """[W02 W03 A03 T12 J16] results as before, with ranges of 40 rows"""
    from streamlake.operators import ranges
    rows = [(k, k % 3, datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=100 if k < 200 else k), (k * 7) % 50)
            for k in range(600)] + [(600, 1, datetime.datetime(1970, 1, 1), 5), (601, 1, datetime.datetime(9999, 1, 1), 6)]
    df = spark.createDataFrame(rows, "id long, k int, ts timestamp, v long")
    calls = lambda: [
        sorted(map(tuple, RN.running_count(df, [], ["ts", "id"], "n", "ts").collect())),
        sorted(map(tuple, RN.running_max(df, ["k"], ["ts", "id"], "v", "m", "ts").collect())),
        sorted(map(tuple, RN.running_distinct(df, "v", ["ts", "id"], "id", "d", "ts").collect())),
        sorted(map(tuple, RN.sliding_rows_sum(df, "k", ["ts", "id"], "v", "s", 1, "ts").collect())),
        sorted(map(tuple, session_ids(df, "k", "ts", ["ts", "id"], 5000).collect())),
        sorted(map(tuple, count_window_sum(df, "k", ["ts", "id"], "v", 4, 2, "ts").collect())),
        sorted(map(tuple, J.asof_join(df.select("id", "k", "ts"), df.filter("v % 5 = 0").select(
            F.col("id").alias("vid"), F.col("k").alias("vk"), F.col("ts").alias("vts")), "k", "vk", "ts", "vts",
            version_order="vid").collect()))]
    whole = calls()
    monkeypatch.setattr(ranges, "ROWS_PER_RANGE", 40)
    assert calls() == whole
    sizes = sorted(r["count"] for r in df.groupBy(ranges.order_range(df, ["ts", "id"]).alias("r")).count().collect())
    assert len(sizes) >= 14 and sizes[-1] < 2 * sizes[len(sizes) // 2]
    same = df.select("id", F.lit(datetime.datetime(2024, 1, 1)).alias("ts"))  # all rows at one instant
    sizes = sorted(r["count"] for r in same.groupBy(ranges.order_range(same, ["ts", "id"]).alias("r")).count().collect())
    assert len(sizes) >= 14 and sizes[-1] < 2 * sizes[len(sizes) // 2]


@settings(SETTINGS, max_examples=5)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 60), st.integers(0, 30)), min_size=1, max_size=60),
       st.integers(0, 70), st.booleans())
def test_delta_fires_by_jumps_equal_the_scan(spark, rows, threshold, falls):
    """[T15] keys over the bound spread over tasks; one whose distance falls is scanned"""
    from streamlake.operators.stateful import keyed_scan
    from streamlake.operators.triggers import DeltaTriggerFold, _delta_fires
    total, data = {}, []
    for i, (k, t, step) in enumerate(sorted(rows, key=lambda r: r[1])):
        total[k] = total.get(k, 0) + (-step if falls and k == 1 else step)
        data.append((k, t, i, total[k]))
    d = spark.createDataFrame(data, "key int, ts_us long, row_id long, distance long")
    schema = "key int, fire_us long, fire_id long"
    want = keyed_scan(d, "key", ["ts_us", "row_id"], lambda: DeltaTriggerFold(threshold), schema)
    assert sorted(map(tuple, _delta_fires(d, threshold, schema, 2).collect())) == sorted(map(tuple, want.collect()))
