"""Event-time jobs over ``events``: windows, lateness, cascades and
time-bounded joins (T04, T09-T23, A13, J14-J18, J20)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import exact_sum
from ..operators import event_time as ET
from ..operators import joins as J
from ..operators.udf_windows import window_median
from ..sources.tables import events, to_ntz
from .derived import ARRIVAL_SQL, PROPS_K_SQL, arrival_order, props_k
from .registry import register

HOUR_US = 3_600_000_000


def _ev(spark, sf, *cols):
    return events(spark, sf, *cols)


def _bucket_sql(us: int, col: str = "ts") -> str:
    return f"make_timestamp((epoch_us({col}) // {us}) * {us})"


def t09_tumbling_counts(spark, sf):
    e = _ev(spark, sf, "ts", "event_type", "value")
    r = ET.tumbling(e, "ts", "1 hour", ["event_type"],
                    [F.count(F.lit(1)).alias("cnt"), exact_sum("value").alias("total")])
    return to_ntz(r, "window_start", "window_end")


register("t09_tumbling_counts", t09_tumbling_counts, f"""
SELECT event_type, {_bucket_sql(HOUR_US)} AS window_start, {_bucket_sql(HOUR_US)} + INTERVAL 1 HOUR AS window_end,
       COUNT(*) AS cnt, CAST(SUM(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total
FROM events GROUP BY ALL""")


def t11_sliding_counts(spark, sf):
    e = _ev(spark, sf, "ts", "event_type")
    r = ET.sliding(e, "ts", "1 hour", "10 minutes", ["event_type"], [F.count(F.lit(1)).alias("cnt")])
    return to_ntz(r, "window_start", "window_end")


register("t11_sliding_counts", t11_sliding_counts, """
WITH w AS (SELECT event_type, (epoch_us(ts) // 600000000) * 600000000 - i * 600000000 AS ws
           FROM events, range(0, 6) r(i))
SELECT event_type, make_timestamp(ws) AS window_start, make_timestamp(ws + 3600000000) AS window_end,
       COUNT(*) AS cnt FROM w GROUP BY ALL""")


def t12_session_windows(spark, sf):
    e = _ev(spark, sf, "event_id", "ts", "user_id", "value")
    r = ET.session_windows(e, "user_id", "ts", ["ts", "event_id"], 3 * 3600 * 1000,
                           [F.count(F.lit(1)).alias("cnt"), exact_sum("value").alias("total")])
    return to_ntz(r, "session_start", "session_end")


register("t12_session_windows", t12_session_windows, """
WITH l AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
s AS (SELECT *, SUM(CASE WHEN prev IS NULL OR epoch_us(ts) - epoch_us(prev) > 10800000000 THEN 1 ELSE 0 END)
                OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM l)
SELECT user_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL 3 HOUR AS session_end, COUNT(*) AS cnt,
       CAST(SUM(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total FROM s GROUP BY user_id, sid""")


def t13_count_window(spark, sf):
    e = _ev(spark, sf, "event_id", "ts", "user_id", "value") \
        .withColumn("v", F.col("value").cast("decimal(18,2)"))
    r = ET.count_window_sum(e, "user_id", ["ts", "event_id"], "v", 10, 5, "ts")
    return r.select("user_id", "row_count", F.col("sum_v").cast("double").alias("sum_value"))


register("t13_count_window", t13_count_window, """
SELECT user_id, row_count, sum_value FROM (
  SELECT user_id,
         ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS row_count,
         CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id ORDER BY ts, event_id
              ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS DOUBLE) AS sum_value
  FROM events) WHERE row_count % 5 = 0""")


def t14_window_all(spark, sf):
    e = _ev(spark, sf, "ts", "value")
    r = ET.tumbling(e, "ts", "1 hour", [], [F.count(F.lit(1)).alias("cnt"), F.max("value").alias("max_value")])
    return to_ntz(r, "window_start", "window_end")


register("t14_window_all", t14_window_all, f"""
SELECT {_bucket_sql(HOUR_US)} AS window_start, {_bucket_sql(HOUR_US)} + INTERVAL 1 HOUR AS window_end,
       COUNT(*) AS cnt, MAX(value) AS max_value FROM events GROUP BY ALL""")


def t16_window_last_and_volume(spark, sf):
    e = _ev(spark, sf, "event_id", "ts", "event_type", "value", "props").withColumn("volume", props_k())
    r = ET.window_reduce_last(e, "event_type", "ts", "1 hour", "value", "volume", "event_id")
    return to_ntz(r, "ts", "window_start", "window_end")


register("t16_window_last_and_volume", t16_window_last_and_volume, f"""
SELECT event_type, {_bucket_sql(HOUR_US)} AS window_start, {_bucket_sql(HOUR_US)} + INTERVAL 1 HOUR AS window_end,
       arg_max(value, (ts, event_id)) AS value, MAX(ts) AS ts, CAST(SUM({PROPS_K_SQL}) AS BIGINT) AS volume FROM events GROUP BY ALL""")


def t17_window_max_min(spark, sf):
    e = _ev(spark, sf, "ts", "event_type", "value")
    return to_ntz(ET.window_max_min(e, "event_type", "ts", "1 hour", "value"), "window_start", "window_end")


register("t17_window_max_min", t17_window_max_min, f"""
SELECT event_type, {_bucket_sql(HOUR_US)} AS window_start, {_bucket_sql(HOUR_US)} + INTERVAL 1 HOUR AS window_end,
       MAX(value) AS max_value, MIN(value) AS min_value FROM events GROUP BY ALL""")


def t18_full_window_function(spark, sf):
    e = _ev(spark, sf, "ts", "event_type", "value")
    return to_ntz(window_median(e, "event_type", "ts", "1 hour", "value"), "window_start", "window_end")


register("t18_full_window_function", t18_full_window_function, f"""
SELECT event_type, {_bucket_sql(HOUR_US)} AS window_start, {_bucket_sql(HOUR_US)} + INTERVAL 1 HOUR AS window_end,
       median(value) AS median_value, COUNT(*) AS cnt FROM events GROUP BY ALL""")


def t19_window_keep_first(spark, sf):
    e = arrival_order(_ev(spark, sf, "event_id", "ts", "event_type", "value"))
    w = F.window("ts", "1 hour")
    r = e.groupBy("event_type", w.alias("w")).agg(
        F.min_by(F.struct("event_id", "value"), F.struct("arrival", "event_id")).alias("r"))
    r = r.select("event_type", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                 "r.event_id", "r.value")
    return to_ntz(r, "window_start", "window_end")


register("t19_window_keep_first", t19_window_keep_first, f"""
SELECT event_type, {_bucket_sql(HOUR_US)} AS window_start, {_bucket_sql(HOUR_US)} + INTERVAL 1 HOUR AS window_end,
       arg_min(event_id, ({ARRIVAL_SQL}, event_id)) AS event_id, arg_min(value, ({ARRIVAL_SQL}, event_id)) AS value
FROM events GROUP BY ALL""")


def t20_cascaded_windows(spark, sf):
    e = _ev(spark, sf, "ts", "event_type")
    r = ET.cascade(e, "ts", "10 minutes", "30 minutes", ["event_type"])
    return to_ntz(r, "window_start", "window_end")


register("t20_cascaded_windows", t20_cascaded_windows, """
WITH a AS (SELECT event_type, (epoch_us(ts) // 600000000) * 600000000 + 600000000 - 1 AS rowtime, COUNT(*) AS c
           FROM events GROUP BY ALL)
SELECT event_type, make_timestamp((rowtime // 1800000000) * 1800000000) AS window_start,
       make_timestamp((rowtime // 1800000000) * 1800000000 + 1800000000) AS window_end, CAST(SUM(c) AS BIGINT) AS cnt
FROM a GROUP BY ALL""")

DELAY_MS = 600_000
LATENESS_MS = 1_200_000


def _classified(spark, sf):
    e = arrival_order(_ev(spark, sf, "event_id", "ts", "event_type"))
    return ET.classify_lateness(e, "ts", ["arrival", "event_id"], "1 hour", DELAY_MS, LATENESS_MS)


_CLASSIFIED_SQL = f"""
WITH a AS (SELECT *, {ARRIVAL_SQL} AS arrival, epoch_us(ts) // 1000 AS tms,
                  (epoch_us(ts) // {HOUR_US}) * {HOUR_US} AS ws FROM events),
b AS (SELECT *, MAX(tms) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM a),
c AS (SELECT *, CASE WHEN pm IS NULL OR (ws + {HOUR_US}) // 1000 > pm - {DELAY_MS} THEN 'on_time'
                     WHEN (ws + {HOUR_US}) // 1000 + {LATENESS_MS} > pm - {DELAY_MS} THEN 'late'
                     ELSE 'dropped' END AS lateness,
                make_timestamp(ws) AS window_start, make_timestamp(ws + {HOUR_US}) AS window_end FROM b)"""


def t21_on_time_window_counts(spark, sf):
    c = ET.drop_late(_classified(spark, sf))
    r = c.groupBy("event_type", "window_start", "window_end").agg(F.count(F.lit(1)).alias("cnt"))
    return to_ntz(r, "window_start", "window_end")


register("t21_on_time_window_counts", t21_on_time_window_counts, _CLASSIFIED_SQL + """
SELECT event_type, window_start, window_end, COUNT(*) AS cnt FROM c WHERE lateness = 'on_time' GROUP BY ALL""")


def t22_late_side_output(spark, sf):
    c = ET.late_side_output(_classified(spark, sf))
    return to_ntz(c.select("event_id", "event_type", "ts", "lateness"), "ts")


register("t22_late_side_output", t22_late_side_output, _CLASSIFIED_SQL + """
SELECT event_id, event_type, ts, lateness FROM c WHERE lateness <> 'on_time'""")


def t23_allowed_lateness_firings(spark, sf):
    r = ET.allowed_lateness_firings(_classified(spark, sf), "event_type", ["arrival", "event_id"])
    return to_ntz(r, "window_start", "window_end")


register("t23_allowed_lateness_firings", t23_allowed_lateness_firings, _CLASSIFIED_SQL + """,
base AS (SELECT event_type, window_start, window_end, CAST(SUM(CASE WHEN lateness = 'on_time' THEN 1 ELSE 0 END) AS BIGINT) AS on_cnt
         FROM c GROUP BY ALL),
late AS (SELECT c.event_type, c.window_start, c.window_end,
                ROW_NUMBER() OVER (PARTITION BY c.event_type, c.window_start, c.window_end ORDER BY arrival, event_id) AS i
         FROM c WHERE lateness = 'late')
SELECT event_type, window_start, window_end, on_cnt AS cnt, 'first' AS firing, 0 AS firing_seq FROM base WHERE on_cnt > 0
UNION ALL
SELECT l.event_type, l.window_start, l.window_end, b.on_cnt + l.i AS cnt,
       CASE WHEN b.on_cnt = 0 AND l.i = 1 THEN 'first' ELSE 'update' END AS firing, CAST(l.i AS INTEGER) AS firing_seq
FROM late l JOIN base b USING (event_type, window_start, window_end)""")


def t04_punctuated_watermark(spark, sf):
    e = arrival_order(_ev(spark, sf, "event_id", "ts", "event_type")) \
        .withColumn("is_marker", F.col("event_type") == "signup")
    r = ET.punctuated_watermark(e, "ts", ["arrival", "event_id"], "is_marker")
    return to_ntz(r.select("event_id", "watermark"), "watermark")


register("t04_punctuated_watermark", t04_punctuated_watermark, f"""
SELECT event_id, make_timestamp(1000 * MAX(CASE WHEN event_type = 'signup' THEN epoch_us(ts) // 1000 END) OVER (
  ORDER BY {ARRIVAL_SQL}, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS watermark FROM events""")


def a13_ohlc_vwap(spark, sf):
    e = _ev(spark, sf, "event_id", "ts", "event_type", "value", "props").withColumn("k", props_k())
    w = F.window("ts", "1 hour")
    at = F.struct("ts", "event_id")
    pv = F.col("value").cast("decimal(18,2)") * F.col("k")
    r = e.groupBy("event_type", w.start.alias("window_start")).agg(
        F.min_by("value", at).alias("open"), F.max("value").alias("high"),
        F.min("value").alias("low"), F.max_by("value", at).alias("close"),
        (exact_sum(pv) / F.nullif(F.sum("k"), F.lit(0))).alias("vwap"))
    return to_ntz(r, "window_start")


register("a13_ohlc_vwap", a13_ohlc_vwap, f"""
SELECT event_type, {_bucket_sql(HOUR_US)} AS window_start, arg_min(value, (ts, event_id)) AS open, MAX(value) AS high,
       MIN(value) AS low, arg_max(value, (ts, event_id)) AS close,
       CAST(SUM(CAST(CAST(value AS DECIMAL(18,2)) * {PROPS_K_SQL} AS DECIMAL(18,4))) AS DOUBLE) / NULLIF(SUM({PROPS_K_SQL}), 0) AS vwap
FROM events GROUP BY ALL""")


# ------------------------------------------------------------ time joins ---
def _side(spark, sf, etype, prefix):
    e = _ev(spark, sf, "event_id", "ts", "user_id", "event_type", "value") \
        .filter(F.col("event_type") == etype)
    return e.select(F.col("event_id").alias(f"{prefix}_id"), F.col("ts").alias(f"{prefix}_ts"),
                    F.col("user_id").alias(f"{prefix}_user"), F.col("value").alias(f"{prefix}_value"))


def j14_time_window_join(spark, sf):
    """``p.ts BETWEEN v.ts AND v.ts + INTERVAL 1 HOUR``."""
    v, p = _side(spark, sf, "view", "v"), _side(spark, sf, "purchase", "p")
    r = J.interval_join(v, p, "v_user", "p_user", "v_ts", "p_ts", 0, 3_600_000)
    return r.select(F.col("v_id").alias("view_id"), F.col("p_id").alias("purchase_id"))


register("j14_time_window_join", j14_time_window_join, """
SELECT v.event_id AS view_id, p.event_id AS purchase_id FROM events v JOIN events p
  ON v.user_id = p.user_id AND p.ts BETWEEN v.ts AND v.ts + INTERVAL 1 HOUR
WHERE v.event_type = 'view' AND p.event_type = 'purchase'""")


def j15_interval_join(spark, sf):
    c, e = _side(spark, sf, "click", "c"), _side(spark, sf, "error", "e")
    r = J.interval_join(c, e, "c_user", "e_user", "c_ts", "e_ts", -300_000, 600_000)
    return r.select(F.col("c_id").alias("click_id"), F.col("e_id").alias("error_id"))


register("j15_interval_join", j15_interval_join, """
SELECT c.event_id AS click_id, e.event_id AS error_id FROM events c JOIN events e
  ON c.user_id = e.user_id AND e.ts >= c.ts - INTERVAL 5 MINUTE AND e.ts <= c.ts + INTERVAL 10 MINUTE
WHERE c.event_type = 'click' AND e.event_type = 'error'""")


def j16_asof_join(spark, sf):
    p, s = _side(spark, sf, "purchase", "p"), _side(spark, sf, "signup", "s")
    r = J.asof_join(p, s, "p_user", "s_user", "p_ts", "s_ts")
    return r.select(F.col("p_id").alias("purchase_id"), F.col("s_id").alias("version_id"),
                    F.col("s_value").alias("price"))


register("j16_asof_join", j16_asof_join, """
SELECT p.event_id AS purchase_id, s.event_id AS version_id, s.value AS price
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF JOIN (SELECT * FROM events WHERE event_type = 'signup') s ON p.user_id = s.user_id AND p.ts >= s.ts""")


def j17_window_join(spark, sf):
    c, p = _side(spark, sf, "click", "c"), _side(spark, sf, "purchase", "p")
    r = J.window_join(c, p, "c_user", "p_user", "c_ts", "p_ts", "1 hour")
    return to_ntz(r.select(F.col("c_id").alias("click_id"), F.col("p_id").alias("purchase_id"),
                           "window_start"), "window_start")


register("j17_window_join", j17_window_join, f"""
SELECT c.event_id AS click_id, p.event_id AS purchase_id, {_bucket_sql(HOUR_US, 'c.ts')} AS window_start
FROM events c JOIN events p ON c.user_id = p.user_id
  AND epoch_us(c.ts) // {HOUR_US} = epoch_us(p.ts) // {HOUR_US}
WHERE c.event_type = 'click' AND p.event_type = 'purchase'""")


def j18_window_cogroup(spark, sf):
    e = _ev(spark, sf, "ts", "user_id", "event_type", "value")
    c = e.filter(F.col("event_type") == "click")
    p = e.filter(F.col("event_type") == "purchase")
    r = J.window_cogroup(c, p, "user_id", "ts", "1 hour", "value")
    r = r.select("user_id", F.col("window.start").alias("window_start"),
                 F.sort_array("left_values").alias("click_values"),
                 F.sort_array("right_values").alias("purchase_values"))
    return to_ntz(r, "window_start")


register("j18_window_cogroup", j18_window_cogroup, f"""
SELECT user_id, {_bucket_sql(HOUR_US)} AS window_start,
       COALESCE(list_sort(list(value) FILTER (WHERE event_type = 'click')), []::DOUBLE[]) AS click_values,
       COALESCE(list_sort(list(value) FILTER (WHERE event_type = 'purchase')), []::DOUBLE[]) AS purchase_values
FROM events WHERE event_type IN ('click', 'purchase') GROUP BY ALL""")


def j20_latest_status(spark, sf):
    p = _side(spark, sf, "purchase", "p")
    s = _ev(spark, sf, "ts", "user_id", "event_type", "value").filter(F.col("event_type") == "error") \
        .select(F.col("user_id").alias("p_user"), F.col("ts").alias("p_ts"), F.col("value").alias("status"))
    r = J.latest_value_enrich(p, s, "p_user", "p_ts", "status")
    return r.select(F.col("p_id").alias("purchase_id"), "status")


register("j20_latest_status", j20_latest_status, """
SELECT p.event_id AS purchase_id, s.value AS status
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF JOIN (SELECT * FROM events WHERE event_type = 'error') s ON p.user_id = s.user_id AND p.ts >= s.ts""")
