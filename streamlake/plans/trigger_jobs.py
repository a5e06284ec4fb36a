"""Registered trigger/evictor and model jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import exact_avg
from ..operators import joins as J
from ..operators import running as RN
from ..operators import triggers as TR
from ..sources.tables import events, to_ntz
from .registry import register

HOUR_US = 3_600_000_000


def j19_cogroup_early_fire(spark, sf):
    e = events(spark, sf, "event_id", "ts", "user_id", "event_type", "value")
    left = e.filter(F.col("event_type") == "click")
    right = e.filter(F.col("event_type") == "purchase")
    r = TR.cogroup_early_fire(left, right, "user_id", "ts", "event_id", "value", "1 hour")
    return to_ntz(r, "window_start")


register("j19_cogroup_early_fire", j19_cogroup_early_fire, f"""
WITH u AS (SELECT user_id, ts, event_id, CAST(value AS DECIMAL(18,2)) AS v,
                  CASE event_type WHEN 'click' THEN 'L' ELSE 'R' END AS side,
                  make_timestamp((epoch_us(ts) // {HOUR_US}) * {HOUR_US}) AS window_start
           FROM events WHERE event_type IN ('click', 'purchase')),
r AS (SELECT *, ROW_NUMBER() OVER w AS k,
             COUNT(*) FILTER (WHERE side = 'L') OVER (w ROWS UNBOUNDED PRECEDING) AS nl,
             COUNT(*) FILTER (WHERE side = 'R') OVER (w ROWS UNBOUNDED PRECEDING) AS nr,
             SUM(v) FILTER (WHERE side = 'L') OVER (w ROWS UNBOUNDED PRECEDING) AS sl,
             SUM(v) FILTER (WHERE side = 'R') OVER (w ROWS UNBOUNDED PRECEDING) AS sr
      FROM u WINDOW w AS (PARTITION BY user_id, window_start ORDER BY ts, side, event_id)),
b AS (SELECT *, nl > 0 AND nr > 0 AS both_seen,
             COALESCE(LAG(nl > 0 AND nr > 0) OVER (PARTITION BY user_id, window_start ORDER BY k), false) AS prev_both
      FROM r),
fires AS (SELECT user_id, window_start, k AS fire_seq, 'both' AS trigger,
                 CASE WHEN NOT prev_both THEN nl ELSE CASE WHEN side = 'L' THEN 1 ELSE 0 END END AS n_left, nr AS n_right,
                 CAST(CASE WHEN NOT prev_both THEN sl ELSE CASE WHEN side = 'L' THEN v END END AS DOUBLE) AS sum_left,
                 CAST(sr AS DOUBLE) AS sum_right
          FROM b WHERE both_seen),
g AS (SELECT user_id, window_start, MAX(k) AS n, MAX(nr) AS nr, SUM(v) FILTER (WHERE side = 'R') AS sr,
             MAX(CASE WHEN both_seen THEN k END) AS lastfire FROM b GROUP BY ALL),
tl AS (SELECT b.user_id, b.window_start, COUNT(*) AS c, SUM(b.v) AS s FROM b JOIN g USING (user_id, window_start)
       WHERE b.side = 'L' AND (g.lastfire IS NULL OR b.k > g.lastfire) GROUP BY ALL)
SELECT * FROM fires
UNION ALL
SELECT g.user_id, g.window_start, g.n + 1 AS fire_seq, 'end' AS trigger, COALESCE(tl.c, 0) AS n_left, g.nr AS n_right,
       CAST(tl.s AS DOUBLE) AS sum_left, CAST(g.sr AS DOUBLE) AS sum_right
FROM g LEFT JOIN tl USING (user_id, window_start)""")

T15_THRESHOLD = 500.0
T15_EVICT_MS = 6 * 3_600_000


def t15_delta_trigger_top_speed(spark, sf):
    """Per user, 'distance' = running sum of values; fire when it grew by
    more than 500 since the last fire; report the fastest (max value) event of
    the last 6 hours."""
    e = events(spark, sf, "event_id", "ts", "user_id", "value") \
        .withColumn("v", F.col("value").cast("decimal(18,2)"))
    e = RN.running_sum(e, "user_id", ["ts", "event_id"], "v", "distance", "ts")
    r = TR.top_speed_delta_trigger(e, "user_id", "ts", "event_id", "value", "distance",
                                   T15_THRESHOLD, T15_EVICT_MS)
    return to_ntz(r, "fire_time")


register("t15_delta_trigger_top_speed", t15_delta_trigger_top_speed, f"""
WITH RECURSIVE ev AS (
  SELECT user_id, event_id, ts, value,
         SUM(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS dist,
         ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
st(user_id, rn, last, fired) AS (
  SELECT user_id, rn, dist, false FROM ev WHERE rn = 1
  UNION ALL
  SELECT ev.user_id, ev.rn, CASE WHEN ev.dist - st.last > {T15_THRESHOLD} THEN ev.dist ELSE st.last END,
         ev.dist - st.last > {T15_THRESHOLD}
  FROM st JOIN ev ON ev.user_id = st.user_id AND ev.rn = st.rn + 1),
f AS (SELECT ev.user_id, ev.event_id AS fire_id, ev.ts AS fire_time FROM st JOIN ev USING (user_id, rn) WHERE fired)
SELECT f.user_id, f.fire_time, f.fire_id,
       arg_max(e.event_id, (e.value, -epoch_us(e.ts), -e.event_id)) AS max_id,
       MAX(e.value) AS max_speed
FROM f JOIN events e ON e.user_id = f.user_id
  AND e.ts > f.fire_time - INTERVAL {T15_EVICT_MS} MILLISECOND
  AND (e.ts < f.fire_time OR (e.ts = f.fire_time AND e.event_id <= f.fire_id))
GROUP BY ALL""")


def t25_price_drop_trigger(spark, sf):
    """Per event type and hour, average value fired early on drops
    (>5 %: at once; >1 %: at the next 10-minute boundary) and at the end."""
    e = events(spark, sf, "event_id", "ts", "event_type", "value")
    r = TR.price_drop_trigger(e, "event_type", "ts", "event_id", "value", 3600, 600)
    return to_ntz(r, "window_start", "fire_time")


# row by row per (type, hour): what is held (rows, sum, last price), and the one boundary that can be
# pending (a later drop inside the same ten minutes asks for the same one)
register("t25_price_drop_trigger", t25_price_drop_trigger, f"""
WITH RECURSIVE ev AS (
  SELECT event_type, (epoch_us(ts) // {HOUR_US}) * {HOUR_US} AS ws, epoch_us(ts) AS t, value AS p,
         ROW_NUMBER() OVER (PARTITION BY event_type, epoch_us(ts) // {HOUR_US} ORDER BY ts, event_id) AS rn FROM events),
st AS (
  SELECT DISTINCT event_type, ws, CAST(0 AS BIGINT) AS rn, CAST(0 AS BIGINT) AS n, CAST(0 AS DOUBLE) AS s,
         CAST(NULL AS DOUBLE) AS last, CAST(NULL AS BIGINT) AS due,
         CAST(NULL AS BIGINT) AS due_at, CAST(0 AS BIGINT) AS due_n, CAST(0 AS DOUBLE) AS due_s,
         CAST(NULL AS BIGINT) AS drop_at, CAST(0 AS BIGINT) AS drop_n, CAST(0 AS DOUBLE) AS drop_s FROM ev
  UNION ALL
  SELECT event_type, ws, rn, CASE WHEN big THEN 0 ELSE n1 + 1 END, CASE WHEN big THEN 0 ELSE s1 + p END, p,
         CASE WHEN small AND NOT big THEN (t // 600000000 + 1) * 600000000 WHEN NOT reached THEN due END,
         CASE WHEN reached AND n > 0 THEN due END, n, s, CASE WHEN big THEN t END, n1 + 1, s1 + p
  FROM (SELECT ev.event_type, ev.ws, ev.rn, ev.t, ev.p, st.n, st.s, st.due, r.reached,
               CASE WHEN r.reached THEN 0 ELSE st.n END AS n1, CASE WHEN r.reached THEN 0 ELSE st.s END AS s1,
               COALESCE(st.last - ev.p > st.last * 0.05, false) AS big,
               COALESCE(st.last - ev.p > st.last * 0.01, false) AS small
        FROM st JOIN ev ON ev.event_type = st.event_type AND ev.ws = st.ws AND ev.rn = st.rn + 1,
             LATERAL (SELECT COALESCE(st.due <= ev.t, false) AS reached) r)),
fin AS (SELECT * FROM st QUALIFY ROW_NUMBER() OVER (PARTITION BY event_type, ws ORDER BY rn DESC) = 1),
fired AS (
  SELECT event_type, ws, due_at AS fired_at, 'timer' AS reason, due_n AS n, due_s AS s FROM st WHERE due_at IS NOT NULL
  UNION ALL SELECT event_type, ws, drop_at, 'drop', drop_n, drop_s FROM st WHERE drop_at IS NOT NULL
  UNION ALL SELECT event_type, ws, CASE WHEN due < ws + {HOUR_US} THEN due ELSE ws + {HOUR_US} END,
                   CASE WHEN due < ws + {HOUR_US} THEN 'timer' ELSE 'end' END, n, s FROM fin WHERE n > 0)
SELECT event_type, make_timestamp(ws) AS window_start, make_timestamp(fired_at) AS fire_time, reason, n, s / n AS avg_price
FROM fired""")


def u11_window_models(spark, sf):
    """A model per 1-hour window of training rows (purchases): mean value."""
    e = events(spark, sf, "ts", "event_type", "value").filter(F.col("event_type") == "purchase")
    w = F.window("ts", "1 hour")
    m = e.groupBy(w.alias("w")).agg(exact_avg("value").alias("model"))
    return to_ntz(m.select(F.col("w.end").alias("model_time"), "model"), "model_time")


register("u11_window_models", u11_window_models, f"""
SELECT make_timestamp((epoch_us(ts) // {HOUR_US}) * {HOUR_US} + {HOUR_US}) AS model_time,
       CAST(SUM(CAST(value AS DECIMAL(18,4))) AS DOUBLE) / COUNT(value) AS model
FROM events WHERE event_type = 'purchase' GROUP BY 1""")


def j25_predict_with_latest_model(spark, sf):
    """Every view event is scored with the latest model finished at or
    before its time (as-of join on the model's window end)."""
    models = u11_window_models(spark, sf).select(F.lit(0).alias("_mk"), F.col("model_time").cast("timestamp").alias("mt"), "model")
    v = events(spark, sf, "event_id", "ts", "event_type", "value").filter(F.col("event_type") == "view") \
        .select("event_id", "ts", "value", F.lit(0).alias("_pk"))
    r = J.asof_join(v, models, "_pk", "_mk", "ts", "mt")
    return r.select("event_id", (F.col("value") - F.col("model")).alias("residual"))


register("j25_predict_with_latest_model", j25_predict_with_latest_model, f"""
WITH m AS (SELECT make_timestamp((epoch_us(ts) // {HOUR_US}) * {HOUR_US} + {HOUR_US}) AS mt,
                  CAST(SUM(CAST(value AS DECIMAL(18,4))) AS DOUBLE) / COUNT(value) AS model
           FROM events WHERE event_type = 'purchase' GROUP BY 1)
SELECT v.event_id, v.value - m.model AS residual
FROM (SELECT * FROM events WHERE event_type = 'view') v ASOF JOIN m ON v.ts >= m.mt""")


def a06_running_reduce(spark, sf):
    e = events(spark, sf, "event_id", "ts", "user_id", "event_type", "value") \
        .withColumn("v", F.col("value").cast("decimal(18,2)"))
    r = RN.running_reduce_labeled(e, "user_id", ["ts", "event_id"], "v", "event_type", "ts")
    return r.select("event_id", "user_id", "event_type", F.col("v").cast("double").alias("total"))


register("a06_running_reduce", a06_running_reduce, """
SELECT event_id, user_id,
       CASE WHEN ROW_NUMBER() OVER w = 1 THEN event_type ELSE 'Sum' END AS event_type,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER (w ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS total
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
