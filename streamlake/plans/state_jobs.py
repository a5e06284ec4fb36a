"""Keyed stateful jobs over ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import stateful as ST
from ..sources.tables import events, to_ntz
from .registry import register

# Fixed mapping of the event types onto the state machine's event letters.
EVENT_LETTERS = {"signup": "a", "view": "b", "click": "c", "purchase": "e", "error": "g"}


def letter_col(c: str = "event_type"):
    m = F.create_map(*[F.lit(x) for kv in EVENT_LETTERS.items() for x in kv])
    return m[F.col(c)]


def u05_state_machine_alerts(spark, sf):
    e = events(spark, sf, "event_id", "ts", "user_id", "event_type") \
        .withColumn("evt", letter_col()).select("user_id", "event_id", "ts", "evt")
    return ST.state_machine_alerts(e, "user_id", ["ts", "event_id"], "evt", "event_id")


# the letters and transitions written out once more, apart from the implementation's tables
register("u05_state_machine_alerts", u05_state_machine_alerts, """
WITH RECURSIVE ev AS (
  SELECT user_id, event_id, CASE event_type WHEN 'signup' THEN 'a' WHEN 'view' THEN 'b' WHEN 'click' THEN 'c'
           WHEN 'purchase' THEN 'e' WHEN 'error' THEN 'g' END AS t,
         ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
st(user_id, rn, s, alert, event_id, t) AS (
  SELECT DISTINCT user_id, CAST(0 AS BIGINT), 'Initial', false, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR) FROM events
  UNION ALL
  SELECT ev.user_id, ev.rn,
         CASE nx WHEN 'Invalid' THEN st.s WHEN 'Terminal' THEN 'Initial' ELSE nx END,
         nx = 'Invalid', ev.event_id, st.s || '|' || ev.t
  FROM st JOIN ev ON ev.user_id = st.user_id AND ev.rn = st.rn + 1,
       LATERAL (SELECT CASE WHEN st.s = 'Initial' AND ev.t = 'a' THEN 'W' WHEN st.s = 'Initial' AND ev.t = 'c' THEN 'X'
                            WHEN st.s = 'W' AND ev.t = 'b' THEN 'Y' WHEN st.s = 'X' AND ev.t = 'b' THEN 'Y'
                            WHEN st.s = 'X' AND ev.t = 'd' THEN 'Z' WHEN st.s = 'Y' AND ev.t = 'e' THEN 'Z'
                            WHEN st.s = 'Z' AND ev.t = 'g' THEN 'Terminal' ELSE 'Invalid' END AS nx))
SELECT user_id, event_id, split_part(t, '|', 1) AS state, split_part(t, '|', 2) AS evt FROM st WHERE alert""")


def u01_rise_alerts(spark, sf):
    """Per user, alert when the event value has not fallen for one hour."""
    e = events(spark, sf, "event_id", "ts", "user_id", "value")
    r = ST.rise_alerts_segmented(e, "user_id", "ts", "value", ["ts", "event_id"], interval_ms=3_600_000)
    return to_ntz(r.select("user_id", "alert_time"), "alert_time")


register("u01_rise_alerts", u01_rise_alerts, """
WITH RECURSIVE ev AS (
  SELECT user_id, epoch_us(ts) // 1000 AS t, value,
         ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
st(user_id, rn, last, timer, fired) AS (
  SELECT DISTINCT user_id, CAST(0 AS BIGINT), CAST(NULL AS DOUBLE), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) FROM events
  UNION ALL
  SELECT ev.user_id, ev.rn, ev.value,
         CASE WHEN st.last IS NULL THEN NULL
              WHEN ev.value < st.last THEN NULL
              WHEN st.timer IS NULL OR st.timer < ev.t THEN ev.t + 3600000
              ELSE st.timer END,
         CASE WHEN st.timer IS NOT NULL AND st.timer < ev.t THEN st.timer END
  FROM st JOIN ev ON ev.user_id = st.user_id AND ev.rn = st.rn + 1),
fin AS (SELECT user_id, timer FROM st WHERE (user_id, rn) IN (SELECT user_id, MAX(rn) FROM st GROUP BY user_id))
SELECT user_id, make_timestamp(fired * 1000) AS alert_time FROM st WHERE fired IS NOT NULL
UNION ALL SELECT user_id, make_timestamp(timer * 1000) AS alert_time FROM fin WHERE timer IS NOT NULL""")
