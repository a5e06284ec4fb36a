"""OVER-window, running-aggregate and top-N jobs (A03-A05, A20, W01-W08,
K11, G17) over ``events`` and ``lineitem``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import exact_sum, ten_minute_bucket
from ..operators import running as RN
from ..operators.ranges import order_range
from ..operators import topn as TN
from ..sources.tables import events, load, to_ntz
from . import tpch
from .registry import register

ORDER = ["ts", "event_id"]
W_USER = "PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
W_ALL = "ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def _ev(spark, sf, *cols):
    return events(spark, sf, *cols)


def a03_running_sum(spark, sf):
    e = _ev(spark, sf, "event_id", "ts", "user_id", "value") \
        .withColumn("v", F.col("value").cast("decimal(18,2)"))
    r = RN.running_sum(e, "user_id", ORDER, "v", "running_value", "ts")
    return r.select("event_id", "user_id", F.col("running_value").cast("double").alias("running_value"))


register("a03_running_sum", a03_running_sum, f"""
SELECT event_id, user_id, CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER ({W_USER}) AS DOUBLE) AS running_value
FROM events""")


def a04_running_max_first_fields(spark, sf):
    e = _ev(spark, sf, "user_id", "ts", "event_id", "value", "event_type")
    r = RN.running_max_keep_first(e, "user_id", ORDER, "value", "ts")
    return to_ntz(r, "ts")


register("a04_running_max_first_fields", a04_running_max_first_fields, f"""
SELECT user_id, ts, event_id, MAX(value) OVER ({W_USER}) AS value,
       FIRST_VALUE(event_type) OVER ({W_USER}) AS event_type FROM events""")


def a05_running_max_by(spark, sf):
    """A05 running form: per row, the row holding the key's max so far
    (first row wins ties)."""
    e = _ev(spark, sf, "user_id", "ts", "event_id", "value", "event_type")
    best = F.struct(F.col("value").alias("value"), (-F.unix_micros("ts")).alias("nts"),
                    (-F.col("event_id")).alias("nid"), F.col("event_type").alias("event_type"))
    r = RN.running(e.withColumn("_s", best), ["user_id"], ORDER, "_s", "max", "_best",
                   RN.order_bucket(e, ORDER, "ts"))
    return r.select("event_id", "user_id", F.col("_best.value").alias("max_value"),
                    (-F.col("_best.nid")).alias("max_event_id"),
                    F.col("_best.event_type").alias("max_event_type"))


register("a05_running_max_by", a05_running_max_by, f"""
SELECT event_id, user_id, b.value AS max_value, -b.nid AS max_event_id, b.event_type AS max_event_type FROM (
  SELECT event_id, user_id,
         MAX({{'value': value, 'nts': -epoch_us(ts), 'nid': -event_id, 'event_type': event_type}}) OVER ({W_USER}) AS b
  FROM events)""")


def a20_count_per_user_behavior(spark, sf):
    e = _ev(spark, sf, "event_id", "ts", "user_id", "event_type")
    r = RN.running_count(e, ["user_id", "event_type"], ORDER, "cnt", "ts")
    return r.select("event_id", "user_id", "event_type", "cnt")


register("a20_count_per_user_behavior", a20_count_per_user_behavior, """
SELECT event_id, user_id, event_type,
       COUNT(*) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cnt
FROM events""")


def w01_sum_one_preceding(spark, sf):
    e = _ev(spark, sf, "event_id", "ts", "event_type", "value") \
        .withColumn("v", F.col("value").cast("decimal(18,2)"))
    r = RN.sliding_rows_sum(e, "event_type", ORDER, "v", "sum_2", preceding=1, ts="ts")
    return r.select("event_id", "event_type", F.col("sum_2").cast("double").alias("sum_2"))


register("w01_sum_one_preceding", w01_sum_one_preceding, """
SELECT event_id, event_type, CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER (
  PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS DOUBLE) AS sum_2
FROM events""")


def w02_running_count(spark, sf):
    e = _ev(spark, sf, "event_id", "ts", "user_id")
    return RN.running_count(e, [], ORDER, "cnt", "ts").select("event_id", "user_id", "cnt")


register("w02_running_count", w02_running_count, f"""
SELECT event_id, user_id, COUNT(*) OVER ({W_ALL}) AS cnt FROM events""")


def w03_running_max(spark, sf):
    e = _ev(spark, sf, "event_id", "ts", "value")
    return RN.running_max(e, [], ORDER, "value", "max_value", "ts").select("event_id", "max_value")


register("w03_running_max", w03_running_max, f"""
SELECT event_id, MAX(value) OVER ({W_ALL}) AS max_value FROM events""")


def w04_running_distinct_users(spark, sf):
    e = _ev(spark, sf, "event_id", "ts", "user_id")
    return RN.running_distinct(e, "user_id", ORDER, "event_id", "uv", "ts").select("event_id", "uv")


register("w04_running_distinct_users", w04_running_distinct_users, f"""
SELECT event_id, COUNT(DISTINCT user_id) OVER ({W_ALL}) AS uv FROM events""")


def g17_uv_per_ten_minutes(spark, sf):
    """Cumulative distinct users, reported per 10-minute label as the
    label's max (the label itself is a running max, as in the SQL form)."""
    e = _ev(spark, sf, "event_id", "ts", "user_id").withColumn("label", ten_minute_bucket("ts"))
    r = RN.running_distinct(e, "user_id", ORDER, "event_id", "uv", "ts")
    r = RN.running(r, [], ORDER, "label", "max", "time_str", RN.order_bucket(e, ORDER, "ts"))
    return r.groupBy("time_str").agg(F.max("uv").alias("uv"))


register("g17_uv_per_ten_minutes", g17_uv_per_ten_minutes, f"""
SELECT time_str, MAX(uv) AS uv FROM (
  SELECT MAX(substr(strftime(ts, '%H:%M'), 1, 4) || '0') OVER ({W_ALL}) AS time_str,
         COUNT(DISTINCT user_id) OVER ({W_ALL}) AS uv FROM events) GROUP BY time_str""")


def w05_row_number(spark, sf):
    """ROW_NUMBER per user by value desc -- as a running count over
    balanced ranges of the order, so a hot user is split."""
    e = _ev(spark, sf, "event_id", "user_id", "value")
    order = [F.col("value").desc(), F.col("event_id").asc()]
    r = RN.running(e, ["user_id"], order, F.lit(1).cast("long"), "sum", "row_num",
                   order_range(e, [F.col("value").isNull(), -F.col("value"), "event_id"]))
    return r.select("event_id", "user_id", F.col("row_num").cast("long").alias("row_num"))


register("w05_row_number", w05_row_number, """
SELECT event_id, user_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS row_num FROM events""")

_LI_ORDER = ["-l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def w06_top_three_per_supplier(spark, sf):
    li = load(spark, sf, "lineitem")
    return TN.top_n(li, "l_suppkey", _LI_ORDER, 3) \
        .select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice",
                F.col("row_num").cast("long").alias("row_num"))


register("w06_top_three_per_supplier", w06_top_three_per_supplier, """
SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice, row_num FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber,
         l_partkey, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS row_num
  FROM lineitem) WHERE row_num <= 3""")


def w07_top_five_per_hour(spark, sf):
    """Per 1-hour window the 5 users with the largest value sum
    (rank dropped); ties broken by user id."""
    e = _ev(spark, sf, "ts", "user_id", "value")
    win = e.groupBy("user_id", F.window("ts", "1 hour").start.alias("start_time")) \
           .agg(exact_sum("value").alias("rss"))
    top = TN.top_n(win, "start_time", ["-rss", "user_id"], 5, keep_rank=False)
    return to_ntz(top.select("user_id", "rss", "start_time"), "start_time")


register("w07_top_five_per_hour", w07_top_five_per_hour, """
SELECT user_id, rss, start_time FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY start_time ORDER BY rss DESC, user_id) AS rn FROM (
    SELECT user_id, make_timestamp((epoch_us(ts) // 3600000000) * 3600000000) AS start_time,
           CAST(SUM(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS rss
    FROM events GROUP BY 1, 2)) WHERE rn <= 5""")

register("w08_sorted_q3", tpch.g13_sorted, tpch.G13_SQL)


def k11_retract_changelog(spark, sf):
    """Retract stream of ``COUNT(*) GROUP BY event_type`` in event order."""
    e = _ev(spark, sf, "event_id", "ts", "event_type")
    r = RN.retract_changelog(e, "event_type", ORDER, None, "ts", kind="count")
    return to_ntz(r, "ts")


register("k11_retract_changelog", k11_retract_changelog, """
WITH c AS (SELECT event_type, ts, event_id,
                  COUNT(*) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS n FROM events)
SELECT true AS is_add, event_type, n AS value, ts, event_id, 1 AS seq FROM c
UNION ALL SELECT false AS is_add, event_type, n - 1 AS value, ts, event_id, 0 AS seq FROM c WHERE n > 1""")
