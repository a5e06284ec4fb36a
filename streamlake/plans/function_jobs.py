"""Scalar-function, UDF and catalog jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..functions import text as T
from ..functions import udfs as U
from ..sources.tables import events, load, to_ntz
from . import catalog as C
from .derived import PROPS_K_SQL, props_k
from .registry import register


def f01_f03_ten_minute_labels(spark, sf):
    """SUBSTR, || and DATE_FORMAT building 10-minute labels."""
    e = events(spark, sf, "ts")
    return e.groupBy(S.ten_minute_bucket("ts").alias("time_str")).agg(F.count(F.lit(1)).alias("cnt"))


register("f01_f03_ten_minute_labels", f01_f03_ten_minute_labels, """
SELECT substr(strftime(ts, '%H:%M'), 1, 4) || '0' AS time_str, COUNT(*) AS cnt FROM events GROUP BY 1""")


def f04_parse_dates(spark, sf):
    o = load(spark, sf, "orders", "o_orderkey", "o_orderdate")
    return o.select("o_orderkey", S.to_date_str(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("odate"))


register("f04_parse_dates", f04_parse_dates, """
SELECT o_orderkey, CAST(strptime(strftime(o_orderdate, '%Y-%m-%d'), '%Y-%m-%d') AS DATE) AS odate FROM orders""")


def f06_window_rowtime(spark, sf):
    """TUMBLE_START / TUMBLE_END / TUMBLE_ROWTIME (end - 1 ms)."""
    e = events(spark, sf, "ts")
    w = F.window("ts", "10 minutes")
    r = e.groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("cnt")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        (F.col("w.end") - F.expr("INTERVAL 1 MILLISECOND")).alias("rowtime"), "cnt")
    return to_ntz(r, "window_start", "window_end", "rowtime")


register("f06_window_rowtime", f06_window_rowtime, """
SELECT make_timestamp(b) AS window_start, make_timestamp(b + 600000000) AS window_end,
       make_timestamp(b + 600000000 - 1000) AS rowtime, COUNT(*) AS cnt
FROM (SELECT (epoch_us(ts) // 600000000) * 600000000 AS b FROM events) GROUP BY b""")


def f07_array_cardinality(spark, sf):
    """ARRAY constructor and CARDINALITY."""
    d = load(spark, sf, "documents", "doc_id", "lang", "source", "text")
    return d.select("doc_id", F.cardinality(F.split("text", " ")).cast("long").alias("n_pieces"),
                    F.cardinality(F.array("lang", "source")).cast("long").alias("n_tags"))


register("f07_array_cardinality", f07_array_cardinality, """
SELECT doc_id, len(string_split(text, ' ')) AS n_pieces, len([lang, source]) AS n_tags FROM documents""")


def f09_string_functions(spark, sf):
    d = load(spark, sf, "documents", "doc_id", "source", "lang", "text")
    return d.select("doc_id", F.lower("source").alias("src"), F.length("text").cast("long").alias("n_chars"),
                    F.col("text").contains("the").alias("has_the"),
                    F.regexp_replace("lang", "e", "E").alias("lang2"),
                    F.length(F.trim(F.col("text"))).cast("long").alias("trimmed_len"))


register("f09_string_functions", f09_string_functions, """
SELECT doc_id, lower(source) AS src, length(text) AS n_chars, contains(text, 'the') AS has_the,
       regexp_replace(lang, 'e', 'E', 'g') AS lang2, length(trim(text, ' ')) AS trimmed_len FROM documents""")


def f10_math(spark, sf):
    """abs, sqrt, least/greatest (rand(seed) exists but is not engine-portable)."""
    li = load(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    return li.select("l_orderkey", "l_linenumber",
                     F.abs(F.col("l_discount") - F.col("l_tax")).alias("abs_diff"),
                     F.sqrt("l_quantity").alias("sqrt_qty"),
                     F.least("l_discount", "l_tax").alias("lo"), F.greatest("l_discount", "l_tax").alias("hi"))


register("f10_math", f10_math, """
SELECT l_orderkey, l_linenumber, abs(l_discount - l_tax) AS abs_diff, sqrt(l_quantity) AS sqrt_qty,
       least(l_discount, l_tax) AS lo, greatest(l_discount, l_tax) AS hi FROM lineitem""")


def f11_json_field(spark, sf):
    e = load(spark, sf, "events", "event_type", "props")
    return e.groupBy("event_type").agg(F.sum(props_k()).alias("sum_k"))


register("f11_json_field", f11_json_field,
         f"SELECT event_type, CAST(SUM({PROPS_K_SQL}) AS BIGINT) AS sum_k FROM events GROUP BY event_type")


def f12_epoch_and_format(spark, sf):
    e = events(spark, sf, "event_id", "ts")
    return e.select("event_id", F.unix_millis("ts").alias("epoch_ms"),
                    S.format_ts_millis("ts").alias("ts_text"),
                    S.epoch_millis_to_ts(F.unix_millis("ts")).cast("timestamp_ntz").alias("ts_ms"))


register("f12_epoch_and_format", f12_epoch_and_format, """
SELECT event_id, epoch_us(ts) // 1000 AS epoch_ms, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS ts_text,
       make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts_ms FROM events""")


def f13_prefixed_rejects(spark, sf):
    """Words longer than 12 characters go to a side output as
    ``rejected: <word>`` (counted here)."""
    w = T.tokenize_words(load(spark, sf, "documents", "doc_id", "text"))
    rej = w.filter(F.length("word") > 12).select(S.prefix_text("rejected: ", "word").alias("msg"))
    return rej.groupBy("msg").agg(F.count(F.lit(1)).alias("cnt"))


register("f13_prefixed_rejects", f13_prefixed_rejects, """
SELECT 'rejected: ' || word AS msg, COUNT(*) AS cnt FROM (
  SELECT unnest(regexp_split_to_array(lower(text), '\\W+')) AS word FROM documents)
WHERE length(word) > 12 GROUP BY 1""")


def d01_in_box(spark, sf):
    """Events whose (value, k) lies in a box; double, float and string
    overloads give the same rows."""
    e = load(spark, sf, "events", "event_id", "value", "props").withColumn("k", props_k())
    as_double = S.in_box("value", "k", 100.0, 200.0, 20.0, 60.0)
    as_float = S.in_box(F.col("value").cast("float"), F.col("k").cast("float"), 100.0, 200.0, 20.0, 60.0)
    as_text = S.in_box(F.col("value").cast("string"), F.col("k").cast("string"), 100.0, 200.0, 20.0, 60.0)
    return e.filter(as_double).select("event_id", as_float.alias("by_float"), as_text.alias("by_text"))


register("d01_in_box", d01_in_box, f"""
SELECT event_id, true AS by_float, true AS by_text FROM events
WHERE value BETWEEN 100 AND 200 AND {PROPS_K_SQL} BETWEEN 20 AND 60""")


def d02_time_diff(spark, sf):
    o = load(spark, sf, "orders", "o_orderkey", "o_orderdate")
    li = load(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_shipdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select("l_orderkey", "l_linenumber", S.time_diff_ms("o_orderdate", "l_shipdate").alias("diff_ms"))


register("d02_time_diff", d02_time_diff, """
SELECT l_orderkey, l_linenumber, CAST(floor((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 1000.0) AS BIGINT) AS diff_ms
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")


def d03_ts_to_string(spark, sf):
    e = events(spark, sf, "event_id", "ts")
    return e.select("event_id", S.ts_to_string("ts").alias("ts_text"))


register("d03_ts_to_string", d03_ts_to_string, """
SELECT event_id, regexp_replace(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '(\\.\\d)(\\d*?)0+$', '\\1\\2') AS ts_text
FROM events""")


def d04_udtf_lateral(spark, sf):
    """The registered Python table function in SQL LATERAL form."""
    U.register_sql_functions(spark)
    load(spark, sf, "pages", "page_id", "url").createOrReplaceTempView("pages_d04")
    return spark.sql("SELECT page_id, t.s FROM pages_d04, LATERAL split_sharp(url) t")


register("d04_udtf_lateral", d04_udtf_lateral, """
SELECT page_id, unnest(CASE WHEN regexp_replace(url, '#+$', '') = '' THEN []::VARCHAR[]
                            ELSE string_split(regexp_replace(url, '#+$', ''), '#') END) AS s
FROM pages WHERE contains(url, '#')""")


def d05_weighted_avg_udaf(spark, sf):
    e = load(spark, sf, "events", "user_id", "value", "props") \
        .select("user_id", F.floor("value").cast("long").alias("v"), props_k().alias("w"))
    return e.groupBy("user_id").agg(U.weighted_avg_udaf("v", "w").alias("wavg"))


register("d05_weighted_avg_udaf", d05_weighted_avg_udaf, f"""
SELECT user_id, CAST(SUM(v * w) // NULLIF(SUM(w), 0) AS DOUBLE) AS wavg FROM (
  SELECT user_id, CAST(floor(value) AS BIGINT) AS v, {PROPS_K_SQL} AS w FROM events) GROUP BY user_id""")


def d07_sql_udf(spark, sf):
    """Registered scalar functions used in WHERE and SELECT."""
    U.register_sql_functions(spark)
    e = load(spark, sf, "events", "event_id", "ts", "value", "props")
    e.createOrReplaceTempView("events_d07")
    return spark.sql("""
        SELECT event_id, time_diff_ms(CAST(TIMESTAMP '2024-01-01 00:00:00' AS TIMESTAMP), CAST(ts AS TIMESTAMP)) AS ms
        FROM events_d07
        WHERE is_in_box(value, CAST(get_json_object(props, '$.k') AS DOUBLE), 100, 200, 20, 60)""")


register("d07_sql_udf", d07_sql_udf, f"""
SELECT event_id, CAST(floor((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 1000.0) AS BIGINT) AS ms FROM events
WHERE value BETWEEN 100 AND 200 AND {PROPS_K_SQL} BETWEEN 20 AND 60""")


def c01_c03_views_and_inline(spark, sf):
    """Temp view of a DataFrame; C02: SQL view over it; C03: inline
    DataFrame reference in SQL text."""
    C.create_view(load(spark, sf, "events", "ts", "event_type", "value"), "c_events")
    C.create_sql_view(spark, "c_hourly", """
        SELECT event_type, window(CAST(ts AS TIMESTAMP), '1 hour').start AS start_time, COUNT(*) AS cnt
        FROM c_events GROUP BY event_type, window(CAST(ts AS TIMESTAMP), '1 hour')""")
    big = spark.table("c_hourly")
    out = C.sql_with(spark, "SELECT event_type, MAX(cnt) AS max_cnt FROM {t} GROUP BY event_type", t=big)
    return out


register("c01_c03_views_and_inline", c01_c03_views_and_inline, """
SELECT event_type, MAX(cnt) AS max_cnt FROM (
  SELECT event_type, epoch_us(ts) // 3600000000 AS h, COUNT(*) AS cnt FROM events GROUP BY ALL) GROUP BY event_type""")
