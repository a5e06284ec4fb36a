"""Remaining registered jobs: web-log analysis (G15), behaviour windows
(G16), binary codec round trip (S17/S18), side outputs (U03, U04)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import int_to_ip
from ..functions.text import split_by_length, tokenize_words, windowed_word_counts
from ..operators import event_time as ET
from ..sources import codec
from ..sources.tables import events, load, to_ntz
from .registry import register
from .state_jobs import EVENT_LETTERS, letter_col
from .weblog import web_log_analysis

KEYWORDS = (" the ", " and ")


def g15_web_log_analysis(spark, sf):
    d = load(spark, sf, "documents", "doc_id", "text", "n_chars")
    docs = d.select(F.col("doc_id").alias("url"), "text")
    ranks = d.select((F.col("n_chars") / 100).cast("int").alias("rank"), F.col("doc_id").alias("url"),
                     (F.col("n_chars") / 10).cast("int").alias("avg_duration"))
    ev = load(spark, sf, "events", "user_id", "ts", "event_type").filter(F.col("event_type") == "view")
    visits = ev.select(F.col("user_id").alias("url"), F.col("ts").alias("date"))
    return web_log_analysis(docs, ranks, visits, KEYWORDS, min_rank=40, year=2024)


register("g15_web_log_analysis", g15_web_log_analysis, """
SELECT CAST(trunc(n_chars / 100) AS INTEGER) AS rank, doc_id AS url, CAST(trunc(n_chars / 10) AS INTEGER) AS avg_duration
FROM documents d
WHERE contains(text, ' the ') AND contains(text, ' and ') AND CAST(trunc(n_chars / 100) AS INTEGER) > 40
  AND NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = d.doc_id AND e.event_type = 'view'
                  AND CAST(substr(CAST(e.ts AS VARCHAR), 1, 4) AS INTEGER) = 2024)""")


def g16_user_behavior_windows(spark, sf):
    e = events(spark, sf, "ts", "user_id", "event_type")
    r = ET.tumbling(e, "ts", "1 hour", ["user_id"], [F.count("event_type").alias("behavior_cnt")])
    return to_ntz(r, "window_start", "window_end")


register("g16_user_behavior_windows", g16_user_behavior_windows, """
SELECT user_id, make_timestamp((epoch_us(ts) // 3600000000) * 3600000000) AS window_start,
       make_timestamp((epoch_us(ts) // 3600000000) * 3600000000 + 3600000000) AS window_end,
       COUNT(event_type) AS behavior_cnt FROM events GROUP BY ALL""")

def _addr():
    return (F.col("event_id") * 2654435761) % 4294967296


def s17_s18_event_codec(spark, sf):
    e = load(spark, sf, "events", "event_id", "event_type")
    a = _addr()
    signed = F.when(a >= 2 ** 31, a - 2 ** 32).otherwise(a).cast("int")
    enc = e.select("event_id", codec.encode_event(signed, letter_col()).alias("bytes"))
    return enc.select("event_id", codec.decode_address("bytes").alias("address"),
                      codec.decode_type("bytes").alias("evt"),
                      int_to_ip(codec.decode_address("bytes")).alias("ip"))


_LETTER_SQL = ("CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EVENT_LETTERS.items())
               + " END")
register("s17_s18_event_codec", s17_s18_event_codec, f"""
SELECT event_id, CAST(CASE WHEN a >= 2147483648 THEN a - 4294967296 ELSE a END AS INTEGER) AS address,
       {_LETTER_SQL} AS evt,
       concat_ws('.', (a >> 24) & 255, (a >> 16) & 255, (a >> 8) & 255, a & 255) AS ip
FROM (SELECT event_id, event_type, (event_id * 2654435761) % 4294967296 AS a FROM events)""")


def u03_keyed_side_output(spark, sf):
    """Per key, large values go to the side output and the main output
    carries a constant marker -- one pass, each row tagged with its output."""
    e = load(spark, sf, "events", "event_id", "user_id", "value")
    big = F.col("value") > 100
    return e.select("event_id", "user_id", F.when(big, "side").otherwise("main").alias("output"),
                    F.when(big, F.col("value").cast("string")).otherwise(F.lit("normal")).alias("payload"))


register("u03_keyed_side_output", u03_keyed_side_output, """
SELECT event_id, user_id, CASE WHEN value > 100 THEN 'side' ELSE 'main' END AS output,
       CASE WHEN value > 100 THEN CAST(value AS VARCHAR) ELSE 'normal' END AS payload FROM events""")


def u04_length_side_output(spark, sf):
    """Words longer than 5 characters are rejected to a side output;
    the rest are counted per word (main path)."""
    w = tokenize_words(load(spark, sf, "documents", "doc_id", "text"))
    main = w.filter(F.length("word") <= 5).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
    return main


register("u04_length_side_output", u04_length_side_output, """
SELECT word, COUNT(*) AS cnt FROM (SELECT unnest(regexp_split_to_array(lower(text), '\\W+')) AS word FROM documents)
WHERE length(word) > 0 AND length(word) <= 5 GROUP BY word""")


def u04_windowed_side_outputs(spark, sf):
    """U04 whole: words of more than 5 characters go to the side output, the
    rest are counted per word and 5-second window; one job returns both. A
    document's id in seconds stands in for its time."""
    docs = load(spark, sf, "documents", "doc_id", "text").withColumn("ts", F.timestamp_seconds("doc_id"))
    main, rejected = split_by_length(tokenize_words(docs, keep=["ts"]), "word", 5)
    counts = windowed_word_counts(main, "ts", "word", "5 seconds")
    return to_ntz(counts.select(F.lit("main").alias("output"), "window_start", "word", "cnt").unionByName(
        rejected.groupBy("word").agg(F.count(F.lit(1)).alias("cnt")).select(
            F.lit("rejected").alias("output"), F.lit(None).cast("timestamp").alias("window_start"), "word", "cnt")),
        "window_start")


register("u04_windowed_side_outputs", u04_windowed_side_outputs, """
WITH w AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '\\W+')) AS word FROM documents)
SELECT 'main' AS output, make_timestamp((doc_id // 5) * 5000000) AS window_start, word, COUNT(*) AS cnt
FROM w WHERE length(word) > 0 AND length(word) <= 5 GROUP BY ALL
UNION ALL
SELECT 'rejected' AS output, CAST(NULL AS TIMESTAMP) AS window_start, word, COUNT(*) AS cnt
FROM w WHERE length(word) > 5 GROUP BY ALL""")
