"""Registered parsing jobs (S10-S12, P26): text that Spark writes from table
columns is parsed back, so the result equals the columns themselves."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.quality import parse_entity
from ..sources import files
from ..sources.tables import events, load
from .registry import register


def s10_parse_tuples(spark, sf):
    """``(order, line, quantity)`` with blanks around the separators."""
    li = load(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_quantity")
    text = li.select(F.format_string(" (%d, %d ,%s) ", F.col("l_orderkey").cast("long"),
                                     F.col("l_linenumber").cast("long"), F.col("l_quantity").cast("string")).alias("value"))
    return files.parse_tuple_text(text, ("order_id", "line", "quantity"), ("long", "int", "double"))


register("s10_parse_tuples", s10_parse_tuples, """
SELECT CAST(l_orderkey AS BIGINT) AS order_id, CAST(l_linenumber AS INTEGER) AS line,
       CAST(l_quantity AS DOUBLE) AS quantity FROM lineitem""")


def s11_parse_space_separated(spark, sf):
    """``user ms value`` lines."""
    e = events(spark, sf, "ts", "user_id", "value")
    text = e.select(F.concat_ws(" ", F.col("user_id").cast("string"), F.unix_millis("ts").cast("string"),
                                F.col("value").cast("string")).alias("value"))
    return files.parse_space_separated(text, ("user_id", "ts_ms", "value"), ("long", "long", "double"))


register("s11_parse_space_separated", s11_parse_space_separated, """
SELECT user_id, epoch_us(ts) // 1000 AS ts_ms, value FROM events""")


def s12_parse_adjacency(spark, sf):
    """``region n1 n2 ...`` lines, one row per neighbour."""
    n = load(spark, sf, "nation", "n_nationkey", "n_regionkey")
    lines = n.groupBy("n_regionkey").agg(F.concat_ws(" ", F.sort_array(F.collect_list(
        F.col("n_nationkey").cast("string")))).alias("_n")).select(
        F.concat_ws(" ", F.col("n_regionkey").cast("string"), "_n").alias("value"))
    return files.parse_adjacency(lines).select("id", F.explode("neighbors").alias("neighbor"))


register("s12_parse_adjacency", s12_parse_adjacency, """
SELECT CAST(n_regionkey AS BIGINT) AS id, CAST(n_nationkey AS BIGINT) AS neighbor FROM nation""")


def p26_parse_entity(spark, sf):
    """``symbol,price,volume`` records with empty fields, tagged."""
    o = load(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus")
    volume = F.when(F.col("o_orderkey") % 7 == 0, "").otherwise(F.col("o_orderkey").cast("string"))
    text = o.select(F.concat_ws(",", "o_orderstatus", F.col("o_custkey").cast("string"), volume).alias("value"))
    return parse_entity(text)


register("p26_parse_entity", p26_parse_entity, """
SELECT o_orderstatus AS symbol, CAST(o_custkey AS INTEGER) AS price,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey AS INTEGER) END AS volume, 'entity' AS tag FROM orders""")
