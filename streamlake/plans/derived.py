"""Data sets derived by Spark from the driver tables (graph edges, arrival
orders, text lines) shared by several jobs, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import load


def event_graph_edges(spark, sf) -> DataFrame:
    """Directed user graph: an edge a -> b when b's event directly follows
    a's event (next ``event_id``); distinct, no loops.

    Built with an equi-join on ``event_id + 1`` -- no global ordering window.
    """
    e = load(spark, sf, "events", "event_id", "user_id")
    a = e.select(F.col("event_id").alias("_id"), F.col("user_id").alias("src"))
    b = e.select((F.col("event_id") - 1).alias("_id"), F.col("user_id").alias("dst"))
    return a.join(b, "_id").filter(F.col("src") != F.col("dst")).select("src", "dst").distinct()


EDGES_SQL = """(SELECT DISTINCT e1.user_id AS src, e2.user_id AS dst
   FROM events e1 JOIN events e2 ON e2.event_id = e1.event_id + 1
   WHERE e1.user_id <> e2.user_id)"""


def arrival_order(df: DataFrame, id_col: str = "event_id") -> DataFrame:
    """A deterministic out-of-order arrival sequence for replaying ``events``:
    ``arrival = id + (id * 37) % 11`` (ties broken by id), i.e. rows arrive up to
    ten positions late."""
    return df.withColumn("arrival", F.col(id_col) + (F.col(id_col) * 37) % 11)


ARRIVAL_SQL = "(event_id + (event_id * 37) % 11)"


def props_k(c: str = "props"):
    """``props`` JSON ``{"k": n}`` -> n as long."""
    return F.get_json_object(F.col(c), "$.k").cast("long")


PROPS_K_SQL = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
