"""Kafka sources and sink (S14-S16, K07) as option builders.

The Kafka connector jar is not part of the base Spark distribution; these
functions build the reader/writer with the right options and fail with a
clear message only when started without the connector on the classpath.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def source_options(servers: str, topic: str, starting: str = "earliest",
                   group_id: str | None = None) -> dict:
    """Subscribe options (``earliest`` / ``latest``)."""
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if group_id:
        opts["kafka.group.id"] = group_id
    return opts


def read_json_topic(spark: SparkSession, servers: str, topic: str, schema: str,
                    starting: str = "earliest", rowtime: str | None = None,
                    delay: str | None = None) -> DataFrame:
    """S14/S15 + T08: JSON messages as typed columns with an optional
    rowtime watermark."""
    raw = spark.readStream.format("kafka").options(**source_options(servers, topic, starting)).load()
    df = raw.select(F.from_json(F.col("value").cast("string"), schema).alias("r")).select("r.*")
    if rowtime and delay:
        df = df.withColumn(rowtime, F.col(rowtime).cast("timestamp")).withWatermark(rowtime, delay)
    return df


def read_binary_topic(spark: SparkSession, servers: str, topic: str, starting: str = "latest") -> DataFrame:
    """Raw binary values (decode with ``codec``)."""
    return spark.readStream.format("kafka").options(**source_options(servers, topic, starting)) \
        .load().select("key", "value", "timestamp")


def sink_options(servers: str, topic: str, checkpoint: str) -> dict:
    return {"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint}


def write_topic(df: DataFrame, servers: str, topic: str, checkpoint: str, value_col: str = "value"):
    """Stream rows' ``value`` (binary or string) to a topic."""
    return df.select(F.col(value_col).alias("value")).writeStream.format("kafka") \
        .options(**sink_options(servers, topic, checkpoint)).start()
