"""Structured Streaming helpers: file-backed streams and availableNow runs.

``stream_parquet`` turns a parquet table path into a streaming DataFrame
with the same schema as the batch read, so every operator can be run both
ways.  ``run_to_memory`` drives a query to completion synchronously (tests,
small results); production jobs use ``foreachBatch`` / file / Kafka sinks
from ``streamlake.sources``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def enable_state_store(spark: SparkSession) -> None:
    """transformWithState needs the RocksDB state store provider."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def stream_parquet(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream a parquet table; ``path`` may be a directory or a single file
    (then its folder is the base path and the file name a glob)."""
    import os
    schema = spark.read.parquet(path).schema
    r = spark.readStream.schema(schema)
    if os.path.isfile(path):
        # a one-character class turns the file name into a glob under its folder
        r = r.option("basePath", os.path.dirname(path))
        path = path[:-1] + "[" + path[-1] + "]"
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a stream, ``ts`` cast to TIMESTAMP (watermark-able)."""
    df = stream_parquet(spark, f"{sf_dir}/events.parquet")
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def stream_checkpoint(spark: SparkSession, name: str, lasting: bool = False) -> str:
    """A query's checkpoint folder under the shared ``spark.checkpoint.dir``
    (a local scratch folder only when that setting is absent, as in tests).
    A fresh one for every start, or with ``lasting`` the one that belongs to
    the name: a query that starts again under it goes on from its state."""
    base = spark.conf.get("spark.checkpoint.dir", None)  # not the application's own subfolder
    folder = f"{(base or ensure_checkpoint_dir(spark)).rstrip('/')}/streams/{name}"
    return folder if lasting else f"{folder}-{uuid.uuid4().hex}"


def run_to_memory(df: DataFrame, name: str, mode: str = "append",
                  checkpoint: str | None = None) -> DataFrame:
    """Run ``df`` with ``availableNow`` into a memory table and return it."""
    ck = checkpoint or stream_checkpoint(df.sparkSession, name)
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return df.sparkSession.table(name)


def run_with_progress(df: DataFrame, name: str, mode: str = "append",
                      checkpoint: str | None = None) -> tuple[DataFrame, list[dict]]:
    """``run_to_memory`` and the progress report of every micro-batch (rows in
    state, watermark, ...)."""
    ck = checkpoint or stream_checkpoint(df.sparkSession, name)
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return df.sparkSession.table(name), [dict(p) for p in q.recentProgress]


def run_until_idle(df: DataFrame, name: str, mode: str = "append", every: str = "1 second",
                   checkpoint: str | None = None) -> DataFrame:
    """Run ``df`` on a processing-time trigger until all available input is
    processed, then stop (for processing-time state such as TTL, whose
    housekeeping batches keep an ``availableNow`` query alive)."""
    ck = checkpoint or stream_checkpoint(df.sparkSession, name)
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", ck).trigger(processingTime=every).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return df.sparkSession.table(name)


def run_until_consumed(df: DataFrame, name: str, input_rows: int, mode: str = "update",
                       every: str = "1 second", timeout_s: float = 120.0,
                       checkpoint: str | None = None) -> DataFrame:
    """Run ``df`` on a processing-time trigger until ``input_rows`` input rows
    were processed, then stop; fails if that takes over ``timeout_s``.  For processing-time
    state (TTL), whose housekeeping batches keep ``availableNow`` and
    ``processAllAvailable`` from returning."""
    import time
    ck = checkpoint or stream_checkpoint(df.sparkSession, name)
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", ck).trigger(processingTime=every).start())
    seen, t0 = 0, time.time()
    try:
        while seen < input_rows and time.time() - t0 < timeout_s and q.exception() is None:
            time.sleep(0.5)
            seen = sum(p.get("numInputRows", 0) for p in q.recentProgress)
        if q.exception() is not None:
            raise q.exception()
        if seen < input_rows:
            raise TimeoutError(f"{name}: {seen} of {input_rows} rows in {timeout_s} s")
    finally:
        q.stop()
    return df.sparkSession.table(name)
