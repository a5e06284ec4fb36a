"""Readers for the parquet tables the jobs run on.

Columns are selected at the scan so Spark prunes the parquet read; filters
written after ``load`` are pushed into the scan by Catalyst.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one table; optional ``columns`` prune the scan."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def events(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """``events`` with ``ts`` as a session-zone TIMESTAMP (event-time column).

    The files store TIMESTAMP_NTZ, which watermarks reject; the session zone
    is UTC, so the cast keeps wall-clock values.
    """
    df = load(spark, sf_dir, "events", *columns)
    if "ts" in df.columns:
        df = df.withColumn("ts", F.col("ts").cast("timestamp"))
    return df


def to_ntz(df: DataFrame, *cols: str) -> DataFrame:
    """Cast event-time columns back to TIMESTAMP_NTZ for output."""
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df

