"""Catalog surface (C01-C03): temp views, SQL views, inline table refs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def create_view(df: DataFrame, name: str) -> DataFrame:
    """Expose a DataFrame (batch or stream) to SQL by name."""
    df.createOrReplaceTempView(name)
    return df


def create_sql_view(spark: SparkSession, name: str, sql: str) -> None:
    """``CREATE VIEW name AS <sql>`` (session-scoped)."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS {sql}")


def sql_with(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """SQL text referencing DataFrames inline (``{name}`` placeholders)."""
    return spark.sql(sql, **tables)
