"""File sources and text parsers.

Readers take an explicit schema (no inference pass over the data) and
return DataFrames whose later filters/projections Catalyst pushes down.
Every reader also has a streaming form (``stream=True``) with the same
output schema, so the same transform runs on batch or stream input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _reader(spark: SparkSession, stream: bool):
    return spark.readStream if stream else spark.read


def from_rows(spark: SparkSession, rows, schema) -> DataFrame:
    """In-memory elements (tests and tiny dimension tables only)."""
    return spark.createDataFrame(rows, schema)


def read_lines(spark: SparkSession, path: str, stream: bool = False,
               line_sep: str | None = None) -> DataFrame:
    """One row per text line (``value``); ``line_sep`` sets a custom
    record delimiter."""
    r = _reader(spark, stream)
    if line_sep is not None:
        r = r.option("lineSep", line_sep)
    return r.text(path)


def read_delimited(spark: SparkSession, path: str, schema: str | StructType, sep: str = ",",
                   include_mask: str | None = None, names=None, stream: bool = False,
                   line_sep: str | None = None) -> DataFrame:
    """Typed delimited file; ``include_mask`` ("1001...") keeps only
    the marked columns, ``names`` renames the kept columns."""
    r = _reader(spark, stream).schema(schema).option("sep", sep).option("header", "false")
    if line_sep is not None:
        r = r.option("lineSep", line_sep)
    df = r.csv(path)
    if include_mask:
        keep = [c for c, m in zip(df.columns, include_mask) if m == "1"]
        df = df.select(*keep)
    if names:
        df = df.toDF(*names)
    return df


def sequence(spark: SparkSession, start: int, end: int) -> DataFrame:
    """``generateSequence(start, end)``, both bounds inclusive."""
    return spark.range(start, end + 1).withColumnRenamed("id", "value")


# Input line layouts of the reference's CSV sources.
STOCK_SCHEMA = "symbol string, day string, time string, price double, volume int"
BEHAVIOR_SCHEMA = "user_id long, item_id long, category_id int, behavior string, ts_s long"


def read_stock_ticks(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """``symbol,yyyyMMdd,HHmmss,price,volume`` with an event-time column."""
    df = read_delimited(spark, path, STOCK_SCHEMA, stream=stream)
    ts = F.to_timestamp(F.concat_ws(" ", "day", "time"), "yyyyMMdd HHmmss")
    return df.withColumn("ts", ts).drop("day", "time")


def read_user_behavior(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Behaviour CSV with epoch-second timestamps -> ``ts``."""
    df = read_delimited(spark, path, BEHAVIOR_SCHEMA, stream=stream)
    return df.withColumn("ts", F.timestamp_seconds("ts_s")).drop("ts_s")


def parse_tuple_text(df: DataFrame, names, types, col: str = "value") -> DataFrame:
    """``(a,b,...)`` text -> typed columns."""
    body = F.regexp_replace(F.col(col), r"^\s*\(|\)\s*$", "")
    parts = F.split(body, r"\s*,\s*")
    return df.select(*[parts[i].cast(t).alias(n) for i, (n, t) in enumerate(zip(names, types))])


def parse_space_separated(df: DataFrame, names, types, col: str = "value") -> DataFrame:
    """``id ts value`` lines split on single spaces."""
    parts = F.split(F.col(col), " ")
    return df.select(*[parts[i].cast(t).alias(n) for i, (n, t) in enumerate(zip(names, types))])


def parse_adjacency(df: DataFrame, col: str = "value") -> DataFrame:
    """``id n1 n2 ...`` -> (id, neighbors array<long>)."""
    parts = F.split(F.trim(F.col(col)), " +")
    return df.select(parts[0].cast("long").alias("id"),
                     F.transform(F.slice(parts, 2, F.size(parts) - 1), lambda x: x.cast("long")).alias("neighbors"))


def csv_table(spark: SparkSession, name: str, path: str, schema: str,
              rowtime: str | None = None, delay: str | None = None,
              stream: bool = False) -> DataFrame:
    """Filesystem CSV table with declared schema (and optional
    rowtime + watermark), registered as a temporary view ``name``."""
    df = read_delimited(spark, path, schema, stream=stream)
    if rowtime and delay and df.isStreaming:
        df = df.withWatermark(rowtime, delay)
    df.createOrReplaceTempView(name)
    return df


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Socket text stream (connects to an existing server; opens none)."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def read_json_lines(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """JSON-lines records kept as raw text (``value``) for lazy parsing."""
    return read_lines(spark, path, stream=stream)


def read_web_logs(spark: SparkSession, documents: str, ranks: str, visits: str):
    """Web-log inputs: documents ``url|text``, ranks ``rank|url|duration``,
    visits ``ip|url|date|...`` (only the used fields are kept)."""
    docs = read_delimited(spark, documents, "url string, text string", sep="|")
    rk = read_delimited(spark, ranks, "rank int, url string, avg_duration int", sep="|")
    vs = read_delimited(spark, visits, "ip string, url string, date string", sep="|", include_mask="111")
    return docs, rk, vs
