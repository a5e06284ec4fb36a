"""JDBC dimension loads and sinks.

Append uses Spark's JDBC writer (one connection per partition).  Upsert
lands each micro-batch in a staging table with the JDBC writer and then
runs one ``MERGE`` on the database, so the merge itself is set-based
inside the database; nothing but the statement passes through the driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_table(spark: SparkSession, url: str, query_or_table: str, props: dict | None = None,
               partition_column: str | None = None, lower: int | None = None,
               upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Load a dimension table (optionally in parallel ranges)."""
    r = spark.read.format("jdbc").option("url", url)
    if query_or_table.strip().lower().startswith("select"):
        r = r.option("query", query_or_table)
    else:
        r = r.option("dbtable", query_or_table)
    for k, v in (props or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = r.option("partitionColumn", partition_column).option("lowerBound", lower) \
             .option("upperBound", upper).option("numPartitions", num_partitions)
    return r.load()


def append(df: DataFrame, url: str, table: str, props: dict | None = None) -> None:
    """``INSERT INTO table SELECT ...``."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).mode("append")
    for k, v in (props or {}).items():
        w = w.option(k, v)
    w.save()


def _execute(spark: SparkSession, url: str, statements, props: dict | None = None) -> None:
    jvm = spark.sparkContext._jvm
    login = jvm.java.util.Properties()
    for k, v in (props or {}).items():
        login.setProperty(k, str(v))
    conn = jvm.java.sql.DriverManager.getConnection(url, login)
    try:
        st = conn.createStatement()
        for s in statements:
            st.execute(s)
        st.close()
    finally:
        conn.close()


def merge_sql(target: str, staging: str, keys, cols, q: str = '"') -> str:
    """MERGE from the staging table; Spark's JDBC writer creates the staging
    columns as quoted identifiers, hence ``q`` around the staging side."""
    on = " AND ".join(f"t.{k} = s.{q}{k}{q}" for k in keys)
    upd = ", ".join(f"{c} = s.{q}{c}{q}" for c in cols if c not in keys)
    ins_c = ", ".join(cols)
    ins_v = ", ".join(f"s.{q}{c}{q}" for c in cols)
    return (f"MERGE INTO {target} t USING {staging} s ON {on} "
            f"WHEN MATCHED THEN UPDATE SET {upd} WHEN NOT MATCHED THEN INSERT ({ins_c}) VALUES ({ins_v})")


def _text_types(df: DataFrame, keys, limit: int) -> str:
    """Strings as VARCHAR as long as the batch's longest value (so the MERGE can
    compare them with the target), as CLOB beyond ``limit``; keys cannot be CLOBs."""
    texts = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    if not texts:
        return ""
    longest = df.agg(*[F.coalesce(F.max(F.length(c)), F.lit(1)).alias(c) for c in texts]).first()
    for c in texts:
        if c in keys and longest[c] > limit:
            raise ValueError(f"key column {c} holds a text of {longest[c]} characters, over the limit of {limit}")
    return ", ".join(f"{c} VARCHAR({max(longest[c], 1)})" if longest[c] <= limit else f"{c} CLOB" for c in texts)


def upsert(df: DataFrame, url: str, target: str, keys, order_col: str | None = None,
           staging: str | None = None, varchar: int = 32672, props: dict | None = None) -> None:
    """Upsert by primary key.  Within the batch the last row per key (by
    ``order_col``) wins.  The batch lands in a staging table of its own name,
    is merged, and the staging table is dropped, also when the merge fails.
    ``props``: user, password, driver, ... of the connection. (Spark's Derby
    dialect cannot write null strings into a VARCHAR.)"""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if order_col:
        w = Window.partitionBy(*keys).orderBy(F.col(order_col).desc())
        df = df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    else:
        df = df.dropDuplicates(keys)
    staging = staging or f"{target}_STAGE_{uuid.uuid4().hex[:12].upper()}"
    w = df.write.format("jdbc").option("url", url).option("dbtable", staging).mode("overwrite")
    for k, v in (props or {}).items():
        w = w.option(k, v)
    text_cols = _text_types(df, keys, varchar)
    if text_cols:
        w = w.option("createTableColumnTypes", text_cols)
    w.save()
    try:
        _execute(df.sparkSession, url, [merge_sql(target, staging, keys, df.columns)], props)
    finally:
        _execute(df.sparkSession, url, [f"DROP TABLE {staging}"], props)


def upsert_stream(df: DataFrame, url: str, target: str, keys, checkpoint: str, order_col: str | None = None,
                  props: dict | None = None):
    """K09 on a stream: every micro-batch is upserted (``foreachBatch``); one
    that runs again merges the same rows again."""
    return df.writeStream.option("checkpointLocation", checkpoint).outputMode("update") \
        .foreachBatch(lambda b, _id: upsert(b, url, target, keys, order_col, props=props)).start()
