"""User-defined functions and their registration.

The fast path of every function is a built-in Column expression (see
``scalar``); the registered forms below make the same logic callable by
name from SQL text.  Python bodies are Arrow-batched pandas UDFs; the one
row-at-a-time form is the table function, as SQL LATERAL needs it.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import udtf

# The bounding box of the reference's "four ring" check
# (longitude west/east, latitude south/north), bounds inclusive.
LON_WEST, LON_EAST = 116.27, 116.48
LAT_SOUTH, LAT_NORTH = 39.83, 39.988


def register_sql_functions(spark: SparkSession) -> None:
    """Register the scalar functions by name (SQL-bodied, so they are
    inlined into the plan and stay in codegen)."""
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION is_in_box(lon DOUBLE, lat DOUBLE,
                    w DOUBLE, e DOUBLE, s DOUBLE, n DOUBLE)
                  RETURNS BOOLEAN RETURN lon BETWEEN w AND e AND lat BETWEEN s AND n""")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION is_in_four_ring(lon DOUBLE, lat DOUBLE)
                  RETURNS BOOLEAN RETURN lon BETWEEN {LON_WEST} AND {LON_EAST}
                                     AND lat BETWEEN {LAT_SOUTH} AND {LAT_NORTH}""")
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION time_diff_ms(a TIMESTAMP, b TIMESTAMP)
                 RETURNS BIGINT RETURN CAST(floor((unix_micros(b) - unix_micros(a)) / 1000) AS BIGINT)""")
    spark.udtf.register("split_sharp", SplitSharp)
    spark.udf.register("weighted_avg_udaf", weighted_avg_udaf)


@udtf(returnType=T.StructType([T.StructField("s", T.StringType())]))
class SplitSharp:
    """Split on ``#``; no rows when the text has no ``#`` (Java split:
    trailing empty pieces dropped)."""

    def eval(self, text: str):
        if text is not None and "#" in text:
            parts = text.split("#")
            while parts and parts[-1] == "":
                parts.pop()
            for p in parts:
                yield (p,)


@F.pandas_udf(T.DoubleType())
def weighted_avg_udaf(v: pd.Series, w: pd.Series) -> float:
    """D05/A12 as a grouped-aggregate pandas UDF: truncating long division
    of sum(v*w) by sum(w); null when the weights sum to 0."""
    num = int((v.astype("int64") * w.astype("int64")).sum())
    den = int(w.astype("int64").sum())
    if den == 0:
        return None
    q = abs(num) // abs(den)
    return float(q if (num >= 0) == (den > 0) else -q)
