"""Functions over all rows of a window.

The median of a window is Spark's exact ``percentile``, an aggregate that
keeps value counts and merges partial results, so no window's rows are
collected into one Python worker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def window_median(df: DataFrame, key: str, ts: str, size: str, value: str) -> DataFrame:
    """Median and count of each (key, window)."""
    w = F.window(F.col(ts).cast("timestamp"), size)
    return df.groupBy(key, w.start.alias("window_start"), w.end.alias("window_end")) \
             .agg(F.percentile(value, 0.5).alias("median_value"), F.count(F.lit(1)).alias("cnt"))
