"""Ranking, top-N and ordering.

``row_number() <= n`` over a partition is planned by Spark as a
``WindowGroupLimit`` below the shuffle, so each task keeps only its local
top n per group before exchanging rows -- a hot group does not ship all of
its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _order_cols(order):
    out = []
    for o in ([order] if isinstance(order, str) else order):
        if isinstance(o, str):
            desc = o.startswith("-")
            c = F.col(o.lstrip("-"))
            out.append(c.desc() if desc else c.asc())
        else:
            out.append(o)
    return out


def row_number(df: DataFrame, keys, order, out: str = "row_num") -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order)``;
    ``order`` items prefixed with ``-`` sort descending."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order))
    return df.withColumn(out, F.row_number().over(w))


def top_n(df: DataFrame, keys, order, n: int, keep_rank: bool = True,
          out: str = "row_num") -> DataFrame:
    """Top ``n`` rows per group (``keep_rank=False`` drops it)."""
    r = row_number(df, keys, order, out).filter(F.col(out) <= n)
    return r if keep_rank else r.drop(out)
