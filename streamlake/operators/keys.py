"""Joins on grouping keys: a null key is a key, as in ``groupBy``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_keys(left: DataFrame, right: DataFrame, keys, how: str = "left") -> DataFrame:
    """``left.join(right, keys, how)`` with null equal to null; the keys
    appear once, from ``left``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    other = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(other, same, how).drop(*[f"_right_{k}" for k in keys])
