"""Data-quality operators: missing fields, counters, null keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# Java's String.trim() strips every char <= U+0020, not just spaces
_EDGE_CTRL = r"^[\x00-\x20]+|[\x00-\x20]+$"


def is_missing(c: str) -> Column:
    """Null, or empty after a Java-style trim."""
    return F.col(c).isNull() | (F.regexp_replace(F.col(c), _EDGE_CTRL, "") == "")


def drop_missing(df: DataFrame, cols) -> DataFrame:
    """Keep only rows with every field present."""
    return df.filter(~reduce(lambda a, b: a | b, [is_missing(c) for c in cols]))


def missing_counts(df: DataFrame, cols) -> DataFrame:
    """Per-field count of missing values, merged across tasks by the
    aggregate (the accumulator's role)."""
    return df.agg(*[F.count_if(is_missing(c)).alias(f"missing_{c}") for c in cols])


def count_rows_observed(df: DataFrame, name: str = "num_lines"):
    """Named counter of rows seen, collected alongside the main job."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias(name)), obs


def split_null_keys(df: DataFrame, key: str):
    """P20: (rows with a key, rows whose key is null) -- the second output is a
    quarantine instead of a silent null group."""
    return df.filter(F.col(key).isNotNull()), df.filter(F.col(key).isNull())


def parse_entity(df: DataFrame, col: str = "value", names=("symbol", "price", "volume"),
                 types=("string", "int", "int"), tag: str = "tag", tag_value: str = "entity") -> DataFrame:
    """``a,b,c`` record -> named entity; empty fields become null and a
    constant tag column is appended."""
    parts = F.split(F.col(col), ",")
    fields = [F.nullif(parts[i], F.lit("")).cast(t).alias(n) for i, (n, t) in enumerate(zip(names, types))]
    return df.select(*fields, F.lit(tag_value).alias(tag))
