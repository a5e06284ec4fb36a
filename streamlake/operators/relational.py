"""Projection, filtering, keyed aggregation and set operators.

P01-P04, P09-P14, P17-P19, P21-P23, P26, A01-A02, A05, A07-A12, A14-A19,
X01-X03.  Each is a thin, declarative DataFrame expression: Catalyst pushes
the filters into the parquet scan and prunes unused columns; aggregates run
as partial (map-side) + final hash aggregates, so a hot key is pre-combined
before it is shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from ..functions.scalar import col_
from .keys import join_keys


# ------------------------------------------------------------ projection ----
def map_columns(df: DataFrame, **exprs: Column) -> DataFrame:
    """1:1 map -- add or replace computed columns."""
    return df.withColumns(exprs)


def project_positions(df: DataFrame, *positions: int) -> DataFrame:
    """Positional projection ``.project(0, 1)``."""
    cols = df.columns
    return df.select(*[cols[i] for i in positions])


def rename(df: DataFrame, *names: str, **mapping: str) -> DataFrame:
    """Rename fields (positionally with ``names`` or by ``old=new``)."""
    if names:
        return df.toDF(*names)
    return df.withColumnsRenamed(mapping)


def duplicate_value(df: DataFrame, col: str, a: str, b: str) -> DataFrame:
    """``v -> (v, v)``."""
    return df.select(F.col(col).alias(a), F.col(col).alias(b))


def append_constant(df: DataFrame, name: str, value) -> DataFrame:
    """Append a constant field (count 1, initial rank, tag)."""
    return df.withColumn(name, F.lit(value))


# ------------------------------------------------------------ filters -------
def filter_greater(df: DataFrame, col: str, limit) -> DataFrame:
    """Parameterised threshold filter ``col > limit``."""
    return df.filter(F.col(col) > F.lit(limit))


def filter_equals(df: DataFrame, col: str, value) -> DataFrame:
    """P10: equality filter."""
    return df.filter(F.col(col) == F.lit(value))


def filter_date_before(df: DataFrame, col: str, date: str) -> DataFrame:
    """Strict ``col < date`` on a date / timestamp / date-string column."""
    return df.filter(F.to_date(F.col(col)) < F.lit(date).cast("date"))


def filter_date_after(df: DataFrame, col: str, date: str) -> DataFrame:
    """Strict ``col > date``."""
    return df.filter(F.to_date(F.col(col)) > F.lit(date).cast("date"))


def filter_year(df: DataFrame, col: str, op: str, year: int) -> DataFrame:
    """Year-of-date filter (``>``, ``==``, ``<`` ...) on a date or
    timestamp column, as a range of its own type (so the scan can skip by it)."""
    kind = df.schema[col].dataType
    first, after = (F.lit(f"{y:04d}-01-01").cast(kind) for y in (year, year + 1))
    c = F.col(col)
    tests = {"==": (c >= first) & (c < after), ">": c >= after, "<": c < first,
             ">=": c >= first, "<=": c < after, "!=": (c < first) | (c >= after)}
    return df.filter(tests[op])


# ------------------------------------------------------------ keys ----------
def key_by(df: DataFrame, key) -> GroupedData:
    """Key by position, field name or expression (a grouping)."""
    if isinstance(key, int):
        key = df.columns[key]
    return df.groupBy(col_(key))


def constant_key(df: DataFrame) -> GroupedData:
    """One global group."""
    return df.groupBy()


# ------------------------------------------------------------ graph edges ---
def undirect_edges(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Emit every edge in both directions."""
    return edges.select(F.col(src).alias(src), F.col(dst).alias(dst)).unionByName(
        edges.select(F.col(dst).alias(src), F.col(src).alias(dst)))


def canonical_edges(edges: DataFrame, a: str = "v1", b: str = "v2") -> DataFrame:
    """Orient every edge so that ``v1 < v2`` (self-loops dropped)."""
    return edges.filter(F.col(a) != F.col(b)).select(
        F.least(a, b).alias("v1"), F.greatest(a, b).alias("v2"))


# ------------------------------------------------------------ aggregates ----


def grouped_min(df: DataFrame, keys, value: str, alias: str | None = None) -> DataFrame:
    """A02."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.min(value).alias(alias or f"min_{value}"))


def grouped_count(df: DataFrame, keys, value: str, alias: str = "cnt") -> DataFrame:
    """``COUNT(col) GROUP BY``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(value).alias(alias))


def max_by_row(df: DataFrame, keys, value: str, order: str | None = None) -> DataFrame:
    """A05 (final value): the whole row holding the max of ``value`` per key;
    ties go to the first row by ``order``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    others = [c for c in df.columns if c not in keys]
    # max over (value, -order) picks the earliest of the tied rows
    tie = [F.col(value)] + ([-F.col(order)] if order else [])
    best = F.max_by(F.struct(*[F.col(c) for c in others]), F.struct(*tie))
    return df.groupBy(*keys).agg(best.alias("_r")).select(*keys, "_r.*")


def group_to_list(df: DataFrame, key: str, value: str, alias: str = "values",
                  sort: bool = True) -> DataFrame:
    """Group-reduce to a (sorted) list.

    Output size per key equals its input: use only where the consumer needs
    the whole list (adjacency lists); never for unbounded groups in a hot path.
    """
    agg = F.collect_list(value)
    if sort:
        agg = F.sort_array(agg)
    return df.groupBy(key).agg(agg.alias(alias))


def distinct_rows(df: DataFrame) -> DataFrame:
    """A10."""
    return df.distinct()


def average(df: DataFrame, keys, value: str, alias: str = "avg") -> DataFrame:
    """Mergeable (sum, count) average per key."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.avg(value).alias(alias))


def weighted_avg_expr(v, w) -> Column:
    """``sum(v*w) / sum(w)`` with truncating long division (as the
    reference's long accumulator), returned as double; null when the weights
    sum to 0 instead of a division error."""
    v, w = col_(v).cast("long"), col_(w).cast("long")
    num = F.sum(v * w)
    den = F.nullif(F.sum(w), F.lit(0))
    # (num - num % den) is an exact multiple of den, so the quotient is exact
    return ((num - num % den) / den).cast("long").cast("double")


def weighted_avg(df: DataFrame, keys, v: str, w: str, alias: str = "wavg") -> DataFrame:
    """A12 per key."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(weighted_avg_expr(v, w).alias(alias))


def having(agg: DataFrame, cond) -> DataFrame:
    """Filter after the aggregate."""
    return agg.filter(cond)


# ------------------------------------------------------------ set ops -------
def union_all(*dfs: DataFrame) -> DataFrame:
    """X01."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    """X02."""
    return union_all(*dfs).distinct()


def difference(new: DataFrame, old: DataFrame) -> DataFrame:
    """Rows of ``new`` that are not in ``old``."""
    return join_keys(new, old, new.columns, "left_anti")
