"""Balanced ranges of an order.

Operators that run along an order (running aggregates, sessions, as-of joins)
cut it into ranges that are worked on apart. The borders are quantiles of a
sample of the order columns, all of them: a stray timestamp makes no range of
its own, a burst is cut as finely as its rows need, and rows of one instant are
split by the remaining order columns. The sample decides the balance alone;
results do not depend on it. Its size is bounded by ``MAX_RANGES``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_RANGE = 500_000
MAX_RANGES = 8192  # beyond it ranges grow with the rows
SAMPLE_PER_RANGE = 60


def _comparable(df: DataFrame, order: list) -> list[Column]:
    """The order columns in types that JSON carries exactly."""
    out = []
    for c in order:
        column = F.col(c) if isinstance(c, str) else c
        kind = df.select(column.alias("c")).schema["c"].dataType.typeName()
        if kind in ("timestamp", "timestamp_ntz"):
            column = F.unix_micros(column.cast("timestamp"))
        elif kind == "date":
            column = F.unix_date(column)
        out.append(column)
    return out


def order_range(df: DataFrame, order, rows: int | None = None) -> Column:
    """The number of a row's range along ``order`` (columns or their names,
    ascending, nulls first): monotone in the order, about ``rows`` rows each.
    Runs a count and, for more than one range, a sample over the order columns."""
    order = [order] if isinstance(order, (str, Column)) else list(order)
    columns = _comparable(df, order)
    named = df.select(*[c.alias(f"c{k}") for k, c in enumerate(columns)])
    n = named.count()
    ranges = min(MAX_RANGES, -(-n // (rows or ROWS_PER_RANGE)))
    if ranges <= 1:
        return F.lit(0).cast("long")
    share = SAMPLE_PER_RANGE * ranges / n
    picked = named if share >= 1 else named.sample(share, seed=11)
    key = F.struct(*named.columns)
    found = [r[0] for r in picked.sort(*named.columns).select(
        F.to_json(key, {"ignoreNullFields": "false"})).collect()]  # at most SAMPLE_PER_RANGE * MAX_RANGES or so
    borders = list(dict.fromkeys(found[k * len(found) // ranges] for k in range(1, ranges) if found))
    if not borders:
        return F.lit(0).cast("long")
    kind = named.select(F.array(key).alias("k")).schema["k"].dataType.simpleString()
    edges = F.from_json(F.lit(f"[{','.join(borders)}]"), kind)
    row = F.struct(*[c.alias(f"c{k}") for k, c in enumerate(columns)])
    steps = [1 << k for k in reversed(range(len(borders).bit_length()))]
    # binary search: how many borders are not above the row
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda low, step: F.when(
        F.get(edges, low + step - 1) <= row, low + step).otherwise(low)).cast("long")
