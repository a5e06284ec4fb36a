"""Running (per-row) aggregates and OVER windows.

A running aggregate over a whole key -- or over the whole table, for the
unpartitioned windows -- would put every row of that key into one task.
``running`` splits the order into balanced ranges (buckets) instead:

1. within-bucket running value: window partitioned by (keys, bucket);
2. per-bucket totals: a partial+final hash aggregate (a hot key is
   pre-combined map-side);
3. carry-in: a window over the *totals* only (one row per key and bucket);
4. result = carry-in (+) within-bucket value.

Only associative aggregates (sum, count, max, min) are supported, which is
what the reference uses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .keys import join_keys
from .ranges import order_range

_AGG = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}


def order_bucket(df: DataFrame, order, ts: str, bucket_seconds: float | None = None) -> Column:
    """Where ``running`` cuts the order: time buckets of ``bucket_seconds`` if
    given (and of an hour on streams), else balanced ranges of all the order
    columns (``ranges.order_range``)."""
    if bucket_seconds is not None:
        return time_bucket(ts, bucket_seconds)
    return time_bucket(ts, 3600.0) if df.isStreaming else order_range(df, order)


def time_bucket(ts: str, seconds: float) -> Column:
    return F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / (seconds * 1_000_000))


def running(df: DataFrame, keys, order, value, kind: str, out: str,
            bucket: Column, include_current: bool = True) -> DataFrame:
    """Add ``out`` = running ``kind`` of ``value`` over rows of the same
    ``keys`` up to and including the current row in ``order``.

    ``bucket`` must be monotone in ``order`` (e.g. a time bucket of the
    ordering timestamp).  ``value`` may be a column name or expression.
    ``include_current=False`` aggregates the rows strictly before.
    """
    keys = [keys] if isinstance(keys, str) else list(keys or [])
    order = [order] if isinstance(order, str) else list(order)
    agg = _AGG[kind]
    v = F.col(value) if isinstance(value, str) else value
    d = df.withColumn("_bk", bucket).withColumn("_v", v)
    w_in = Window.partitionBy(*keys, "_bk").orderBy(*order) \
                 .rowsBetween(Window.unboundedPreceding,
                              Window.currentRow if include_current else -1)
    d = d.withColumn("_in", agg("_v").over(w_in))
    # per-bucket totals: Catalyst prunes this branch to a narrow scan with a
    # map-side partial aggregate, so only one row per (keys, bucket) and task
    # is shuffled (sharing the window's full-row exchange is not possible:
    # the two branches project different columns)
    totals = d.groupBy(*keys, "_bk").agg(agg("_v").alias("_t"))
    w_prev = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))) \
        .orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    carry_agg = F.sum if kind in ("sum", "count") else agg
    carry = totals.withColumn("_c", carry_agg("_t").over(w_prev)).drop("_t")
    d = join_keys(d, carry, [*keys, "_bk"])
    if kind in ("sum", "count"):
        zero = F.lit(0).cast(d.schema["_in"].dataType)
        res = F.coalesce(F.col("_in"), zero) + F.coalesce(F.col("_c"), zero)
    elif kind == "max":
        res = F.greatest("_in", "_c")
    else:
        res = F.least("_in", "_c")
    return d.withColumn(out, res).drop("_bk", "_v", "_in", "_c")


def running_sum(df, keys, order, value, out, ts, bucket_seconds=None, bucket=None):
    """One output per input row carrying the key's sum so far. ``bucket``:
    an ``order_bucket`` at hand (several running values share one)."""
    return running(df, keys, order, value, "sum", out,
                   order_bucket(df, order, ts, bucket_seconds) if bucket is None else bucket)


def running_count(df, keys, order, out, ts, bucket_seconds=None, bucket=None):
    """Running ``COUNT(*)`` (no keys = over the whole table)."""
    return running_sum(df, keys, order, F.lit(1).cast("long"), out, ts, bucket_seconds, bucket)


def running_max(df, keys, order, value, out, ts, bucket_seconds=None):
    """Running max."""
    return running(df, keys, order, value, "max", out, order_bucket(df, order, ts, bucket_seconds))


def running_distinct(df, entity, order, row_id, out, ts, keys=(), bucket_seconds=None):
    """Running ``COUNT(DISTINCT entity) OVER (ORDER BY ..)`` -- Spark has
    no distinct window aggregates, so count first sightings: where each
    (``keys``, ``entity``) is first seen comes from a grouped minimum (a hot
    entity is combined map-side), these places are merged into the order, and
    a row's count is the number of places up to it. No row is joined on its
    entity; a null entity is no sighting. ``row_id`` makes the order total."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = list(dict.fromkeys([*([order] if isinstance(order, str) else order), row_id]))
    firsts = (df.filter(F.col(entity).isNotNull()).groupBy(*keys, entity)
              .agg(F.min(F.struct(*order)).alias("_at")).select(*keys, "_at.*", F.lit(0).alias("_side")))
    rows = df.withColumn("_side", F.lit(1)).unionByName(firsts, allowMissingColumns=True)
    along = [*order, "_side"]  # a first sighting stands just before its own row
    counted = running(rows, keys, along, F.lit(1) - F.col("_side"), "sum", out, order_bucket(rows, along, ts, bucket_seconds))
    return counted.filter("_side = 1").drop("_side")


def lag_bucketed(df: DataFrame, keys, order, value, out: str, bucket: Column) -> DataFrame:
    """``LAG(value) OVER (PARTITION BY keys ORDER BY order)`` without a window
    over a whole key: lag inside each (keys, bucket), and for a bucket's
    first row the last value of the key's previous non-empty bucket (from a
    per-bucket table, one row per key and bucket).  ``bucket`` must be
    monotone in ``order``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, str) else list(order)
    v = F.col(value) if isinstance(value, str) else value
    d = df.withColumn("_bk", bucket).withColumn("_v", v)
    d = d.withColumn("_lag", F.lag("_v").over(Window.partitionBy(*keys, "_bk").orderBy(*order)))
    last = d.groupBy(*keys, "_bk").agg(F.max_by("_v", F.struct(*order)).alias("_last"))
    wb = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy("_bk")
    carry = last.withColumn("_carry", F.lag("_last").over(wb)).drop("_last")
    first = F.row_number().over(Window.partitionBy(*keys, "_bk").orderBy(*order)) == 1
    d = join_keys(d, carry, [*keys, "_bk"])
    return d.withColumn(out, F.when(first, F.col("_carry")).otherwise(F.col("_lag"))) \
            .drop("_bk", "_v", "_lag", "_carry")


def sliding_rows_sum(df: DataFrame, keys, order, value, out, preceding: int = 1,
                     ts: str | None = None, bucket_seconds=None) -> DataFrame:
    """``SUM(v) OVER (PARTITION BY k ORDER BY o ROWS BETWEEN n PRECEDING
    AND CURRENT ROW)``.  With ``ts`` given and ``preceding == 1`` it is
    computed as ``v + LAG(v)`` over time buckets (skew-safe); otherwise as a
    bounded-frame window (the operator keeps only n+1 rows in its buffer,
    but a key's rows share one task)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    v = F.col(value) if isinstance(value, str) else value
    if ts is not None and preceding == 1:
        d = lag_bucketed(df.withColumn("_cur", v), keys, order, "_cur", "_prev",
                         order_bucket(df, order, ts, bucket_seconds))
        return d.withColumn(out, F.when(F.col("_prev").isNull(), F.col("_cur"))
                            .otherwise(F.col("_cur") + F.col("_prev"))).drop("_cur", "_prev")
    w = Window.partitionBy(*keys).orderBy(*([order] if isinstance(order, str) else order)) \
              .rowsBetween(-preceding, Window.currentRow)
    return df.withColumn(out, F.sum(v).over(w))


def running_max_keep_first(df: DataFrame, keys, order, value, ts, out_prefix="",
                           bucket_seconds=None) -> DataFrame:
    """``keyBy(k).max(f)`` -- per row, the running max of ``value``;
    every other field comes from the key's *first* row."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, str) else list(order)
    others = [c for c in df.columns if c not in keys and c != value]
    firsts = df.groupBy(*keys).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("_f"))
    r = running_max(df.select(*keys, *order, value), keys, order, value, "_m", ts, bucket_seconds)
    return join_keys(r, firsts, keys).select(*keys, *order, F.col("_m").alias(value),
                                       *[F.col(f"_f.{c}").alias(f"{out_prefix}{c}")
                                         for c in others if c not in order])


def retract_changelog(df: DataFrame, keys, order, value_col: str, ts: str,
                      kind: str = "count", bucket_seconds=None) -> DataFrame:
    """K11 (batch form): the retract stream of a running grouped aggregate.

    For every input row the aggregate of its key changes from ``old`` to
    ``new``: emit ``(false, key, old)`` (when an old value existed) and
    ``(true, key, new)``; ``seq`` orders the pair within the input row.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    bucket = order_bucket(df, order, ts, bucket_seconds)
    r = running_count(df, keys, order, "_n", ts, bucket=bucket)
    if kind == "count":
        r = r.withColumn("_new", F.col("_n"))
        r = r.withColumn("_old", F.when(F.col("_n") > 1, F.col("_n") - 1))
    else:
        r = running_sum(r, keys, order, value_col, "_new", ts, bucket=bucket)
        r = r.withColumn("_old", F.when(F.col("_n") > 1, F.col("_new") - F.col(value_col)))
    order = [order] if isinstance(order, str) else list(order)
    retract = r.filter(F.col("_old").isNotNull()).select(
        F.lit(False).alias("is_add"), *keys, F.col("_old").alias("value"), *order,
        F.lit(0).alias("seq"))
    add = r.select(F.lit(True).alias("is_add"), *keys, F.col("_new").alias("value"), *order,
                   F.lit(1).alias("seq"))
    return retract.unionByName(add)


def running_reduce_labeled(df: DataFrame, key: str, order, value: str, label_col: str,
                           ts: str, label: str = "Sum", bucket_seconds=None) -> DataFrame:
    """``keyBy(k).reduce((a, b) -> (a.k, "Sum", a.v + b.v))`` on a stream:
    the first row of a key is emitted unchanged, every later row carries the
    running total and the constant label."""
    bucket = order_bucket(df, order, ts, bucket_seconds)
    r = running_count(df, [key], order, "_n", ts, bucket=bucket)
    r = running_sum(r, [key], order, value, "_s", ts, bucket=bucket)
    return r.withColumn(label_col, F.when(F.col("_n") == 1, F.col(label_col)).otherwise(F.lit(label))) \
            .withColumn(value, F.col("_s")).drop("_n", "_s")
