"""Join operators.

Equi-joins are left to Catalyst/AQE (sort-merge or shuffle-hash, skew-split
at runtime).  Range-style joins (interval, time-window, as-of) get an
equality on a time bucket so they partition by (key, bucket) instead of
degenerating into per-key nested loops or cross products.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .keys import join_keys
from .ranges import order_range
from .running import order_bucket
from .sizing import DEFAULT_MAX_BROADCAST_BYTES, bounded_broadcast


def equi_join(left: DataFrame, right: DataFrame, left_keys, right_keys,
              how: str = "inner") -> DataFrame:
    """(composite) equi-join ``left.k_i == right.k'_i``."""
    if isinstance(left_keys, str):
        left_keys, right_keys = [left_keys], [right_keys]
    cond = None
    for a, b in zip(left_keys, right_keys):
        c = left[a] == right[b]
        cond = c if cond is None else cond & c
    return left.join(right, cond, how)


def join_pair(left: DataFrame, right: DataFrame, lkey: str, rkey: str,
              left_name: str = "left", right_name: str = "right") -> DataFrame:
    """Inner equi-join returning both whole records as two structs."""
    l = left.select(F.struct(*left.columns).alias(left_name))
    r = right.select(F.struct(*right.columns).alias(right_name))
    return l.join(r, F.col(f"{left_name}.{lkey}") == F.col(f"{right_name}.{rkey}"))


def join_project(left: DataFrame, right: DataFrame, lkey: str, rkey: str,
                 first=(), second=()) -> DataFrame:
    """Join then keep ``first`` fields of the left and ``second`` of the right."""
    l, r = left.alias("l"), right.alias("r")
    out = [F.col(f"l.{c}") for c in first] + [F.col(f"r.{c}") for c in second]
    return l.join(r, F.col(f"l.{lkey}") == F.col(f"r.{rkey}")).select(*out)


def join_with_tiny(big: DataFrame, tiny: DataFrame, on, how: str = "inner",
                   max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast the small side -- only after its size is checked."""
    return big.join(bounded_broadcast(tiny, max_bytes), on, how)


def join_with_huge(small: DataFrame, huge: DataFrame, on, how: str = "inner",
                   max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """The *other* side is huge: never build from or move it if avoidable.

    The first side is broadcast when its estimated bytes are bounded; beyond
    the bound the join is a plain (AQE-managed, skew-split) shuffle join, so
    the huge side is never broadcast.
    """
    return bounded_broadcast(small, max_bytes).join(huge, on, how)


def join_filter(left: DataFrame, right: DataFrame, on, keep) -> DataFrame:
    """Conditional-emit join: join, keep rows passing ``keep``."""
    return left.join(right, on).filter(keep)


def join_fanout(left: DataFrame, adjacency: DataFrame, on: str, array_col: str,
                out_col: str, pos_col: str | None = None) -> DataFrame:
    """Join then emit one row per element of the neighbour array
    (``pos_col`` also keeps the element's position)."""
    j = left.join(adjacency, on)
    keep = [c for c in j.columns if c != array_col]
    if pos_col:
        return j.select(*keep, F.posexplode(array_col).alias(pos_col, out_col))
    return j.select(*keep, F.explode(array_col).alias(out_col))


def anti_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Rows of ``left`` without a partner in ``right``."""
    return left.join(right, on, "left_anti")


def cogroup_difference(new: DataFrame, old: DataFrame) -> DataFrame:
    """Per key, rows of ``new`` not present in ``old`` (set semantics)."""
    return new.distinct().exceptAll(old.distinct())


MAX_SET_BYTES = 32 << 20  # of a broadcast set, as JSON text


def _measured(small: DataFrame) -> tuple[int, int]:
    """Rows and bytes (as JSON text) of a data set."""
    n, size = small.select(F.octet_length(F.to_json(F.struct(*small.columns))).alias("b")) \
        .agg(F.count(F.lit(1)), F.coalesce(F.sum("b"), F.lit(0))).first()
    return n, size


def with_broadcast_set(df: DataFrame, small: DataFrame, name: str, max_bytes: int = MAX_SET_BYTES) -> DataFrame:
    """Make a small data set available to every row, as one array
    column ``name`` (the set travels once per task as a one-row broadcast;
    rows are not multiplied).  The set is measured; one that is larger than
    ``max_bytes`` is refused, it goes block by block (``broadcast_blocks``)."""
    _, size = _measured(small)
    if size > max_bytes:
        raise ValueError(f"a broadcast set of {size} bytes is over the bound of {max_bytes}")
    one = small.agg(F.collect_list(F.struct(*small.columns)).alias(name))
    return df.crossJoin(F.broadcast(one))


def broadcast_blocks(small: DataFrame, order: str, max_bytes: int = MAX_SET_BYTES // 2) -> list[DataFrame]:
    """``small`` in blocks of about ``max_bytes`` by rank of ``order`` (ranges
    of the order, so no window runs over the whole set)."""
    n, size = _measured(small)
    if size <= max_bytes:
        return [small]
    ranged = small.withColumn("_block", order_range(small, order, max(1, n * max_bytes // size)))
    blocks = sorted(r[0] for r in ranged.select("_block").distinct().collect())  # at most MAX_RANGES
    return [ranged.filter(F.col("_block") == k).drop("_block") for k in blocks]


def interval_join(left: DataFrame, right: DataFrame, key_l: str, key_r: str,
                  ts_l: str, ts_r: str, lower_ms: int, upper_ms: int,
                  lower_inclusive: bool = True, upper_inclusive: bool = True) -> DataFrame:
    """J14/J15 (F08 timestamp +/- interval, BETWEEN): keyed interval join ``ts_r in [ts_l + lower, ts_l + upper]``.

    Rows are matched on (key, time bucket): each left row is replicated into
    the buckets its interval touches (at most ceil(span/bucket)+1 of them, a
    fixed constant), so a hot key is spread over many buckets and no per-key
    nested loop forms.
    """
    lower_ms, upper_ms = lower_ms * 1000, upper_ms * 1000   # compare in micros
    span = upper_ms - lower_ms
    bucket = max(span, 1)
    lt = F.unix_micros(F.col(ts_l).cast("timestamp"))
    rt = F.unix_micros(F.col(ts_r).cast("timestamp"))
    lb = left.withColumn("_lo", F.floor((lt + lower_ms) / bucket)) \
             .withColumn("_hi", F.floor((lt + upper_ms) / bucket)) \
             .withColumn("_b", F.explode(F.sequence(F.col("_lo"), F.col("_hi")))) \
             .drop("_lo", "_hi")
    rb = right.withColumn("_rb", F.floor(rt / bucket))
    lo_cond = (rt >= lt + lower_ms) if lower_inclusive else (rt > lt + lower_ms)
    hi_cond = (rt <= lt + upper_ms) if upper_inclusive else (rt < lt + upper_ms)
    cond = (lb[key_l] == rb[key_r]) & (lb["_b"] == rb["_rb"]) & lo_cond & hi_cond
    return lb.join(rb, cond).drop("_b", "_rb")


def asof_join(probe: DataFrame, versions: DataFrame, key_p: str, key_v: str,
              ts_p: str, ts_v: str, bucket_seconds: float | None = None,
              version_order: str | None = None) -> DataFrame:
    """For each probe row the latest version with ``ts_v <= ts_p``
    of the same key (inner: probes without an earlier version are dropped).

    Plan: one tagged union of probes and versions ordered by (ts, versions
    first), scanned for "last version so far" in two levels -- inside each
    (key, time bucket) with a window, and across buckets through a small
    per-(key, bucket) table of each bucket's last version.  Nothing is
    replicated and no window spans a whole key, so hot keys and long-lived
    versions cost no more than their rows.  ``version_order`` breaks ties
    between versions with equal timestamps (the later one wins).
    """
    vcols, pcols = list(versions.columns), list(probe.columns)
    ver_type = versions.select(F.struct(*vcols).alias("v")).schema["v"].dataType
    prb_type = probe.select(F.struct(*pcols).alias("p")).schema["p"].dataType
    tie = F.col(version_order) if version_order else F.lit(0)
    vt = versions.select(F.col(key_v).alias("_k"), F.col(ts_v).cast("timestamp").alias("_t"),
                         F.lit(0).alias("_side"), tie.alias("_tie"),
                         F.struct(*vcols).alias("_ver"), F.lit(None).cast(prb_type).alias("_prb"))
    pt = probe.select(F.col(key_p).alias("_k"), F.col(ts_p).cast("timestamp").alias("_t"),
                      F.lit(1).alias("_side"), F.lit(0).alias("_tie"),
                      F.lit(None).cast(ver_type).alias("_ver"), F.struct(*pcols).alias("_prb"))
    order = ["_t", "_side", "_tie"]
    # about as many rows in a bucket whatever time they span
    ends = vt.select(*order).unionByName(pt.select(*order))
    u = vt.unionByName(pt).withColumn("_bk", order_bucket(ends, order, "_t", bucket_seconds))
    # level 1: last version so far inside each (key, bucket)
    w_in = Window.partitionBy("_k", "_bk").orderBy(*order) \
                 .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    u = u.withColumn("_cur", F.last("_ver", ignorenulls=True).over(w_in))
    # level 2: one row per (key, bucket) with data: the bucket's last version,
    # carried forward to later buckets of the key
    buckets = u.groupBy("_k", "_bk").agg(
        F.max_by("_ver", F.struct(F.col("_ver").isNotNull(), *order)).alias("_bl"))
    w_prev = Window.partitionBy("_k").orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    carry = buckets.withColumn("_carry", F.last("_bl", ignorenulls=True).over(w_prev)).drop("_bl")
    r = join_keys(u.filter((F.col("_side") == 1) & F.col("_k").isNotNull()), carry, ["_k", "_bk"]) \
         .withColumn("_v", F.coalesce("_cur", "_carry")).filter(F.col("_v").isNotNull())
    return r.select(*[F.col(f"_prb.{c}").alias(c) for c in pcols],
                    *[F.col(f"_v.{c}").alias(c) for c in vcols])


def window_join(left: DataFrame, right: DataFrame, key_l: str, key_r: str,
                ts_l: str, ts_r: str, size: str) -> DataFrame:
    """Pairs with equal key inside the same tumbling window."""
    l = left.withColumn("_w", F.window(F.col(ts_l).cast("timestamp"), size).start)
    r = right.withColumn("_wr", F.window(F.col(ts_r).cast("timestamp"), size).start)
    return l.join(r, (l[key_l] == r[key_r]) & (l["_w"] == r["_wr"])) \
            .withColumnRenamed("_w", "window_start").drop("_wr")


def window_cogroup(left: DataFrame, right: DataFrame, key: str, ts: str,
                   size: str, value: str) -> DataFrame:
    """Per (key, tumbling window) both sides' value lists, one side may
    be empty.  A tagged union keeps it a single shuffle."""
    tagged = left.select(key, ts, F.col(value).alias("_v"), F.lit(0).alias("_side")) \
        .unionByName(right.select(key, ts, F.col(value).alias("_v"), F.lit(1).alias("_side")))
    w = F.window(F.col(ts).cast("timestamp"), size)
    return tagged.groupBy(key, w.alias("window")).agg(
        F.collect_list(F.when(F.col("_side") == 0, F.col("_v"))).alias("left_values"),
        F.collect_list(F.when(F.col("_side") == 1, F.col("_v"))).alias("right_values"))


def latest_value_enrich(stream: DataFrame, status: DataFrame, key: str, ts: str,
                        status_col: str) -> DataFrame:
    """J20 (batch twin): each stream row gets the latest status seen so far for
    its key (status rows before or at the same instant); rows with no status
    yet are dropped.  Expressed as an as-of join."""
    return asof_join(stream, status.select(F.col(key).alias("_sk"), F.col(ts).alias("_sts"),
                                           F.col(status_col)),
                     key, "_sk", ts, "_sts").drop("_sk", "_sts")


def lookup_join(df: DataFrame, dim: DataFrame, on, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Preloaded dimension lookup, inner (misses dropped)."""
    return df.join(bounded_broadcast(dim, max_bytes), on, "inner")


def lateral_split(df: DataFrame, col: str, sep: str, out: str = "s",
                  outer: bool = False) -> DataFrame:
    """J22/J23 with D04: lateral table function that splits on ``sep`` and
    yields no rows when the separator is absent.  ``outer`` keeps such rows
    with a null (LEFT JOIN LATERAL ... ON TRUE)."""
    from ..functions.text import java_split
    arr = F.when(F.col(col).contains(sep), java_split(col, _regex_quote(sep))) \
           .otherwise(F.array().cast("array<string>"))
    gen = F.explode_outer(arr) if outer else F.explode(arr)
    return df.withColumn(out, gen)


def _regex_quote(s: str) -> str:
    import re
    return re.escape(s)


def connect_map(a: DataFrame, b: DataFrame, map_a, map_b) -> DataFrame:
    """Map two differently typed inputs to one type and union them."""
    return map_a(a).unionByName(map_b(b))


PAIRS_PER_TASK = 2_000_000  # extended paths that one task tells apart
LIST = 1024  # next vertices that travel together, or so


def path_extend(paths: DataFrame, edges: DataFrame, distinct: bool = False) -> DataFrame:
    """Extend every path ``(src, dst)`` by an edge ``dst -> x``; with
    ``distinct`` each pair ``(src, x)`` once.

    For distinct pairs the next vertices of ``dst`` travel as sorted lists and
    unfold only where all paths of ``src`` meet, so a step's bytes are those of
    compressed lists, not of the many equal pairs.  Sources with more paths than
    a task should hold are paired one by one and meet by pair."""
    p, e = paths.alias("p"), edges.alias("e")
    pairs = p.join(e, F.col("p.dst") == F.col("e.src")) \
             .select(F.col("p.src").alias("src"), F.col("e.dst").alias("dst"))
    if not distinct:
        return pairs
    degree = edges.groupBy(F.col("src").alias("_m")).agg(F.count(F.lit(1)).alias("_n"))
    work = paths.join(degree, F.col("dst") == F.col("_m")).groupBy("src").agg(F.sum("_n").alias("work"))
    total, most = work.agg(F.sum("work"), F.max("work")).first()
    hubs = work.filter(F.col("work") > PAIRS_PER_TASK).select("src")
    kind = edges.schema["dst"].dataType
    lists = edges.join(degree, F.col("src") == F.col("_m")) \
                 .groupBy("_m", F.pmod(F.xxhash64("dst"), F.ceil(F.col("_n") / LIST)).alias("_k")) \
                 .agg(F.sort_array(F.collect_list("dst")).alias("_next"),
                      F.count(F.when(F.col("dst").isNull(), 1)).cast("int").alias("_nulls")) \
                 .select("_m", F.concat("_next", F.array_repeat(F.lit(None).cast(kind), F.col("_nulls"))).alias("_next"))
    some = (most or 0) > PAIRS_PER_TASK
    few = join_keys(paths, hubs, "src", "left_anti") if some else paths
    tasks = max(paths.sparkSession.sparkContext.defaultParallelism, -(-(total or 0) // PAIRS_PER_TASK))
    out = few.join(lists, F.col("dst") == F.col("_m")).select("src", "_next").repartition(tasks, "src") \
             .select("src", F.explode("_next").alias("dst")).distinct()
    return out.unionByName(join_keys(pairs, hubs, "src", "left_semi").distinct()) if some else out
