"""Custom window triggers and evictors as batch operators.

Each works on groups bounded by a time window (key, window) or streams a
key with O(window) state, so no key is collected whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .joins import interval_join
from .keys import join_keys
from .ranges import order_range
from .running import lag_bucketed, running, running_count
from .stateful import KeyedFold, keyed_scan


# ----------------------------------------------------------------- J19 -----
def cogroup_early_fire(left: DataFrame, right: DataFrame, key: str, ts: str, order_id: str,
                       value: str, size: str) -> DataFrame:
    """Tumbling-window co-group that fires on every element once both
    sides were seen in the (key, window), evicts the left elements after
    each such firing, and fires once more at the window end.

    Result per firing: counts and exact sums of the left / right contents.
    Expressed with window functions over (key, window) groups, which are
    bounded by the window length.
    """
    t = lambda d, side: d.select(key, F.col(ts).cast("timestamp").alias("_ts"), F.col(order_id).alias("_id"),
                                 F.col(value).cast("decimal(18,2)").alias("_v"), F.lit(side).alias("_side"))
    u = t(left, "L").unionByName(t(right, "R"))
    u = u.withColumn("window_start", F.window("_ts", size).start)
    g = [key, "window_start"]
    w = Window.partitionBy(*g).orderBy("_ts", "_side", "_id")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    isL, isR = (F.col("_side") == "L").cast("int"), (F.col("_side") == "R").cast("int")
    u = u.withColumn("_k", F.row_number().over(w)) \
         .withColumn("_nl", F.sum(isL).over(run)).withColumn("_nr", F.sum(isR).over(run)) \
         .withColumn("_sl", F.sum(F.when(isL == 1, F.col("_v"))).over(run)) \
         .withColumn("_sr", F.sum(F.when(isR == 1, F.col("_v"))).over(run)) \
         .withColumn("_both", (F.col("_nl") > 0) & (F.col("_nr") > 0))
    u = u.withColumn("_first", F.col("_both") & ~F.coalesce(F.lag("_both").over(w), F.lit(False)))
    fires = u.filter("_both").select(
        *g, F.col("_k").cast("long").alias("fire_seq"), F.lit("both").alias("trigger"),
        F.when(F.col("_first"), F.col("_nl")).otherwise(isL).cast("long").alias("n_left"),
        F.col("_nr").cast("long").alias("n_right"),
        F.when(F.col("_first"), F.col("_sl")).otherwise(F.when(isL == 1, F.col("_v"))).alias("sum_left"),
        F.col("_sr").alias("sum_right"))
    # end of window: left elements after the last firing, all right elements
    last = u.groupBy(*g).agg(
        F.max("_k").alias("_n"), F.max("_nr").alias("_nr"), F.sum(F.when(isR == 1, F.col("_v"))).alias("_sr"),
        F.max(F.when(F.col("_both"), F.col("_k"))).alias("_lastfire"))
    lefts = u.filter(F.col("_side") == "L").select(*g, "_k", "_v")
    tail = join_keys(lefts, last.select(*g, "_lastfire"), g, "inner") \
        .filter(F.col("_lastfire").isNull() | (F.col("_k") > F.col("_lastfire"))) \
        .groupBy(*g).agg(F.count(F.lit(1)).alias("_tl"), F.sum("_v").alias("_tsl"))
    end = join_keys(last, tail, g).select(
        *g, (F.col("_n") + 1).cast("long").alias("fire_seq"), F.lit("end").alias("trigger"),
        F.coalesce(F.col("_tl"), F.lit(0)).cast("long").alias("n_left"), F.col("_nr").cast("long").alias("n_right"),
        F.col("_tsl").alias("sum_left"), F.col("_sr").alias("sum_right"))
    out = fires.unionByName(end)
    return out.withColumn("sum_left", F.col("sum_left").cast("double")) \
              .withColumn("sum_right", F.col("sum_right").cast("double"))


# ----------------------------------------------------------------- T15 -----
class DeltaTriggerFold(KeyedFold):
    """T15 fire detection: the first row only records its distance; a row
    whose distance exceeds the last fired distance by more than
    ``threshold`` fires and becomes the new reference."""

    def __init__(self, threshold: float):
        super().__init__()
        self.threshold = threshold

    def start(self, key):
        self.key, self.last = key, None

    def row(self, rec):
        d = rec["distance"]
        if self.last is None:
            self.last = d
            return []
        if d - self.last > self.threshold:
            self.last = d
            return [(self.key, rec["ts_us"], rec["row_id"])]
        return []

    def finish(self):
        return []


def delta_fires_by_jumps(d: DataFrame, threshold) -> DataFrame:
    """T15 fires of keys whose distance never falls, without a scan along a key.

    Every row points to the row that would fire next if it were the reference
    (the first whose distance exceeds its own by more than the threshold): a
    running minimum over the descending distances finds all of them at once.
    The fires are the rows on the path from a key's first row; pointer
    doubling finds them in as many joins as the path's length has binary
    digits. ``d``: key, ts_us, row_id, distance (exact: decimal or integer)."""
    order = ["ts_us", "row_id"]
    n = running_count(d, ["key"], order, "n", "ts_us", bucket=order_range(d, ["key", *order]))
    n = n.checkpoint(eager=True)
    limit = F.lit(str(threshold)).cast("decimal(38,6)")
    at = F.col("distance").cast("decimal(38,6)")
    ends = (n.select("key", (-at).alias("fall"), F.lit(1).alias("side"), F.col("n").alias("here"), F.col("n").alias("version"))
            .unionByName(n.select("key", (-(at + limit)).alias("fall"), F.lit(0).alias("side"), F.col("n").alias("here"),
                                  F.lit(None).cast("long").alias("version"))))
    # descending; of equal values the probe first, as a row must exceed the limit
    along = ["fall", "side", "here"]
    seen = running(ends, ["key"], along, "version", "min", "next", order_range(ends, ["key", *along]))
    jump = seen.filter("side = 0 and next is not null").select("key", F.col("here").alias("n"), "next").checkpoint(eager=True)
    on_path = n.filter("n = 1").select("key", "n").checkpoint(eager=True)
    reached = 0
    while True:
        more = join_keys(on_path, jump, ["key", "n"], "inner").select("key", F.col("next").alias("n"))
        on_path = on_path.unionByName(more).distinct().checkpoint(eager=True)
        count = on_path.count()
        if count == reached:
            break
        reached = count
        far = jump.select("key", F.col("n").alias("next"), F.col("next").alias("further"))
        jump = join_keys(jump, far, ["key", "next"], "inner").select("key", "n", F.col("further").alias("next")) \
            .checkpoint(eager=True)
    fires = join_keys(n, on_path.filter("n > 1"), ["key", "n"], "inner")
    return fires.select("key", F.col("ts_us").alias("fire_us"), F.col("row_id").alias("fire_id"))


def _delta_fires(d: DataFrame, threshold: float, schema: str, hot_rows: int) -> DataFrame:
    """The fires by a scan per key; keys of more than ``hot_rows`` rows whose
    distances are exact and never fall by jumps, so their rows spread over tasks."""
    def scan(rows: DataFrame) -> DataFrame:
        return keyed_scan(rows, "key", ["ts_us", "row_id"], lambda: DeltaTriggerFold(threshold), schema)

    kind = d.schema["distance"].dataType.typeName()
    hot = d.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > hot_rows).select("key")
    if kind not in ("decimal", "long", "integer", "short", "byte") or hot.isEmpty():
        return scan(d)
    ensure_checkpoint_dir(d.sparkSession)
    own = join_keys(d, hot, "key", "inner").checkpoint(eager=True)
    order = ["ts_us", "row_id"]
    back = lag_bucketed(own, ["key"], order, "distance", "before", order_range(own, ["key", *order]))
    falls = back.filter("distance < before or distance is null").select("key").distinct().checkpoint(eager=True)
    same = lambda keys: d["key"].eqNullSafe(keys["key"])
    jumping = hot.join(falls, hot["key"].eqNullSafe(falls["key"]), "left_anti").checkpoint(eager=True)
    rest = d.join(jumping, same(jumping), "left_anti")
    return scan(rest).unionByName(delta_fires_by_jumps(join_keys(own, jumping, "key", "inner"), threshold))


def top_speed_delta_trigger(df: DataFrame, key: str, ts: str, row_id: str, speed: str, distance: str,
                            threshold: float, evict_ms: int, hot_rows: int = 1_000_000) -> DataFrame:
    """Global window per key + delta trigger on ``distance`` + time
    evictor keeping the last ``evict_ms`` + maxBy(``speed``).

    Fires are found by a sorted keyed scan (O(1) state), of keys over
    ``hot_rows`` rows by pointer doubling; the window content
    at a fire at time T is exactly the key's rows in (T - evict, T] (older rows
    are evicted by then), gathered by a bucketed interval join and reduced
    with ``max_by`` (first row wins ties).
    """
    d = df.select(F.col(key).alias("key"), F.unix_micros(F.col(ts).cast("timestamp")).alias("ts_us"),
                  F.col(row_id).alias("row_id"), F.col(distance).alias("distance"))
    ktype = df.schema[key].dataType.simpleString()
    rtype = df.schema[row_id].dataType.simpleString()
    fires = _delta_fires(d, threshold, f"key {ktype}, fire_us long, fire_id {rtype}", hot_rows)
    rows = df.select(F.col(key).alias("rkey"), F.col(ts).cast("timestamp").alias("rts"),
                     F.col(row_id).alias("rid"), F.col(speed).alias("rspeed"))
    f = fires.withColumn("fts", F.timestamp_micros("fire_us"))
    j = interval_join(f, rows, "key", "rkey", "fts", "rts", -evict_ms, 0, lower_inclusive=False)
    # the fire row itself and rows before it at the same instant; later rows
    # with an equal timestamp are not yet in the window
    j = j.filter((F.col("rts") < F.col("fts")) | (F.col("rid") <= F.col("fire_id")))
    best = F.max_by(F.struct("rid", "rspeed", "rts"),
                    F.struct(F.col("rspeed"), -F.unix_micros("rts"), -F.col("rid")))
    return j.groupBy("key", "fire_id", "fts").agg(best.alias("b")).select(
        F.col("key").alias(key), F.col("fts").alias("fire_time"), F.col("fire_id"),
        F.col("b.rid").alias("max_id"), F.col("b.rspeed").alias("max_speed"))


# ----------------------------------------------------------------- T25 -----
def price_drop_trigger(df: DataFrame, key: str, ts: str, row_id: str, price: str, size_s: int,
                       boundary_s: int, big: float = 0.05, small: float = 0.01) -> DataFrame:
    """Per (key, tumbling window) average price, fired early:

    * a drop of more than ``big`` (fraction of the previous price) fires and
      purges at once;
    * a drop of more than ``small`` registers a timer at the next
      ``boundary_s`` boundary, which fires and purges when reached;
    * whatever is left fires at the window end.

    The window's clock is the event time (replay of the processing-time
    original).  The trigger state is window-scoped, so windows are independent:
    the scan is keyed by (key, window) and a hot key spreads over tasks.
    """
    size_us, bnd_us = size_s * 1_000_000, boundary_s * 1_000_000
    d = df.select(F.col(key).alias("key"), F.unix_micros(F.col(ts).cast("timestamp")).alias("t"),
                  F.col(row_id).alias("rid"), F.col(price).cast("double").alias("p"))
    ktype = df.schema[key].dataType.simpleString()
    schema = f"key {ktype}, ws long, fire_us long, reason string, n long, avg_price double"
    d = d.withColumn("_ws", F.floor(F.col("t") / size_us))
    r = keyed_scan(d, ["key", "_ws"], ["t", "rid"], lambda: PriceDropFold(size_us, bnd_us, big, small), schema)
    return r.select(F.col("key").alias(key), F.timestamp_micros("ws").alias("window_start"),
                    F.timestamp_micros("fire_us").alias("fire_time"), "reason", "n", "avg_price")


class PriceDropFold(KeyedFold):
    """T25 state per key: number and sum of the prices not yet fired, the last
    price and the pending boundary timers; a new window flushes the previous one."""

    def __init__(self, size_us, bnd_us, big, small):
        super().__init__()
        self.size, self.bnd, self.big, self.small = size_us, bnd_us, big, small

    def start(self, key):
        # key is the grouping key, or (key, window index) when scanned per window
        self.key, self.ws = (key[0] if isinstance(key, tuple) else key), None

    def _open(self, ws):
        self.ws, self.n, self.total, self.last, self.timers = ws, 0, 0.0, None, []

    def _emit(self, out, when, why):
        if self.n:
            out.append((self.key, self.ws, when, why, self.n, self.total / self.n))
            self.n, self.total = 0, 0.0

    def _close(self, out):
        end = self.ws + self.size
        for tm in self.timers:
            if tm < end:
                self._emit(out, tm, "timer")
        self._emit(out, end, "end")

    def row(self, rec):
        out = []
        t, p = rec["t"], rec["p"]
        ws = (t // self.size) * self.size
        if self.ws != ws:
            if self.ws is not None:
                self._close(out)
            self._open(ws)
        while self.timers and self.timers[0] <= t:
            self._emit(out, self.timers.pop(0), "timer")
        self.n, self.total = self.n + 1, self.total + p
        if self.last is not None:
            if self.last - p > self.last * self.big:
                self._emit(out, t, "drop")
            elif self.last - p > self.last * self.small:
                nt = (t // self.bnd + 1) * self.bnd
                if nt not in self.timers:
                    self.timers.append(nt)
                    self.timers.sort()
        self.last = p
        return out

    def finish(self):
        out = []
        if self.ws is not None:
            self._close(out)
        return out
