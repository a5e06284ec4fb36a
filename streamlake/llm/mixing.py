"""Mixing sources to target weights by entropy balancing.

Every source has a token constraint: the documents' rates r times their sizes
add up to the source's target. Among rates in [0, cap] the ones closest to 1
in (bounded) relative entropy are exponential tilts,

    r = cap * e^(lambda * x) / (cap - 1 + e^(lambda * x)),   x = size / largest size,

with one multiplier per source. The convex dual is solved for all sources at
once by Newton steps over the histogram (source, size, documents), which holds
all that the dual depends on and is far smaller than the corpus; each step is
one aggregation. A bracket per source keeps the steps safe.

Rates become copies by floor(r + u + t): u is a hash of the document's id, size
and number among equal ones (rows of equal id, source and size are numbered, so
a crowd of them gains copies one by one), t a shift per source, found by
refining a histogram of the places where some document gains a copy, so that
the words taken stay below the target by less than one document. Further rounds let only documents that fit into what is
missing gain copies, so the gap shrinks to that of a small document.

Targets: sources by code point, null last, weigh ``weights`` in turn and share
all words; a target stops at cap times its source's size and the excess is
shared by weight again. That is target = min(cap * size, weight * theta).

Defined results: a null text has size 0, takes nothing and counts in its
source; null sources form one source; repeated rows are documents of their own,
whose copies may differ (in ``mix`` they cannot be told apart, ``repeat_rows``
numbers them by their position); an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from . import marks
from .common import word_count, write_table

CELLS = 65536  # cells of a refinement of the shift
PASSES = 2  # refinements: 65536 ** -2 of the range holds a few documents at most
ROUNDS = 4  # fillings with ever smaller documents
RUN = 4096  # equal rows that are numbered together
SALTS = 64  # parts in which many equal rows are numbered
EQUAL = ["id", "source", "size"]


def targets(sizes: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    """``sizes``: source, source_size. Adds ``sid``, ``weight`` and ``target``."""
    ranked = sizes.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("sid") % len(weights) + 1).cast("int"))
    w = (ranked.withColumn("weight", weight)
         .withColumn("most", F.lit(float(cap)) * F.col("source_size"))
         .withColumn("ratio", F.col("most") / F.col("weight")))
    order = Window.orderBy("ratio", "sid")
    before = F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.partitionBy(F.lit(0))
    total = F.sum("source_size").over(everything)
    # with the k smallest ratios at their cap the others would share theta; the largest theta holds
    theta = F.max("level").over(everything)
    return (w.withColumn("level", (total - before) / left)
            .withColumn("target", F.least("most", F.col("weight") * theta))
            .select("source", "sid", "source_size", "weight", "target"))


def _rate(lam: Column, x: Column, cap: float) -> Column:
    e = F.exp(F.least(F.greatest(lam * x, F.lit(-700.0)), F.lit(700.0)))
    return F.lit(cap) * e / (F.lit(cap - 1.0) + e)


def solve(hist: DataFrame, state: DataFrame, cap: float, tolerance: float = 1e-9, steps: int = 100) -> DataFrame:
    """Multipliers per source: ``sid, top, lam`` (null where no multiplier
    exists: an empty source, or one at its cap). ``hist``: sid, size, docs.
    Each Newton step is written; ``steps`` bounds a loop that ends by its
    tolerance, and what remains is corrected when the rates are rounded."""
    now = state.select("sid", "top", "target",
                       F.when((F.col("target") > 0) & (F.col("target") < cap * F.col("source_size") * (1 - 1e-12)),
                              F.lit(0.0)).alias("lam"),
                       F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"),
                       F.lit(1.0).alias("gap"))
    now = write_table(now, "mix-step", 1)
    for _ in range(steps):
        x = F.col("size") / F.col("top")
        rate = _rate(F.col("lam"), x, cap)
        sums = hist.join(now.filter("lam is not null").select("sid", "top", "lam"), "sid")
        sums = sums.groupBy("sid").agg(
            F.sum(F.col("docs") * x * rate).alias("got"),
            F.sum(F.col("docs") * x * x * rate * (F.lit(cap) - rate) / cap).alias("slope"))
        g = F.col("got") - F.col("target") / F.col("top")
        low = F.when(g < 0, F.col("lam")).otherwise(F.col("low"))
        high = F.when(g > 0, F.col("lam")).otherwise(F.col("high"))
        newton = F.col("lam") - g / F.col("slope")
        inside = (F.coalesce(newton > low, F.lit(True)) & F.coalesce(newton < high, F.lit(True))
                  & (F.abs(newton - F.col("lam")) <= 4 + 4 * F.abs(F.col("lam"))))
        step = (F.when(g == 0, F.col("lam")).when(inside, newton)
                .when(low.isNotNull() & high.isNotNull(), (low + high) / 2)
                .otherwise(F.col("lam") - F.signum(g) * (4 + 4 * F.abs(F.col("lam")))))
        seen = Observation()  # the largest gap, without another query
        now = write_table(now.join(sums, "sid", "left").select(
            "sid", "top", "target", F.when(F.col("lam").isNotNull(), step).alias("lam"),
            low.alias("low"), high.alias("high"),
            F.coalesce(F.abs(g) * F.col("top") / F.col("target"), F.lit(0.0)).alias("gap"))
            .observe(seen, F.max("gap").alias("gap")), "mix-step", 1)
        if (seen.get.get("gap") or 0.0) <= tolerance:
            break
    # rounded: sums of doubles depend on their order in the last digits, reruns must agree
    return now.select("sid", "top", F.round("lam", 8).alias("lam"))


def _shifts(rows: DataFrame, state: DataFrame, cap: int) -> DataFrame:
    """``sid, limit_0, shift_0, limit_1, ...``: documents of at most ``limit_r``
    words gain the copies up to ``shift_r``. Round 0 concerns all documents and
    stops below the target; each further one fills what is missing with one
    more copy of documents of at most a quarter of that."""
    # a document gains its j-th copy at shift j - (rate + u), in (-cap, cap]
    gains = (rows.filter("size > 0")
             .select("sid", "size", F.explode(F.array(*[F.lit(float(j)) - F.col("level")
                                                        for j in range(1, cap + 1)])).alias("at")))
    low, width = -float(cap) - 0.5, 2.0 * cap + 1
    known = state.select("sid", F.col("target").alias("need"))
    for r in range(ROUNDS):
        known = known.withColumn(f"limit_{r}", F.col("need") / 4 if r else F.lit(float("inf")))
        open_ = gains.join(known.drop("need"), "sid").filter(F.col("size") <= F.col(f"limit_{r}"))
        if r:
            open_ = open_.filter((F.col("at") > F.col(f"shift_{r - 1}")) & (F.col("at") <= F.col("shift_0") + 1))
        open_ = open_.select("sid", "size", "at")
        cell = known.select("sid", "need", F.lit(low).alias("low"), F.lit(width).alias("width"))
        for p in range(PASSES):
            inside = (open_.join(cell.select("sid", "low", "width"), "sid")
                      .withColumn("k", F.floor((F.col("at") - F.col("low")) / F.col("width") * CELLS))
                      .filter(f"k >= 0 and k < {CELLS}")
                      .groupBy("sid", "k").agg(F.sum("size").alias("words")))
            upto = Window.partitionBy("sid").orderBy("k")
            over = (inside.withColumn("sum", F.sum("words").over(upto)).join(cell.select("sid", "need"), "sid")
                    .groupBy("sid").agg(F.min(F.when(F.col("sum") > F.col("need"), F.struct("k", "sum", "words")))
                                        .alias("c"), F.sum("words").alias("all")))
            # if no cell exceeds the need, all gains of the range are taken and the cell moves past it
            cell = cell.join(over, "sid", "left").select(
                "sid", F.when(F.col("c").isNull(), F.col("need") - F.coalesce("all", F.lit(0)))
                .otherwise(F.col("need") - F.col("c.sum") + F.col("c.words")).alias("need"),
                (F.col("low") + F.coalesce(F.col("c.k").cast("double"), F.lit(float(CELLS))) * F.col("width") / CELLS)
                .alias("low"), (F.col("width") / CELLS).alias("width"))
            if p < PASSES - 1:
                cell = write_table(cell, "mix-cells", 1)
        known = write_table(known.drop("need").join(
            cell.select("sid", "need", F.col("low").alias(f"shift_{r}")), "sid"), "mix-shifts", 1)
    return known.drop("need")


def fit(sized: DataFrame, weights: tuple[float, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """Per source what its documents' copies follow from: ``source, sid,
    source_size, target, top, lam`` and the shifts. ``sized``: id, source, size, num."""
    counts = write_table(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("docs")), "mix-histogram")
    sizes = write_table(counts.groupBy("source").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size"),
                                                     F.max("size").alias("top")), "mix-sources", 1)
    state = write_table(targets(sizes.drop("top"), weights, cap).alias("t")
                        .join(sizes.alias("s"), F.col("t.source").eqNullSafe(F.col("s.source")))
                        .select("t.source", "sid", "t.source_size", "target", "top"), "mix-targets", 1)
    hist = _of_source(counts, state.select("source", "sid")).select("sid", "size", "docs")
    params = write_table(state.join(solve(hist, state, float(cap)), ["sid", "top"]), "mix-multipliers", 1)
    levels = _level(_of_source(sized, params), cap).select("sid", "size", "level")
    return write_table(params.join(_shifts(write_table(levels, "mix-levels"), state, cap), "sid"), "mix-parameters", 1)


def _of_source(rows: DataFrame, params: DataFrame) -> DataFrame:
    """Join on the source, null with null."""
    own = params.withColumnRenamed("source", "_source")
    return rows.join(own, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def _level(rows: DataFrame, cap: int) -> DataFrame:
    """Adds ``rate`` and ``level`` = rate + a hash of (id, size, num) in [0, 1).
    A source at its cap takes everything cap times, one without target nothing."""
    rate = (F.when(F.col("lam").isNotNull(), _rate(F.col("lam"), F.col("size") / F.col("top"), float(cap)))
            .when(F.col("target") > 0, F.lit(float(cap))).otherwise(F.lit(0.0)))
    unit = F.shiftrightunsigned(F.xxhash64(F.lit("mix"), "id", "size", "num"), 11).cast("double") / F.lit(float(1 << 53))
    return rows.withColumn("rate", rate).withColumn("level", F.col("rate") + unit)


def with_copies(rows: DataFrame, params: DataFrame, cap: int = 3) -> DataFrame:
    """Adds the parameters of its source, ``rate`` and ``copies`` to every row
    (id, source, size, num, ...). Documents without words stay once."""
    shift = F.col("shift_0")
    for r in range(1, ROUNDS):
        shift = F.when(F.col("size") <= F.col(f"limit_{r}"), F.col(f"shift_{r}")).otherwise(shift)
    # as many copies as the places j - level that lie below the shift, one more than in round 0 at most
    below = lambda upto: sum((F.when(F.lit(float(j)) - F.col("level") < upto, 1).otherwise(0)
                              for j in range(1, cap + 1)), F.lit(0))
    copies = F.least(below(shift), below(F.col("shift_0") + 1))
    return (_level(_of_source(rows, params), cap)
            .withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(F.lit(1))))


def _sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """Distinct ``id, source, size`` and their number of rows ``n``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                       word_count(F.col(text_col)).alias("size"))
    return write_table(rows.groupBy(*EQUAL).agg(F.count(F.lit(1)).alias("n")), "mix-sizes")


def numbered(equal: DataFrame) -> DataFrame:
    """One row per document of ``equal`` (id, source, size, n): ``num`` counts
    equal ones from 0. Runs of many equal rows are dealt out before they unfold."""
    few = equal.filter(F.col("n") <= RUN).select(
        *EQUAL, F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("num"))
    runs = (equal.filter(F.col("n") > RUN)
            .select(*EQUAL, "n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / RUN))).alias("run"))
            .repartition(F.xxhash64(*EQUAL, "run")))
    many = runs.select(*EQUAL, F.explode(F.sequence(F.col("run") * RUN, F.least(F.col("run") * RUN + RUN, "n") - 1)).alias("num"))
    return few.unionByName(many)


def mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), cap: int = 3, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: id, ``source``, ``size``, ``source_size``,
    ``target``, ``rate``, ``copies`` (0 to ``cap``) and ``taken`` = copies * size."""
    sized = numbered(_sizes(docs, id_col, text_col, source_col))
    return with_copies(sized, fit(sized, weights, cap), cap).select(
        F.col("id").alias(id_col), "source", "size", "source_size", "target", "rate", "copies",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def _numbers(rows: DataFrame, equal: DataFrame) -> DataFrame:
    """``file, at, num`` for the ``rows`` (file, at, id, source, size) that equal
    others: numbered by position within salted parts, and the parts in order."""
    crowd = equal.filter("n > 1").select(*[F.col(c).alias(f"_{c}") for c in EQUAL])
    same = F.col("id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source")) & F.expr("size = _size")
    own = rows.join(crowd, same, "left_semi").withColumn("salt", F.pmod(F.xxhash64("file", "at"), F.lit(SALTS)))
    own = write_table(own.withColumn("k", F.row_number().over(
        Window.partitionBy(*EQUAL, "salt").orderBy("file", "at"))), "mix-equal")
    parts = own.groupBy(*EQUAL, "salt").agg(F.max("k").cast("long").alias("held"))
    before = F.sum("held").over(Window.partitionBy(*EQUAL).orderBy("salt")) - F.col("held")  # SALTS rows at most
    parts = parts.select(*[F.col(c).alias(f"_{c}") for c in EQUAL], F.col("salt").alias("_salt"), before.alias("before"))
    return (own.join(parts, same & F.expr("salt = _salt"))
            .select("file", "at", (F.col("before") + F.col("k") - 1).alias("num")))


def repeat_rows(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), cap: int = 3, id_col: str = "doc_id",
                text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: every row of ``docs`` ``copies`` times (0: not at all).
    Texts stay where they are; only the parameters travel."""
    docs = marks.scan(docs, "mix-documents")
    row = marks.placed(docs).select("row", "file", "at", F.col(f"row.{id_col}").alias("id"),
                                    F.col(f"row.{source_col}").alias("source"),
                                    word_count(F.col(f"row.{text_col}")).alias("size"))
    equal = _sizes(docs, id_col, text_col, source_col)
    params = fit(numbered(equal), weights, cap)
    if equal.filter("n > 1").isEmpty():
        row = row.withColumn("num", F.lit(0).cast("long"))
    else:
        number = marks.save(_numbers(row.drop("row"), equal), "mix-numbers")
        row = row.withColumn("num", F.coalesce(number.of(F.col("file"), F.col("at"))["num"], F.lit(0)))
    return (with_copies(row, params, cap).filter("copies > 0")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*"))
