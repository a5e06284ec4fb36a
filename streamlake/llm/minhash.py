"""Near-duplicate groups with a MinHash LSH forest.

Each document is the set of its distinct 5-word shingles. Equal sets are
collapsed first. Every tree of the forest sorts the distinct sets by their
own ``LEVELS`` minima (a range-partitioned sort, so a dense region spreads
over tasks); candidates are the neighbours in that order with a common prefix
of at least ``least`` minima: the ``NEAR`` rows before a row, and for each
prefix length the first row of its region (a dense region so compares at the
depth where it branches, a sparse one at the least depth). Their number is
linear in the rows. Rows beside a partition's border are compared again. Sets
in a region of more than ``NEAR`` + 1 rows (there not all pairs are candidates)
are marked as crowded, and ``complete`` finds all links between them.

Candidates are confirmed on the full sets in two rounds: first each set's
deepest candidate; then only those that would join different components, so
a group of n near copies costs about n comparisons. Components come from
alternating large-star and small-star steps, checkpointed each.

Crowded sets then go through an exact prefix-filter join: a pair at the
threshold shares one of the ``n - ceil(percent * n) + 1`` rarest shingles of
both sets. Only shingles that stand in several components go on; their sets
meet the one with the fewest rarer shingles first (the base of a star), and
what is still apart is compared in full, salted, under exact size, position
and parity filters. Each step only joins components, none leaves out a pair
that could.

Defined results: null and empty texts, or texts of white space, have the
empty set and are linked with nothing; a null id is never reported as a
component while the component has an id; repeated rows are documents with
equal sets; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from . import marks
from .common import arrow_rows, trimmed, write_table
from .words import shingle_sets, text_chunks

TREES, LEVELS, LEAST, NEAR = 20, 8, 4, 3
CELLS = 20  # bits of the cells that count shingles for their order
PARITY = 8  # words of 64 bits that hold a set's parities
BATCH_ROWS = 2000  # texts or pairs of sets that a worker holds
SALT_ROWS = 1000  # rows of a shingle that are compared in one piece
_rng = np.random.default_rng(85)
_A = _rng.integers(1, 1 << 32, TREES * LEVELS, dtype=np.uint32) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, TREES * LEVELS, dtype=np.uint32)


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """Two bytes of each of the TREES * LEVELS minima, per (non-empty) set."""
    x = np.concatenate(sets)
    x = (x >> np.uint64(32)).astype(np.uint32) ^ x.astype(np.uint32)
    at = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), len(_A)), np.dtype(">u2"))
    for k, (a, b) in enumerate(zip(_A, _B)):
        low = np.minimum.reduceat(x * a + b, at)
        out[:, k] = (low ^ (low >> np.uint32(16))) & np.uint32(0xFFFF)
    return out


def _set_key(s: np.ndarray) -> bytes:
    return hashlib.md5(s.tobytes()).digest()


def signatures(rows: DataFrame, width: int) -> DataFrame:
    """``rows`` (file, at, id, text) with ``key`` (128-bit digest of the set,
    null for the empty set), ``n`` and ``sig`` instead of the text."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in text_chunks(batch.column("text")):
                sets = shingle_sets(texts, width)
                full = [s for s in sets if len(s)]
                sig = iter(minima(full) if full else [])
                keys = [_set_key(s) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(done, len(texts)) for c in ("file", "at", "id")), pa.array(keys, pa.binary()),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([next(sig).tobytes() if len(s) else None for s in sets], pa.binary())],
                    ["file", "at", "id", "key", "n", "sig"])
                done += len(texts)

    return rows.select("file", "at", "id", "text").mapInArrow(
        trimmed(sign), f"file string, at long, id {dict(rows.dtypes)['id']}, key binary, n long, sig binary")


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the rows of two matrices."""
    return np.cumprod(a == b, axis=1).sum(axis=1)


def neighbours(batches: Iterator[pa.RecordBatch], least: int = LEAST) -> Iterator[pa.RecordBatch]:
    """Candidates among rows (tree, path, node) in sorted order: ``a, b,
    depth``, with ``path`` set the first and last rows (border rows), and with
    ``a`` alone the nodes in regions of more than NEAR + 1 rows."""
    shape = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("depth", pa.int32()), ("tree", pa.int32()),
                       ("path", pa.binary())])

    def pairs(a: np.ndarray, b: np.ndarray, depth: np.ndarray) -> pa.RecordBatch:
        n = len(a)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(depth.astype(np.int32)),
             pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], schema=shape)

    def marked(nodes: np.ndarray) -> pa.RecordBatch:
        n = len(nodes)
        return pa.RecordBatch.from_arrays([pa.array(nodes), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()),
                                           pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], schema=shape)

    def border(rows: np.ndarray, nodes: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes), pa.nulls(len(nodes), pa.int64()), pa.nulls(len(nodes), pa.int32()),
             pa.array(rows[:, 0].astype(np.int32)),
             pa.array([r.astype(">u2").tobytes() for r in rows[:, 1:]], pa.binary())], schema=shape)

    rows, nodes = np.zeros((0, LEVELS + 1), np.int32), np.zeros(0, np.int64)  # the last NEAR + 1 rows
    heads = np.zeros(LEVELS + 1, np.int64)  # first node of the running region, by depth
    first = True
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        path = np.frombuffer(b"".join(batch.column("path").to_pylist()), ">u2").reshape(n, LEVELS)
        new = np.column_stack([batch.column("tree").to_numpy(), path]).astype(np.int32)
        ids = batch.column("node").to_numpy()
        kept = len(rows)
        rows, nodes = np.concatenate([rows, new]), np.concatenate([nodes, ids])
        if first:
            yield border(new[:NEAR + 1], ids[:NEAR + 1])
            first = False
        here = np.arange(kept, kept + n)
        before = np.full(n, -1)  # common prefix with the row before
        if len(rows) > 1:
            with_before = here[here > 0]
            before[-len(with_before):] = _common(rows[with_before], rows[with_before - 1]) - 1
        for back in range(1, NEAR + 1):
            k = here[here >= back]
            depth = _common(rows[k], rows[k - back]) - 1
            ok = depth >= least
            if ok.any():
                yield pairs(nodes[k[ok]], nodes[k[ok] - back], depth[ok])
        far = here[here > NEAR]
        far = far[_common(rows[far], rows[far - NEAR - 1]) > least]
        if len(far):
            yield marked(np.unique(nodes[far[:, None] - np.arange(NEAR + 2)]))
        for d in range(least, LEVELS + 1):
            starts = before < d
            at = np.maximum.accumulate(np.where(starts, np.arange(n), -1))
            lead = np.where(at >= 0, ids[at], heads[d])
            heads[d] = lead[-1]
            ok = (lead != ids) & ~starts
            if ok.any():
                yield pairs(ids[ok], lead[ok], np.full(ok.sum(), d))
        rows, nodes = rows[-NEAR - 1:], nodes[-NEAR - 1:]
    if not first:
        yield border(rows, nodes)


def candidates(nodes: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs ``a < b`` with the greatest ``depth`` of any tree, and
    the crowded nodes."""
    order = ["tree", "path", "node"]
    paths = nodes.select("node", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"), "sig").select(
        "tree", F.expr(f"substring(sig, tree * {2 * LEVELS} + 1, {2 * LEVELS})").alias("path"), "node")
    found = write_table(paths.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        lambda rows: neighbours(rows, least), "a long, b long, depth int, tree int, path binary"), "forest")
    # border rows are few for each partition; they are compared in order, tree by tree
    border = found.filter("path is not null").select("tree", "path", F.col("a").alias("node"))
    around = (border.repartition("tree").sortWithinPartitions(*order).mapInArrow(
        lambda rows: neighbours(rows, least), "a long, b long, depth int, tree int, path binary"))
    both = found.filter("path is null").unionByName(around.filter("path is null"))
    return (both.filter("a < b").groupBy("a", "b").agg(F.max("depth").alias("depth")),
            both.filter("b is null").select(F.col("a").alias("node")).distinct())


def shingle_table(rows: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``node, set`` (packed 64-bit hashes) for the ``rows`` (file, at, text)
    that ``wanted`` (file, at, node) names."""
    node_of = marks.save(wanted, "forest-wanted").reader()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = node_of(batch.column("file"), batch.column("at"))
            own = batch.filter(node.is_valid())
            nodes = node.drop_null().field("node")
            done = 0
            for texts in text_chunks(own.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [nodes.slice(done, len(texts)),
                     pa.array([s.tobytes() for s in shingle_sets(texts, width)], pa.binary())], ["node", "set"])
                done += len(texts)

    return write_table(rows.select("file", "at", "text").mapInArrow(trimmed(packed), "node long, set binary"), "forest-sets")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs with 100 * intersection >= percent * union, on the full sets."""
    @pandas_udf("boolean")
    def alike(left, right):
        import pandas as pd
        out = np.zeros(len(left), bool)
        for k, (x, y) in enumerate(zip(left, right)):
            small, large = (x, y) if len(x) <= len(y) else (y, x)
            if 100 * len(small) < percent * len(large):
                continue
            p, q = np.frombuffer(small, np.uint64), np.frombuffer(large, np.uint64)
            at = np.minimum(np.searchsorted(q, p), len(q) - 1)
            both = int((q[at] == p).sum())
            out[k] = 100 * both >= percent * (len(p) + len(q) - both)
        return pd.Series(out)

    left = sets.select(F.col("node").alias("a"), F.col("set").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("set").alias("right"))
    return write_table(pairs.select("a", "b").join(left, "a").join(right, "b")
                       .filter(alike("left", "right")).select("a", "b"), "forest-links")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` (the smallest node of its component) for all ends of
    ``edges`` (a, b), by alternating large-star and small-star steps."""
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    now = write_table(now, "stars")
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u != v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = (joined.select("u", F.col("m").alias("v"))
                 .unionByName(joined.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")))
                 .filter("u != v").distinct())
        now = write_table(small, "stars")
        new = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == mark:
            break
        mark = new
    roots = now.select("v").distinct()
    return (now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("root"))))


def rare_shingles(sets: DataFrame, percent: int) -> DataFrame:
    """``token, node, pos, n``: of each set (node, set) the rarest shingles
    (token) of which a pair at the threshold shares one, with their place in the
    set's order. The order is by the shingle's count in a table of fixed size,
    then by hash: any order common to all sets is right, a rare-first one is short."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(1 << CELLS, np.int64)
        for batch in batches:
            for s in batch.column("set").to_pylist():
                np.add.at(held, (np.frombuffer(s, np.uint64) >> np.uint64(64 - CELLS)).astype(np.int64), 1)
        cells = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(held[cells])], ["cell", "held"])

    # at most 2 ** CELLS rows
    counts = (sets.select("set").mapInArrow(count, "cell long, held long").groupBy("cell")
              .agg(F.sum("held").alias("held")).toArrow())
    ranks = np.zeros(1 << CELLS, np.uint8)
    ranks[counts.column("cell").to_numpy()] = np.minimum(8 * np.log2(counts.column("held").to_numpy()), 255)
    shared = sets.sparkSession.sparkContext.broadcast(ranks)

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, s in zip(batch.column("node").to_pylist(), batch.column("set").to_pylist()):
                s = np.frombuffer(s, np.uint64)
                taken = len(s) + percent * -len(s) // 100 + 1
                rank = shared.value[(s >> np.uint64(64 - CELLS)).astype(np.int64)]
                tokens = s[np.lexsort((s, rank))[:taken]].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens), pa.array(np.full(len(tokens), node)),
                     pa.array(np.arange(len(tokens), dtype=np.int32)),
                     pa.array(np.full(len(tokens), len(s), np.int32))], ["token", "node", "pos", "n"])

    return sets.select("node", "set").mapInArrow(trimmed(rarest), "token long, node long, pos int, n int")


def parities(sets: DataFrame) -> DataFrame:
    """``node, parity``: bit k tells whether an odd number of the set's hashes
    fall into class k. Two sets differ in at least as many shingles as bits."""
    @pandas_udf("array<long>")
    def parity(column):
        import pandas as pd
        bits = 64 * PARITY
        return pd.Series([np.packbits(np.bincount((np.frombuffer(s, np.uint64) % np.uint64(bits)).astype(np.int64),
                                                  minlength=bits) & 1).view(np.int64) for s in column])

    return sets.select("node", parity("set").alias("parity"))


def complete(crowded: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``old, root``: how the components of ``roots`` (node, root) that hold
    crowded nodes join when all pairs of crowded sets are linked that are alike."""
    state = write_table(crowded.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("old"))
                        .withColumn("root", F.col("old")), "crowded")
    own = write_table(sets.join(crowded, "node", "left_semi"), "crowded-sets")
    tokens = write_table(rare_shingles(own, percent), "crowded-shingles")
    used = None

    def apart() -> tuple[DataFrame, DataFrame]:
        """Rows of shingles that stand in several components, and these shingles."""
        rows = tokens.join(state.select("node", "root"), "node")
        hub = F.struct("pos", "node", "root", "n")
        if used is not None:
            rows = rows.join(used.withColumn("was", F.lit(True)), "node", "left")
            hub = F.when(F.col("was").isNull(), hub)
        wide = (rows.groupBy("token", "root").agg(F.count(F.lit(1)).alias("c"), F.min(hub).alias("hub"))
                .groupBy("token").agg(F.sum("c").alias("rows"), F.count(F.lit(1)).alias("roots"),
                                      F.max(F.struct("c", "root")).alias("most"), F.min("hub").alias("hub"))
                .filter("roots > 1").select("token", "rows", F.col("most.root").alias("main"), "hub"))
        wide = write_table(wide, "crowded-open")
        return write_table(rows.select("token", "node", "pos", "n", "root").join(wide.select("token"), "token"),
                           "crowded-rows"), wide

    def may_link(n: str, pos: str, m: str, at: str) -> str:
        """Sizes allow the similarity, and so does what follows a first common shingle."""
        return (f"100L * least({n}, {m}) >= {percent}L * greatest({n}, {m}) and "
                f"{100 + percent}L * least({n} - {pos}, {m} - {at}) >= {percent}L * ({n} + {m})")

    def merged(pairs: DataFrame) -> DataFrame:
        links = confirm(pairs, own, percent)
        root = lambda end: state.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
        edges = links.join(root("a"), "a").join(root("b"), "b").select(F.col("root_a").alias("a"),
                                                                       F.col("root_b").alias("b"))
        joined = components(edges).select(F.col("node").alias("root"), F.col("root").alias("new"))
        return write_table(state.join(joined, "root", "left")
                           .select("node", "old", F.coalesce("new", "root").alias("root")), "crowded")

    def pair(a: str, b: str) -> list[Column]:
        return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]

    last = None
    while True:
        rows, wide = apart()
        left = rows.count()
        if not left:
            break
        if last is None or 2 * left <= last:  # a round pays while it halves the rows
            last = left
            near = (rows.join(wide.filter("hub is not null").select("token", "hub"), "token")
                    .filter("root != hub.root").filter(may_link("n", "pos", "hub.n", "hub.pos")))
            state = merged(near.select(*pair("node", "hub.node")).distinct())
            hubs = wide.filter("hub is not null").select("hub.node").distinct()
            used = write_table(hubs if used is None else used.unionByName(hubs).distinct(), "crowded-hubs")
            continue
        # all pairs of different components: one of them is not of the shingle's main component
        rows = (rows.join(parities(own), "node").join(wide.select("token", "rows", "main"), "token")
                .withColumn("pieces", F.ceil(F.col("rows") / SALT_ROWS).cast("int")))
        one = rows.withColumn("salt", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int")).alias("x")
        other = (rows.filter("root != main")
                 .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).alias("y"))
        differ = " + ".join(f"bit_count(x.parity[{k}] ^ y.parity[{k}])" for k in range(PARITY))
        near = one.join(other, F.expr(
            "x.token = y.token and x.salt = y.salt and x.root != y.root and (x.root = x.main or x.node < y.node) and "
            f"{may_link('x.n', 'x.pos', 'y.n', 'y.pos')} and "
            f"{100 + percent}L * ({differ}) <= {100 - percent}L * (x.n + y.n)"))
        state = merged(write_table(near.select(*pair("x.node", "y.node")).distinct(), "crowded-pairs"))
        break
    return state.select("old", "root").distinct()


def linked(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int,
           least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Two written tables: ``file, at, id, key, n`` of every row of ``docs``
    (from ``marks.scan``), and ``key, id, root`` of every set (its smallest id,
    the number of its component)."""
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        return _linked(docs, id_col, text_col, width, percent, least)


def _linked(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int,
            least: int) -> tuple[DataFrame, DataFrame]:
    rows = marks.placed(docs).select("file", "at", F.col(f"row.{id_col}").alias("id"), F.col(f"row.{text_col}").alias("text"))
    members = write_table(signatures(rows, width), "forest-documents")
    nodes = write_table(members.filter("key is not null").groupBy("key")
                        .agg(F.min("id").alias("id"), F.min(F.struct("file", "at")).alias("place"),
                             F.any_value("sig").alias("sig"))
                        .withColumn("node", F.monotonically_increasing_id()), "forest-nodes")
    pairs, crowded = candidates(nodes, least)
    pairs, crowded = write_table(pairs, "forest-candidates"), write_table(crowded, "forest-crowded")

    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = nodes.select("node", "place").join(ends, "node", "left_semi").select("place.file", "place.at", "node")
    sets = shingle_table(rows, wanted, width)

    # round one: the deepest candidate of each set; equal depths are spread by a hash
    best = (pairs.select("a", "b", "depth", F.col("a").alias("node"))
            .unionByName(pairs.select("a", "b", "depth", F.col("b").alias("node")))
            .groupBy("node").agg(F.max(F.struct("depth", F.xxhash64("a", "b").alias("h"), "a", "b")).alias("x"))
            .select("x.a", "x.b").distinct())
    links = confirm(best, sets, percent)
    first = write_table(components(links), "forest-components")
    # round two: what would join two components
    root = lambda end: first.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
    other = (pairs.join(root("a"), "a", "left").join(root("b"), "b", "left")
             .filter(~F.coalesce(F.col("root_a"), F.col("a")).eqNullSafe(F.coalesce(F.col("root_b"), F.col("b"))))
             .select("a", "b").join(best, ["a", "b"], "left_anti"))
    more = confirm(other, sets, percent)
    joined = components(first.filter("node != root").select(F.col("node").alias("a"), F.col("root").alias("b"))
                        .unionByName(more))
    roots = nodes.select("node", "key", "id").join(joined, "node", "left").select(
        "node", "key", "id", F.coalesce("root", "node").alias("root"))
    if not crowded.isEmpty():
        roots = write_table(roots, "forest-roots")
        further = complete(crowded, roots.select("node", "root"), sets, percent)
        roots = roots.join(further.withColumnRenamed("root", "new"), F.col("root") == F.col("old"), "left").select(
            "key", "id", F.coalesce("new", "root").alias("root"))

    return members.drop("sig"), write_table(roots.select("key", "id", "root"), "forest-roots")


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
          percent: int = 85, least: int = LEAST) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id`` (the
    smallest id of the component), ``kept`` (whether that is the row's id) and
    ``key`` (digest of the shingle set, null for the empty set)."""
    members, roots = linked(marks.scan(docs, "forest-rows"), id_col, text_col, width, percent, least)
    lowest = roots.groupBy("root").agg(F.min("id").alias("component_id"))
    of_key = roots.join(lowest, "root").select("key", "component_id")
    return members.select("id", "key", "n").join(of_key, "key", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(F.col("key").isNull(), F.lit(True))
        .otherwise(F.col("id").eqNullSafe(F.col("component_id"))).alias("kept"), "key")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                     percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component (the smallest id,
    of equal ids the first by position), and all rows with an empty set. Texts
    stay where they are: a scan learns by position which of its rows go."""
    docs = marks.scan(docs, "forest-rows")
    members, roots = linked(docs, id_col, text_col, width, percent)
    own = write_table(members.select("file", "at", "id", "key").join(roots.select("key", "root"), "key")
                      .select("file", "at", "id", "root"), "forest-members")
    kept = own.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "file", "at")).alias("k"))
    kept = kept.select("k.file", "k.at")
    return marks.without(docs, own.select("file", "at").join(kept, ["file", "at"], "left_anti"), "forest-gone")
