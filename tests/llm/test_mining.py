"""Hard negatives against brute force in exact integers."""

import duckdb
import numpy as np
import pytest
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from streamlake.llm import jobs, mining

SCHEMA = ("vec_id long, embedding array<double>, label int, id string, g string, h string, uid string, q string, "
          "anchor string, dim string, k string, p string")


def frame(ctx, rows):
    return ctx.createDataFrame([(*r, *["clash"] * 9) for r in rows], SCHEMA)


def brute(rows, every=10, positives=5, negatives=10, low=30, high=90):
    used = [(i, [int(np.floor(256 * x)) for x in v], l) for i, v, l in rows
            if l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    order = lambda s, i: (-s, i is None, i or 0)
    out = []
    for k, (i, a, l) in enumerate(used):
        if i is None or i % every:
            continue
        scores = [(sum(x * y for x, y in zip(a, b)), j, m) for n, (j, b, m) in enumerate(used) if n != k and len(a) == len(b)]
        for ps, pid, _ in sorted((s for s in scores if s[2] == l), key=lambda s: order(*s[:2]))[:positives]:
            fit = [s for s in scores if s[2] != l and low * ps <= 100 * s[0] <= high * ps]
            for rank, (ns, nid, _) in enumerate(sorted(fit, key=lambda s: order(*s[:2]))[:negatives], 1):
                out.append((i, pid, rank, nid, ps, ns))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def clustered(n, dim, seed, centres=12, noise=0.15):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, dim))
    own = rng.integers(0, centres, n)
    v = c[own] + noise * rng.normal(size=(n, dim))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    return [(k, v[k].tolist(), int(own[k] % 5)) for k in range(n)]


def test_whole_table_equals_the_sql(ctx):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_SMALL}/embeddings.parquet'")
    got = jobs.queries()["op12_hard_negatives"](ctx, SF_SMALL)
    want = con.execute(jobs.OP12_SQL)
    assert got.columns == [c[0] for c in want.description]
    assert rows_of(got) == sorted(want.fetchall(), key=repr)


@pytest.mark.parametrize("cell_rows, cell_anchors", [(None, 65536), (100, 9)])
def test_clusters_equal_brute_force(ctx, monkeypatch, cell_rows, cell_anchors):
    monkeypatch.setattr(mining, "BLOCK", 16)
    rows = clustered(600, 12, 1)
    got = mining.mine(frame(ctx, rows).repartition(5), F.col("vec_id") % 10 == 0, cell_rows=cell_rows,
                      cell_anchors=cell_anchors)
    assert rows_of(got) == brute(rows)


def test_odd_rows(ctx):
    same = [0.5, 0.5, 0.25]
    rows = clustered(80, 3, 2, centres=4)
    rows += [(10, rows[10][1], rows[10][2]), (10, rows[10][1], rows[10][2]), (None, rows[10][1], rows[10][2]),
             (None, same, 2), (200, same, None), (201, None, 1), (202, [0.1, None, 0.2], 1),
             (203, [float("nan"), 0.1, 0.1], 1), (204, [float("inf"), 0.1, 0.1], 1), (210, [], 1), (211, [], 2),
             (212, [], 1), (220, [0.1, 0.2], 1), (221, [0.3, 0.2], 1), (222, [0.1, 0.1], 2), (230, [0.0] * 3, 3)]
    rows += [(300 + k, same, k % 3) for k in range(40)]  # ties
    assert rows_of(mining.mine(frame(ctx, rows).repartition(3), F.col("vec_id") % 10 == 0)) == brute(rows)
    assert rows_of(mining.mine(frame(ctx, []), F.col("vec_id") % 10 == 0)) == []
    assert rows_of(mining.mine(frame(ctx, rows[:20]), F.lit(False))) == []


def test_scores_beyond_doubles(ctx):
    rng = np.random.default_rng(4)
    rows = [(k, (rng.normal(size=4) * 2e5).round(3).tolist(), k % 2) for k in range(60)]
    assert rows_of(mining.mine(frame(ctx, rows), F.col("vec_id") % 10 == 0)) == brute(rows)
    wide = [(0, [1e8, 1.0], 0), (1, [1e8, 2.0], 1)]
    with pytest.raises(Exception, match="do not fit"):
        mining.mine(frame(ctx, wide), F.col("vec_id") == 0).collect()


def test_bounds_spare_scores():
    """Near anchors: a part of the pairs is scored, and none that counts is missed."""
    rng = np.random.default_rng(5)
    anchors = (rng.normal(size=16) * 100 + rng.normal(size=(100, 16)) * 3).round()
    rows = (rng.normal(size=(2000, 16)) * 100).round()
    exact = anchors @ rows.T
    edge = np.sort(exact, axis=1)[:, -20]
    done = 0
    for nodes, need, scores in mining.scored(anchors, mining.spanning_tree(anchors), rows, np.sqrt((rows ** 2).sum(axis=1)),
                                             lambda nodes, low, high: high >= edge[nodes][:, None]):
        done += need.sum()
        assert np.array_equal(scores[need], exact[nodes][need])
        assert need[exact[nodes] >= edge[nodes][:, None]].all()
    assert done < 0.3 * exact.size


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.integers(-4, 4), min_size=2, max_size=2), min_size=1, max_size=30))
def test_spanning_tree(points):
    points = np.array(points)
    levels, parent, length = mining.spanning_tree(points)
    assert sorted(np.concatenate(levels).tolist()) == list(range(len(points)))
    for depth, nodes in enumerate(levels):
        for n in nodes:
            assert abs(length[n] - np.linalg.norm(points[n] - points[parent[n]])) < 1e-9
            assert depth == 0 or parent[n] in levels[depth - 1]
