"""Pairs along graph edges (G08, J26) against brute force, with bounded steps."""

from __future__ import annotations

import random

import pytest

from streamlake.operators import joins as J
from streamlake.operators.sizing import spread
from streamlake.plans import graph as G


def _closure(edges):
    known = set(edges)
    while True:
        more = {(a, d) for a, b in known for c, d in edges if b is not None and b == c} - known
        if not more:
            return known
        known |= more


def _edges(spark, edges):
    return spark.createDataFrame(sorted(edges, key=str), "src long, dst long")


def _rows(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("seed", range(3))
def test_closure_of_random_graphs(spark, seed, monkeypatch):
    monkeypatch.setattr(G, "MEMBERS", 3)
    draw = random.Random(seed)
    n, m = ((30, 24), (24, 40), (14, 40))[seed]
    edges = {(draw.randrange(n), draw.randrange(n)) for _ in range(m)}
    assert _rows(G.transitive_closure(_edges(spark, edges))) == _closure(edges)


def test_closure_ends_with_null_ends(spark):
    edges = {(None, 1), (1, 2), (2, 1), (2, 3), (3, None), (4, 4)}
    assert _rows(G.transitive_closure(_edges(spark, edges))) == _closure(edges)


def test_closure_steps_follow_edges(spark, monkeypatch):
    """No step holds the pairs of a component; before, each round held them all."""
    held, cut = [], G.cut

    def counting(df):
        out = cut(df)
        held.append(out.count())
        return out

    monkeypatch.setattr(G, "cut", counting)
    n = 40
    edges = {(v, w % n) for v in range(n) for w in (v + 1, v + 7)}
    assert _rows(G.transitive_closure(_edges(spark, edges))) == {(a, b) for a in range(n) for b in range(n)}
    assert max(held) <= len(edges)


@pytest.mark.parametrize("most", [2_000_000, 25])
def test_path_extend_pairs_once(spark, monkeypatch, most):
    """Lists of next vertices and, for sources with many paths, single pairs."""
    monkeypatch.setattr(J, "PAIRS_PER_TASK", most)
    monkeypatch.setattr(J, "LIST", 4)
    draw = random.Random(5)
    paths = [(draw.choice([None, *range(12)]), draw.choice([None, *range(30)])) for _ in range(90)]
    paths += [(3, v) for v in range(30)]
    edges = [(draw.choice([None, *range(30)]), draw.choice([None, *range(20)])) for _ in range(150)]
    left, right = (spark.createDataFrame(x, "src long, dst long") for x in (paths, edges))
    expected = [(a, d) for a, b in paths for c, d in edges if b is not None and b == c]
    assert _rows(J.path_extend(left, right, distinct=True)) == set(expected)
    assert sorted(map(str, map(tuple, J.path_extend(left, right).collect()))) == sorted(map(str, expected))
    none = left.limit(0)
    assert J.path_extend(none, right, distinct=True).count() == J.path_extend(left, none, distinct=True).count() == 0


def test_path_extend_shuffles_lists(spark):
    """Pairs unfold behind the last exchange; before, every pair went through it."""
    edges = spark.createDataFrame([(a, b) for a in range(30) for b in range(30) if a != b], "src long, dst long")
    plan = J.path_extend(edges, edges, distinct=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[:plan.index("Generate explode")]


def test_spread_bounds_a_task(spark):
    """Twice the rows, twice the tasks; the aggregate joined back needs no other exchange."""
    def tasks(n):
        df = spread(spark.range(n).selectExpr("id % 50 as k", "id as v"), "k", rows=20)
        sums = df.groupBy("k").agg({"v": "sum"}).withColumnRenamed("k", "j")
        out = J.equi_join(df, sums, "k", "j")
        assert out.count() == n
        assert out._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM") \
            == out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
        return df.rdd.getNumPartitions()
    assert (tasks(400), tasks(800)) == (20, 40)


@pytest.mark.parametrize("seed, held", [(1, 6), (2, 0)])
def test_closure_beyond_one_task(spark, seed, held, monkeypatch):
    """More edges than a task may hold go in rounds, with the same pairs."""
    monkeypatch.setattr(G, "MEMBERS", 3)
    monkeypatch.setattr(G, "EDGES_PER_TASK", held)
    draw = random.Random(seed)
    n, m = ((30, 24), (24, 40), (14, 40))[seed]
    edges = {(draw.randrange(n), draw.randrange(n)) for _ in range(m)}
    assert _rows(G.transitive_closure(_edges(spark, edges))) == _closure(edges)


@pytest.mark.parametrize("held", [2_000_000, 200])
def test_closure_steps_do_not_follow_the_longest_path(spark, held, monkeypatch):
    """Components in a chain; before, each was a round of its own or more."""
    steps, cut = [], G.cut
    monkeypatch.setattr(G, "EDGES_PER_TASK", held, raising=False)
    monkeypatch.setattr(G, "cut", lambda df: steps.append(1) or cut(df))
    groups, size = 12, 6
    inside = {(g * size + a, g * size + b) for g in range(groups) for a in range(size) for b in range(size) if a != b}
    edges = inside | {(g * size, g * size + size) for g in range(groups - 1)}
    expected = {(a, b) for a in range(groups * size) for b in range(a // size * size, groups * size)}
    assert _rows(G.transitive_closure(_edges(spark, edges))) == expected
    assert len(steps) <= 18
