"""Whitening against numpy on whole tables, clusters, and odd vectors."""

import numpy as np
import pytest
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from streamlake.llm import jobs, whitening

SCHEMA = "vec_id long, embedding array<float>, x string, id string, dim int, n int, component string"


def frame(ctx, rows):
    return ctx.createDataFrame([(i, v, "x", "i", 1, 2, "c") for i, v in rows], SCHEMA)


def brute(rows, components=16):
    """{(position among usable rows): ...} by plain numpy, for vectors of one length."""
    used = [(i, np.floor(64 * np.array(v, np.float32).astype(float)).astype(np.int64) + 1_000_000)
            for i, v in rows if v is not None and len(v) and all(c is not None and np.isfinite(np.float32(c)) for c in v)]
    fit = np.array(sorted({tuple(x.tolist()) for _, x in used}), np.int64)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    value, vector = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-value)[:components]
    return used, n, sums, value[order], vector[:, order], value.sum(), centred


def compare(got, rows, components=16):
    used, n, sums, value, vector, trace, centred = brute(rows, components)
    k = len(value)
    assert len(got) == len(used) * k
    table = {}
    for r in got:
        table.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], r)
    signs = {}
    for i, x in used:
        deviation = sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums))
        own = table[(i, deviation)]
        for c in range(1, k + 1):
            r = own[c]
            assert r["n"] == n and abs(r["explained"] - value[c - 1] / trace) < 1e-9
            assert r["identity_error"] < 1e-9
            want = float((x - sums / n) @ vector[:, c - 1] / np.sqrt(value[c - 1]))
            sign = signs.setdefault(c, 1 if abs(r["whitened"] - want) <= abs(r["whitened"] + want) else -1) \
                if abs(want) > 1e-3 else signs.get(c)
            if sign:
                assert abs(r["whitened"] - sign * want) < 1e-6, (i, c)


def test_whole_table_equals_numpy(ctx):
    table = ctx.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    got = jobs.queries()["op13_embedding_whitening"](ctx, SF_SMALL)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    compare(got.collect(), [(r["vec_id"], r["embedding"]) for r in table.collect()])


def test_odd_vectors(ctx):
    rng = np.random.default_rng(3)
    rows = [(k, rng.normal(size=5).tolist()) for k in range(60)]
    rows += [(7, rows[7][1]), (100, rows[7][1]), (None, rng.normal(size=5).tolist()), (101, None), (102, []),
             (103, [1.0, None, 2.0, 3.0, 4.0]), (104, [float("nan")] * 5), (105, [float("inf"), 1.0, 1.0, 1.0, 1.0])]
    got = whitening.whiten(frame(ctx, rows).repartition(4)).collect()
    compare(got, rows)
    assert sum(r["vec_id"] is None for r in got) == 5 and not [r for r in got if r["vec_id"] in range(101, 106)]


def test_lengths_are_whitened_apart(ctx):
    rng = np.random.default_rng(4)
    a = [(k, rng.normal(size=3).tolist()) for k in range(40)]
    b = [(100 + k, rng.normal(size=2).tolist()) for k in range(30)]
    got = whitening.whiten(frame(ctx, a + b)).collect()
    compare([r for r in got if r["vec_id"] < 100], a)
    compare([r for r in got if r["vec_id"] >= 100], b)


def test_nothing_to_whiten(ctx):
    assert whitening.whiten(frame(ctx, [])).collect() == []
    same = whitening.whiten(frame(ctx, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).collect()
    assert len(same) == 4 and all(r["whitened"] is None and r["explained"] is None and r["deviation"] == 0 for r in same)
    line = whitening.whiten(frame(ctx, [(k, [k / 4, 0.5]) for k in range(9)])).collect()
    assert {r["component"] for r in line if r["whitened"] is not None} == {1}
    assert all(r["identity_error"] < 1e-9 for r in line)


def test_wide_entries_raise(ctx):
    with pytest.raises(Exception, match="do not fit"):
        whitening.whiten(frame(ctx, [(1, [1e9, 2.0]), (2, [-1e9, 3.0])])).collect()


def residual(a):
    value, x = whitening.eigenvectors(a)
    size = max(np.abs(a).max(), 1e-300)
    assert np.all(np.diff(value) <= 1e-15 * size)
    assert np.abs(x.T @ x - np.eye(len(a))).max() < 4e-15
    assert np.abs(a @ x - x * value).max() < 2e-14 * size * len(a) ** 0.5
    return value, x


def test_clustered_eigenvalues():
    rng = np.random.default_rng(5)
    q = np.linalg.qr(rng.normal(size=(24, 24)))[0]
    for gap in (0, 1e-14, 1e-10, 1e-7, 1e-5, 1e-3):
        want = np.array([5.0] + [3 + gap * k for k in range(6)][::-1] + [1 - gap * k / 10 for k in range(9)] + [1e-9] * 8)
        a = (q * np.sort(want)[::-1]) @ q.T
        value, x = residual((a + a.T) / 2)
        assert np.abs(value - np.sort(want)[::-1]).max() < 1e-14 * 24
        assert abs(abs(x[:, 0] @ q[:, 0]) - 1) < 1e-13
    residual(np.eye(7))
    residual(np.zeros((3, 3)))


def test_eigenvectors_are_better_than_float32():
    rng = np.random.default_rng(6)
    b = rng.normal(size=(500, 40)) * np.linspace(1, 3, 40)
    a = b.T @ b / 500
    value, x = residual(a)
    want_value, want = np.linalg.eigh(a)
    assert np.abs(value - want_value[::-1]).max() < 1e-13
    assert np.abs(np.abs((x * want[:, ::-1]).sum(axis=0)) - 1).max() < 1e-12


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(-3, 3), min_size=4, max_size=4), min_size=4, max_size=4))
def test_small_integer_matrices(rows):
    a = np.array(rows, float)
    residual(a @ a.T)
