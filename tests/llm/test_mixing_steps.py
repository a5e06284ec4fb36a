"""Mixing keeps its number of queries low: the driver holds each one's plans."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from streamlake.llm import mixing


def test_steps_without_queries_beside_them(ctx, monkeypatch):
    written, write = Counter(), mixing.write_table

    def counting(df, name, files=None):
        written[name] += 1
        return write(df, name, files)

    monkeypatch.setattr(mixing, "write_table", counting)
    sized = ctx.range(400).select("id", F.concat(F.lit("s"), F.col("id") % 4).alias("source"),
                                  (F.col("id") % 37).alias("size"), F.lit(0).cast("long").alias("num"))
    params = mixing.fit(sized)
    # the last refinement of a round is written with the round's shift
    assert written["mix-cells"] == mixing.ROUNDS * (mixing.PASSES - 1)
    assert written["mix-shifts"] == mixing.ROUNDS
    taken = mixing.with_copies(sized, params).groupBy("source").agg(
        F.sum(F.col("copies") * F.col("size")).alias("t"), F.first("target").alias("target")).collect()
    assert len(taken) == 4 and all(0 <= r.target - r.t < 5 for r in taken)


def test_solve_stops_by_its_tolerance(ctx, monkeypatch):
    steps, write = [], mixing.write_table
    monkeypatch.setattr(mixing, "write_table", lambda df, name, files=None: steps.append(name) or write(df, name, files))
    hist = ctx.createDataFrame([(0, 2, 50), (0, 9, 30), (1, 5, 10)], "sid int, size long, docs long")
    state = ctx.createDataFrame([(0, 9, 200.0, 370), (1, 5, 100.0, 50)], "sid int, top long, target double, source_size long")
    got = {r.sid: r.lam for r in mixing.solve(hist, state, 3.0).collect()}
    assert got[0] < 0 < got[1] and 3 <= len(steps) <= 20
