"""Joins of two streams equal the batch jobs and drop their state."""

import datetime

import pytest
from conftest import SF_SMALL, ordered_files
from pyspark.sql import functions as F

import __spark_entry__ as E
from streamlake.operators import joins as J
from streamlake.streaming import joins as SJ
from streamlake.streaming.runner import run_with_progress, stream_parquet

@pytest.fixture(scope="module")
def ordered(spark, tmp_path_factory):
    return ordered_files(spark, tmp_path_factory)


def side(spark, folder, kind, p):
    s = stream_parquet(spark, folder, max_files=1).filter(F.col("event_type") == kind)
    return s.select(F.col("event_id").alias(f"{p}_id"), F.col("ts").alias(f"{p}_ts"), F.col("user_id").alias(f"{p}_user"))


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).filter(F.col(df.columns[0]) >= 0).collect())


def state(progress):
    return [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in progress]


def test_time_window_join(spark, ordered):
    """[J14 J13]"""
    got, progress = run_with_progress(SJ.interval_join_stream(
        side(spark, ordered, "view", "v"), side(spark, ordered, "purchase", "p"), "v_user", "p_user", "v_ts", "p_ts",
        0, 3_600_000), "j14s")
    want = E.queries()["j14_time_window_join"](spark, SF_SMALL)
    assert rows(got, "v_id", "p_id") == rows(want, "view_id", "purchase_id")
    held = state(progress)
    whole = spark.read.parquet(f"{SF_SMALL}/events.parquet").filter("event_type in ('view', 'purchase')").count()
    assert 0 < max(held) < whole / 2 and held[-1] <= 2  # rows older than the bound have gone


@pytest.mark.parametrize("low, high", [(True, True), (True, False), (False, True), (False, False)])
def test_interval_join(spark, ordered, low, high):
    """[J15 F08]"""
    got, progress = run_with_progress(SJ.interval_join_stream(
        side(spark, ordered, "click", "c"), side(spark, ordered, "error", "e"), "c_user", "e_user", "c_ts", "e_ts",
        -300_000, 600_000, low, high), f"j15s_{low}_{high}")
    batch = lambda kind, p: spark.read.parquet(f"{SF_SMALL}/events.parquet").filter(
        F.col("event_type") == kind).select(F.col("event_id").alias(f"{p}_id"), F.col("ts").alias(f"{p}_ts"),
                                            F.col("user_id").alias(f"{p}_user"))
    want = J.interval_join(batch("click", "c"), batch("error", "e"), "c_user", "e_user", "c_ts", "e_ts",
                           -300_000, 600_000, low, high)
    assert rows(got, "c_id", "e_id") == rows(want, "c_id", "e_id")
    assert state(progress)[-1] <= 2 < max(state(progress))


def test_interval_bounds(spark, tmp_path):
    """Partners exactly on a bound count only where it is inclusive."""
    at = lambda s: datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=s)
    spark.createDataFrame([(1, 1, at(100))], "a_id long, a_key int, a_ts timestamp").write.parquet(f"{tmp_path}/a")
    spark.createDataFrame([(k, 1, at(s)) for k, s in ((1, 94.999), (2, 95), (3, 97), (4, 110), (5, 110.001))],
                          "b_id long, b_key int, b_ts timestamp").write.parquet(f"{tmp_path}/b")
    for low, high, want in ((True, True, [2, 3, 4]), (False, True, [3, 4]), (True, False, [2, 3]), (False, False, [3])):
        got, _ = run_with_progress(SJ.interval_join_stream(
            stream_parquet(spark, f"{tmp_path}/a"), stream_parquet(spark, f"{tmp_path}/b"), "a_key", "b_key", "a_ts",
            "b_ts", -5000, 10_000, low, high), f"bounds_{low}_{high}")
        assert [r["b_id"] for r in got.orderBy("b_id").collect()] == want


def test_window_join(spark, ordered):
    """[J17]"""
    got, progress = run_with_progress(SJ.window_join_stream(
        side(spark, ordered, "click", "c"), side(spark, ordered, "purchase", "p"), "c_user", "p_user", "c_ts", "p_ts",
        "1 hour"), "j17s")
    want = E.queries()["j17_window_join"](spark, SF_SMALL)
    stamp = F.col("window_start").cast("timestamp")
    assert rows(got, "c_id", "p_id", stamp) == rows(want, "click_id", "purchase_id", stamp)
    assert state(progress)[-1] <= 2 < max(state(progress))


def test_window_cogroup(spark, ordered):
    """[J18]"""
    s = lambda kind: stream_parquet(spark, ordered, max_files=1).filter(F.col("event_type") == kind)
    got, progress = run_with_progress(SJ.window_cogroup_stream(s("click"), s("purchase"), "user_id", "ts", 3_600_000,
                                                               "value"), "j18s")
    got = got.select("user_id", "window_start", F.sort_array("left_values"), F.sort_array("right_values"))
    want = E.queries()["j18_window_cogroup"](spark, SF_SMALL)
    want = want.select("user_id", F.col("window_start").cast("timestamp"), "click_values", "purchase_values")
    plain = lambda df: sorted((r[0], r[1], tuple(r[2]), tuple(r[3])) for r in df.collect() if r[0] >= 0)
    out = plain(got)
    assert out == plain(want)
    assert any(not r[2] for r in out) and any(not r[3] for r in out)  # a window with one side alone
    assert max(state(progress)) > 0
