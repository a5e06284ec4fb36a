"""Keyed state, top-N, cascades, clock windows and models on streams."""

import datetime
import glob
import os
import shutil
import time

import pytest
from conftest import SF_SMALL, ordered_files
from pyspark.sql import functions as F

import __spark_entry__ as E
from streamlake.streaming import jobs as SJ
from streamlake.streaming import keyed as K
from streamlake.streaming import models as M
from streamlake.streaming.runner import enable_state_store, run_to_memory, run_with_progress, stream_parquet

ORDER = ["ts", "event_id"]


@pytest.fixture(scope="module")
def ordered(spark, tmp_path_factory):
    enable_state_store(spark)
    return ordered_files(spark, tmp_path_factory)


def events(spark, folder):
    return stream_parquet(spark, folder, max_files=1).filter("event_id >= 0")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_running_sum(spark, ordered):
    """[A03]"""
    got, progress = run_with_progress(K.running_sum_stream(events(spark, ordered), "user_id", ORDER, "event_id", "value"), "a03s")
    want = E.queries()["a03_running_sum"](spark, SF_SMALL)
    assert rows(got.select("event_id", "user_id", "total")) == rows(want.select("event_id", "user_id", "running_value"))
    assert len(progress) >= 5


def test_running_max(spark, ordered):
    """[A04]"""
    got = run_to_memory(K.running_max_stream(events(spark, ordered), "user_id", ORDER, "event_id", "value", "event_type"), "a04s")
    want = E.queries()["a04_running_max_first_fields"](spark, SF_SMALL)
    cols = ["event_id", "user_id", "value", "event_type"]
    assert rows(got.select(*cols)) == rows(want.select(*cols))


def test_sum_with_the_row_before(spark, ordered):
    """[W01]"""
    got = run_to_memory(K.last_rows_sum_stream(events(spark, ordered), "event_type", ORDER, "event_id", "value", 2), "w01s")
    want = E.queries()["w01_sum_one_preceding"](spark, SF_SMALL)
    assert rows(got.select("event_id", "event_type", "total")) == rows(want.select("event_id", "event_type", "sum_2"))


def test_count_windows(spark, ordered):
    """[T13] over several micro-batches"""
    got, progress = run_with_progress(
        K.last_rows_sum_stream(events(spark, ordered), "user_id", ORDER, "event_id", "value", 10, 5), "t13s")
    want = E.queries()["t13_count_window"](spark, SF_SMALL)
    assert rows(got.select("user_id", "row_count", "total")) == rows(want)
    assert len(progress) >= 5


def replay(changes, key, columns):
    """The rows left after all changes; a row is taken back only while it is there."""
    held = {}
    for r in changes:
        row = tuple(r[c] for c in columns)
        if r["is_add"]:
            held[row] = held.get(row, 0) + 1
        else:
            held[row] = held.get(row, 0) - 1
    assert all(n >= 0 for n in held.values())
    return sorted(row for row, n in held.items() for _ in range(n))


def test_top_three_per_supplier(spark, tmp_path):
    """[W06] the changelog replays to the batch result"""
    enable_state_store(spark)
    spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").repartition(3).write.parquet(f"{tmp_path}/li")
    stream = stream_parquet(spark, f"{tmp_path}/li", max_files=1)
    order = ["-l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus", "l_shipdate"]
    got, progress = run_with_progress(K.top_n_stream(stream.select("l_suppkey", *[o.lstrip("-") for o in order]),
                                                     "l_suppkey", order, 3), "w06s")
    cols = ["l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice", "rank"]
    changes = got.collect()
    assert any(not r["is_add"] for r in changes)
    want = E.queries()["w06_top_three_per_supplier"](spark, SF_SMALL).withColumnRenamed("row_num", "rank")
    assert replay(changes, "l_suppkey", cols) == rows(want.select(*cols))


def test_top_five_per_hour(spark, ordered):
    """[W07] windows that the watermark has passed, and no state left for them"""
    got, progress = run_with_progress(SJ.top_users_stream(stream_parquet(spark, ordered, max_files=1), "1 hour", 5), "w07s")
    want = E.queries()["w07_top_five_per_hour"](spark, SF_SMALL)
    cols = ["user_id", "rss", "start_time"]
    out = [r for r in replay(got.collect(), "start_time", cols) if r[0] >= 0]
    assert out == rows(want.select("user_id", "rss", F.col("start_time").cast("timestamp")))
    assert sum(o["numRowsTotal"] for o in progress[-1]["stateOperators"]) <= 12


def test_cascade(spark, ordered):
    """[T20] one watermark closes both windows"""
    got = run_to_memory(SJ.cascade_stream(stream_parquet(spark, ordered, max_files=1), "10 minutes", "30 minutes",
                                          ["event_type"]), "t20s")
    want = E.queries()["t20_cascaded_windows"](spark, SF_SMALL)
    cols = ["event_type", F.col("window_start").cast("timestamp"), F.col("window_end").cast("timestamp"), "cnt"]
    assert rows(got.select(*cols)) == rows(want.select(*cols))


def test_clock_windows_close_without_rows(spark, tmp_path):
    """[T10] the clock closes the window; nothing comes after the first rows"""
    enable_state_store(spark)
    spark.range(10).selectExpr("id % 2 as k", "id").coalesce(1).write.parquet(f"{tmp_path}/in")
    out = K.clock_windows_stream(stream_parquet(spark, f"{tmp_path}/in"), "k", 2000)
    q = (out.writeStream.format("memory").queryName("t10s").outputMode("append")
         .option("checkpointLocation", f"{tmp_path}/ck").trigger(processingTime="500 milliseconds").start())
    try:
        until = time.time() + 90
        while time.time() < until and q.exception() is None and spark.table("t10s").count() < 2:
            time.sleep(1)
    finally:
        q.stop()
    found = spark.table("t10s").collect()
    assert sorted((r["k"], r["cnt"]) for r in found) == [(0, 5), (1, 5)]
    for r in found:
        assert r["window_end"] - r["window_start"] == datetime.timedelta(seconds=2)
        assert r["window_end"].timestamp() % 2 == 0


def test_time_of_the_source(spark, tmp_path):
    """[T05] file times as event times: a window closes when a later file comes"""
    for k in range(3):
        spark.range(4).coalesce(1).write.parquet(f"{tmp_path}/{k}")
        os.makedirs(f"{tmp_path}/in", exist_ok=True)
        shutil.copy(glob.glob(f"{tmp_path}/{k}/*.parquet")[0], f"{tmp_path}/in/{k}.parquet")
        os.utime(f"{tmp_path}/in/{k}.parquet", (1_700_000_000 + 100 * k, 1_700_000_000 + 100 * k))
    s = K.with_source_time(stream_parquet(spark, f"{tmp_path}/in", max_files=1), "0 seconds")
    got = run_to_memory(s.groupBy(F.window("source_ts", "100 seconds")).count(), "t05s")
    assert [(r["window"]["start"].timestamp(), r["count"]) for r in got.orderBy("window.start").collect()] == \
        [(1_700_000_000, 4), (1_700_000_100, 4)]


def run(query):
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def test_models_and_predictions(spark, ordered, tmp_path):
    """[U11 J25] trained first, the predictions equal the batch jobs"""
    folder, out = f"{tmp_path}/models", f"{tmp_path}/out"
    training = stream_parquet(spark, ordered, max_files=1).filter("event_type = 'purchase'")
    run(M.save_models(M.window_models_stream(training, "ts", "value", "1 hour"), folder))
    want = E.queries()["u11_window_models"](spark, SF_SMALL)
    assert rows(M.read_models(spark, folder)) == rows(want.select(F.col("model_time").cast("timestamp"), "model"))
    views = events(spark, ordered).filter("event_type = 'view'").select("event_id", "ts", "value")
    run(M.predict_stream(views, folder, "ts", out, lambda df: df.withColumn("residual", F.col("value") - F.col("model")), -1.0))
    got = spark.read.option("recursiveFileLookup", "true").parquet(out)
    want = E.queries()["j25_predict_with_latest_model"](spark, SF_SMALL)
    assert rows(got.filter("model != -1").select("event_id", "residual")) == rows(want.select("event_id", "residual"))
    early = got.filter("model = -1")
    assert got.count() == spark.read.parquet(f"{SF_SMALL}/events.parquet").filter("event_type = 'view'").count()
    assert early.count() == got.count() - want.count()


def test_late_models_leave_scored_rows_alone(spark, tmp_path):
    """[U11 J25] the skeleton's data: 8200 training rows 10 ms apart, windows of 5 s, a model of 1.0
    each; 50 rows to predict. Scored before training they get the initial model, 50 zeros; 17
    windows give models, the last when the watermark passes it."""
    at = F.timestamp_millis(F.col("id") * 10 + 10)
    spark.range(8200).select(at.alias("ts"), F.lit(1.0).alias("value")).coalesce(1).write.parquet(f"{tmp_path}/train")
    spark.range(1).select(F.timestamp_millis(F.lit(10**9)).alias("ts"), F.lit(1.0).alias("value")).coalesce(1) \
        .write.mode("append").parquet(f"{tmp_path}/train")
    spark.range(50).select("id", F.timestamp_millis(F.col("id") * 5 + 80_000).alias("ts"), F.lit(1).alias("v")) \
        .write.parquet(f"{tmp_path}/new")
    predict = lambda df: df.withColumn("prediction", (F.col("model") * F.col("v")).cast("int"))
    new = stream_parquet(spark, f"{tmp_path}/new")
    run(M.predict_stream(new, f"{tmp_path}/models", "ts", f"{tmp_path}/first", predict))
    train = stream_parquet(spark, f"{tmp_path}/train")
    run(M.save_models(M.window_models_stream(train, "ts", "value", "5 seconds"), f"{tmp_path}/models"))
    read = lambda name: [r["prediction"] for r in spark.read.option("recursiveFileLookup", "true")
                         .parquet(f"{tmp_path}/{name}").collect()]
    assert read("first") == [0] * 50
    assert [r["model"] for r in M.read_models(spark, f"{tmp_path}/models").collect()] == [1.0] * 17
    run(M.predict_stream(new, f"{tmp_path}/models", "ts", f"{tmp_path}/second", predict))
    assert read("second") == [1] * 50 and read("first") == [0] * 50
