"""Physical-plan properties the scale design relies on."""

import contextlib
import io

import __spark_entry__ as E
from streamlake.operators import ranges
from streamlake.plans import registry

from conftest import SF_SMALL


def _plan(spark, name):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        E.queries()[name](spark, SF_SMALL).explain(mode="formatted")
    return buf.getvalue()


def test_q3_pushes_filters_and_prunes_columns(spark):
    """[G13 P10 P11] filters reach the parquet scans; only used columns are read."""
    p = _plan(spark, "g13_tpch_q3")
    assert "EqualTo(c_mktsegment,AUTOMOBILE)" in p
    assert "LessThan(o_orderdate," in p and "GreaterThan(l_shipdate," in p
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in p
    assert "l_returnflag" not in p and "l_tax" not in p


def test_relational_jobs_stay_in_the_jvm(spark):
    """No Python evaluation in the plans of relational / window jobs."""
    for name in ("g13_tpch_q3", "g14_tpch_q10", "t09_tumbling_counts", "w04_running_distinct_users",
                 "j16_asof_join", "t12_session_windows", "g12_word_count"):
        p = _plan(spark, name)
        for py in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
            assert py not in p, (name, py)


def test_running_windows_are_bucketed(spark, monkeypatch):
    """[W02 A03] every window over rows is partitioned by (key, range)."""
    monkeypatch.setattr(ranges, "ROWS_PER_RANGE", 200)  # the small table would be one range
    for name in ("w02_running_count", "a03_running_sum"):
        p = _plan(spark, name)
        specs = [line for line in p.splitlines() if line.strip().startswith("Arguments:") and "windowspecdefinition" in line]
        over_rows = [s for s in specs if "_in" in s or "_inc" in s]
        assert over_rows and all("_bk" in s for s in over_rows), name


def test_state_machine_streams_partitions(spark):
    """[U05] the fold runs over sorted partitions (mapInPandas), never as a
    whole-key grouped Python call."""
    p = _plan(spark, "u05_state_machine_alerts")
    assert "MapInPandas" in p and "FlatMapGroupsInPandas" not in p


def test_topn_uses_group_limit(spark):
    """[W06] row_number <= n is planned with a per-group limit before the shuffle."""
    p = _plan(spark, "w06_top_three_per_supplier")
    assert "WindowGroupLimit" in p


#: Jobs that read a one-row set beside every row (J11 sets, global figures), a nested-loop join in Spark's plans.
ONE_ROW_SIDES = {"w02_running_count", "w03_running_max", "g17_uv_per_ten_minutes", "g09_kmeans"}


def test_no_row_by_row_products(spark):
    """No registered job pairs every row with every row of another input; a
    nested loop stands only over a broadcast of one aggregated row."""
    for name in registry.jobs():
        p = _plan(spark, name)
        assert "CartesianProduct" not in p, name
        if "BroadcastNestedLoopJoin" in p:
            assert name in ONE_ROW_SIDES, name
