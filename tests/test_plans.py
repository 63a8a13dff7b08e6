"""Plan checks: the physical plans are the ones the design relies on."""

import __spark_entry__ as E
from shiftlake.plans import catalog as C
from shiftlake.plans import serving as SV

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_headcount_has_no_product(spark):
    p = plan(E.queries()["kpi_active_headcount"](spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_top_k_is_take_ordered(spark):
    for key in ("kpi_late_arrivals", "kpi_avg_working_hours", "serve_overtime"):
        assert "TakeOrderedAndProject" in plan(E.queries()[key](spark, SF)), key


def test_keep_first_limits_before_the_shuffle(spark):
    p = plan(E.queries()["ts_dedup_first"](spark, SF))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_timesheet_read_pushes_filters_and_prunes_columns(spark):
    ts = C.silver_timesheets(spark, SF)
    df = SV.timesheets(ts, start_date="1996-01-01", end_date="1996-06-30").select("client_employee_id")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(punch_apply_date), GreaterThanOrEqual(punch_apply_date" in p
    assert "ReadSchema: struct<client_employee_id:bigint,punch_apply_date:timestamp_ntz,punch_in_datetime" in p


def test_rolling_report_windows_only_candidates(spark):
    from shiftlake.plans import gold as G

    p = plan(G.rolling_avg(C.silver_timesheets(spark, SF)))
    # predecessor search limited map-side, candidates filtered by a broadcast join
    assert "WindowGroupLimit" in p and "Partial" in p
    assert "BroadcastHashJoin" in p and "TakeOrderedAndProject" in p
