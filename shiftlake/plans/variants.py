"""The second KPI set (V1-V9): same ideas, other semantics, no limits.

They read the silver tables under their own column names (``rename_*``).
Differences from gold are listed per function.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftlake.functions.exprs import as_ntz, days_trunc, micros_between, month_start_ts, week_start
from shiftlake.operators.headcount import headcount_by_month
from shiftlake.operators.rolling import rolling_all_balanced
from shiftlake.params import DEFAULT, INGEST_COL, VAR_EARLY_LABEL, VAR_OTHER_LABEL, Params


def rename_timesheets(silver_ts: DataFrame) -> DataFrame:
    return silver_ts.select(
        F.col("client_employee_id").alias("employee_id"),
        F.col("punch_apply_date").alias("date"),
        F.col("punch_in_datetime").alias("actual_start_time"),
        F.col("punch_out_datetime").alias("actual_end_time"),
        F.col("scheduled_start_datetime").alias("scheduled_start_time"),
        F.col("scheduled_end_datetime").alias("scheduled_end_time"),
        "hours_worked",
        INGEST_COL,
    )


def rename_employees(silver_emp: DataFrame) -> DataFrame:
    return silver_emp.select(
        F.col("client_employee_id").alias("employee_id"),
        F.col("department_name").alias("department"),
        F.col("hire_date").alias("date_joined"),
        F.col("term_date").alias("termination_date"),
    )


def active_headcount(emp: DataFrame, ts: DataFrame) -> DataFrame:
    """V1: headcount over the employee rows as they are (duplicate ids merged by
    the sweep), month kept as a timestamp, unsorted."""
    hc = headcount_by_month(
        ts, emp, date_col="date", id_col="employee_id", hire_col="date_joined", term_col="termination_date"
    )
    return hc.select(as_ntz(F.col("month")).alias("month"), "active_headcount")


def turnover(emp: DataFrame) -> DataFrame:
    """V2: terminations per month, month as a timestamp."""
    return (
        emp.where(F.col("termination_date").isNotNull())
        .groupBy(month_start_ts("termination_date").alias("month"))
        .agg(F.count("*").alias("terminations"))
    )


def avg_tenure(emp: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """V3: whole days (toward zero) of (termination or as_of) - joined, in years,
    unrounded; the null department is a group; no count. The mean is taken of
    the integer days (exact sum), then divided by 365.25."""
    end = F.coalesce(F.col("termination_date"), F.lit(params.as_of).cast(T.TimestampNTZType()))
    days = days_trunc(F.col("date_joined"), end)
    return emp.groupBy("department").agg((F.avg(days) / F.lit(365.25)).alias("avg_tenure_years"))


def avg_working_hours(ts: DataFrame) -> DataFrame:
    """V4: weekly average hours over all rows, unrounded; week as a timestamp."""
    week = as_ntz(week_start("date")).alias("week")
    return ts.groupBy("employee_id", week).agg(F.avg("hours_worked").alias("avg_hours"))


def late_arrivals(ts: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """V5: count of punches more than the grace late (inline predicate)."""
    late = micros_between("scheduled_start_time", "actual_start_time") / F.lit(60_000_000.0) > params.grace_minutes
    return ts.where(late).groupBy("employee_id").agg(F.count("*").alias("late_arrivals"))


def early_departures(ts: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """V6: count of punches out more than the grace early."""
    early = micros_between("actual_end_time", "scheduled_end_time") / F.lit(60_000_000.0) > params.grace_minutes
    return ts.where(early).groupBy("employee_id").agg(F.count("*").alias("early_departures"))


def overtime(ts: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """V7: count of punches over the overtime hours; no extra-hours sum."""
    return (
        ts.where(F.col("hours_worked") > params.overtime_hours)
        .groupBy("employee_id")
        .agg(F.count("*").alias("overtime_days"))
    )


def rolling_avg(ts: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """V8: unrounded rolling average over all rows, sorted by employee and date.

    One range exchange gives both the frames and the order (``rolling_all_balanced``)."""
    silver_named = ts.select(
        F.col("employee_id").alias("client_employee_id"),
        F.col("date").alias("punch_apply_date"),
        F.col("actual_start_time").alias("punch_in_datetime"),
        INGEST_COL,
        "hours_worked",
    )
    scored = rolling_all_balanced(silver_named, rows=params.rolling_rows)
    return scored.select(
        F.col("client_employee_id").alias("employee_id"),
        F.col("punch_apply_date").alias("date"),
        "rolling_30day_avg",
    )


def whole_months(start: str, end: str) -> F.Column:
    """Whole elapsed calendar months from ``start`` to ``end``."""
    s, e = F.col(start), F.col(end)
    return (
        (F.year(e) - F.year(s)) * 12
        + (F.month(e) - F.month(s))
        - F.when(F.dayofmonth(e) < F.dayofmonth(s), 1).otherwise(0)
    )


def attrition(emp: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """V9: early (at most N whole months) or other per termination; a null span is
    other; an empty class has no row."""
    label = F.when(whole_months("date_joined", "termination_date") <= params.var_early_months, VAR_EARLY_LABEL).otherwise(
        VAR_OTHER_LABEL
    )
    return (
        emp.where(F.col("termination_date").isNotNull())
        .groupBy(label.alias("attrition_type"))
        .agg(F.count("*").alias("count"))
    )
