"""Gold KPI tables (G1-G9) over silver employees and timesheets.

Each builder takes silver DataFrames and returns the KPI DataFrame; the
job writes them. Months and weeks are the DATE of their first day. Top-k reports break ties on
the employee id (and, for the rolling report, on punch-in time and ingest
order) so results are stable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlake.functions.exprs import micros_between, month_start, round_half_away, week_start
from shiftlake.operators.headcount import headcount_by_month
from shiftlake.operators.rolling import rolling_top
from shiftlake.params import (
    DEFAULT,
    EARLY_ATTRITION_LABEL,
    OTHER_ATTRITION_LABEL,
    Params,
)

ID = "client_employee_id"


def active_headcount(emp: DataFrame, ts: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """G1: (month, active_headcount), month desc."""
    return headcount_by_month(ts, emp).orderBy(F.col("month").desc_nulls_last())


def turnover_trend(emp: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Terminations per month of the termination date, month desc."""
    return (
        emp.where(F.col("term_date").isNotNull())
        .groupBy(month_start("term_date").alias("month"))
        .agg(F.count("*").alias("terminations"))
        .orderBy(F.col("month").desc_nulls_last())
    )


def avg_tenure(emp: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Average tenure in years per department (null department left out)."""
    return (
        emp.where(F.col("department_name").isNotNull())
        .groupBy("department_name")
        .agg(
            round_half_away(F.avg("tenure_days") / F.lit(365.25), 2).alias("avg_tenure_years"),
            F.count("*").alias("employee_count"),
        )
        .orderBy(F.col("avg_tenure_years").desc_nulls_last(), F.col("department_name").asc_nulls_last())
    )


def weekly_hours(ts: DataFrame) -> DataFrame:
    """Average hours of normal-hours punches per employee and week, all weeks."""
    return (
        ts.where(F.col("is_normal_work") == 1)
        .groupBy(ID, week_start("punch_apply_date").alias("week"))
        .agg(round_half_away(F.avg("hours_worked"), 2).alias("avg_hours"), F.count("*").alias("days_worked"))
    )


def avg_working_hours(ts: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """The first rows of ``weekly_hours``, latest weeks first."""
    return weekly_hours(ts).orderBy(F.col("week").desc_nulls_last(), F.col(ID).asc_nulls_last()).limit(params.limit_weekly_hours)


def per_employee_flags(ts: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """G5-G7 share one scan and one group-by: conditional aggregates per employee."""
    return ts.where((F.col("is_late") == 1) | (F.col("is_early") == 1) | (F.col("is_overtime") == 1)).groupBy(ID).agg(
        F.count_if(F.col("is_late") == 1).alias("late_count"),
        round_half_away(F.avg(F.when(F.col("is_late") == 1, F.col("minutes_late"))), 2).alias("avg_minutes_late"),
        F.count_if(F.col("is_early") == 1).alias("early_count"),
        round_half_away(F.avg(F.when(F.col("is_early") == 1, F.col("minutes_early"))), 2).alias("avg_minutes_early"),
        F.count_if(F.col("is_overtime") == 1).alias("overtime_days"),
        round_half_away(
            F.sum(F.when(F.col("is_overtime") == 1, F.col("hours_worked") - F.lit(params.overtime_base_hours))), 2
        ).alias("total_extra_hours"),
    )


def top_by(df: DataFrame, count_col: str, value_col: str, limit: int) -> DataFrame:
    """Top ``limit`` employees of a per-employee aggregate by a count (id breaks ties)."""
    return (
        df.where(F.col(count_col) > 0)
        .select(ID, count_col, value_col)
        .orderBy(F.col(count_col).desc(), F.col(ID).asc_nulls_last())
        .limit(limit)
    )


def late_arrivals(ts: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Punches more than the grace late, per employee; top by count."""
    return top_by(per_employee_flags(ts.where(F.col("is_late") == 1), params), "late_count", "avg_minutes_late", params.limit_late)


def early_departures(ts: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Punches out more than the grace early, per employee; top by count."""
    return top_by(per_employee_flags(ts.where(F.col("is_early") == 1), params), "early_count", "avg_minutes_early", params.limit_early)


def overtime(ts: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Overtime punches and hours beyond the base day, per employee; top by count."""
    return top_by(per_employee_flags(ts.where(F.col("is_overtime") == 1), params), "overtime_days", "total_extra_hours", params.limit_overtime)


def rolling_avg(ts: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Rolling average over the last N punches; the latest rows."""
    return rolling_top(ts, params.limit_rolling, rows=params.rolling_rows, digits=2).select(
        ID, "punch_apply_date", "rolling_30day_avg"
    )


def early_attrition(emp: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Terminations within / after the first N days; always two rows.

    One global aggregate and a two-row ``stack`` instead of two scans and a union.
    """
    limit_us = params.early_attrition_days * 86_400_000_000
    span = micros_between("hire_date", "term_date")
    counts = emp.where(F.col("term_date").isNotNull()).agg(
        F.count_if(span < limit_us).alias("early"), F.count_if(span >= limit_us).alias("other")
    )
    return counts.select(
        F.expr(
            "stack(2, '{0}', early, '{1}', other) as (attrition_type, count)".format(
                EARLY_ATTRITION_LABEL, OTHER_ATTRITION_LABEL
            )
        )
    )


KPI_NAMES = (
    "kpi_active_headcount",
    "kpi_turnover_trend",
    "kpi_avg_tenure",
    "kpi_avg_working_hours",
    "kpi_late_arrivals",
    "kpi_early_departures",
    "kpi_overtime",
    "kpi_rolling_avg",
    "kpi_early_attrition",
)


def build_all(emp: DataFrame, ts: DataFrame, params: Params = DEFAULT) -> dict[str, DataFrame]:
    """All nine KPI DataFrames by table name."""
    return {
        "kpi_active_headcount": active_headcount(emp, ts, params),
        "kpi_turnover_trend": turnover_trend(emp, params),
        "kpi_avg_tenure": avg_tenure(emp, params),
        "kpi_avg_working_hours": avg_working_hours(ts, params),
        "kpi_late_arrivals": late_arrivals(ts, params),
        "kpi_early_departures": early_departures(ts, params),
        "kpi_overtime": overtime(ts, params),
        "kpi_rolling_avg": rolling_avg(ts, params),
        "kpi_early_attrition": early_attrition(emp, params),
    }
