"""Chart-ready datasets (C1-C9) from the gold tables; rendering is left to the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlake.functions.exprs import round_half_away
from shiftlake.operators.rolling import rolling_all_balanced
from shiftlake.params import CHART_SAMPLE_EMPLOYEES, CHART_TOP, CHART_WEEKS, DEFAULT, Params

ID = "client_employee_id"


def active_headcount(kpi: DataFrame) -> DataFrame:
    """Headcount by month, oldest first, month as yyyy-MM."""
    return kpi.orderBy(F.col("month").asc_nulls_last()).select(
        F.date_format("month", "yyyy-MM").alias("month"), "active_headcount"
    )


def turnover(kpi: DataFrame) -> DataFrame:
    """Terminations by month, oldest first, month as yyyy-MM."""
    return kpi.orderBy(F.col("month").asc_nulls_last()).select(
        F.date_format("month", "yyyy-MM").alias("month"), "terminations"
    )


def tenure(kpi: DataFrame) -> DataFrame:
    """Tenure by department, longest first."""
    return kpi.orderBy(F.col("avg_tenure_years").desc_nulls_last(), F.col("department_name").asc_nulls_last())


def _top(kpi: DataFrame, count_col: str) -> DataFrame:
    return kpi.orderBy(F.col(count_col).desc(), F.col(ID).asc_nulls_last()).limit(CHART_TOP)


def late_arrivals(kpi: DataFrame) -> DataFrame:
    """C4: top 20 by late count."""
    return _top(kpi, "late_count")


def overtime(kpi: DataFrame) -> DataFrame:
    """Top 20 by overtime punches (the chart plots their extra hours)."""
    return _top(kpi, "overtime_days")


def attrition(kpi: DataFrame) -> DataFrame:
    """The attrition split as is."""
    return kpi.select("attrition_type", "count")


def weekly_hours(kpi: DataFrame) -> DataFrame:
    """C7 (from the uncut ``weekly_hours``): per week, the average of the per-employee weekly averages and the
    number of employees; the latest 50 weeks, week as yyyy-MM-dd."""
    return (
        kpi.groupBy("week")
        .agg(
            round_half_away(F.avg("avg_hours"), 2).alias("avg_hours_all"),
            F.count_distinct(ID).alias("num_employees"),
        )
        .orderBy(F.col("week").desc_nulls_last())
        .limit(CHART_WEEKS)
        .select(F.date_format("week", "yyyy-MM-dd").alias("week"), "avg_hours_all", "num_employees")
    )


def early_departures(kpi: DataFrame) -> DataFrame:
    """Top 20 by early count."""
    return _top(kpi, "early_count")


def rolling_sample(ts: DataFrame, params: Params = DEFAULT, employees: int = CHART_SAMPLE_EMPLOYEES) -> DataFrame:
    """Ten employees drawn from all timesheets, then all their rows with the rolling average.

    The draw orders ids by md5(seed || id), a seeded shuffle that gives the
    same ten ids on every run and in SQL; the window runs over their rows only.
    """
    draw = md5_order(ts, params.sample_seed).limit(employees)
    rows = rolling_all_balanced(ts.join(draw, ID, "left_semi"), rows=params.rolling_rows, digits=2)
    return rows.orderBy(
        F.col("punch_apply_date").desc_nulls_last(), F.col(ID).asc_nulls_last(),
        F.col("rolling_30day_avg").asc_nulls_last(),
    ).select(ID, F.date_format("punch_apply_date", "yyyy-MM-dd").alias("punch_apply_date"), "rolling_30day_avg")


def md5_order(kpi: DataFrame, seed: str) -> DataFrame:
    ids = kpi.where(F.col(ID).isNotNull()).select(ID).distinct()
    key = F.md5(F.concat(F.lit(seed), F.col(ID).cast("string")))
    return ids.orderBy(key, F.col(ID))
