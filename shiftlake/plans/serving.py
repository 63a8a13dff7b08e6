"""Serving reads (A1-A12) as parameterised DataFrame functions.

The reads sort and cut small gold tables, or look up silver rows. Text
parameters are converted with ``try_cast`` so a bad id finds nothing instead
of failing the job.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftlake.functions.exprs import round_half_away
from shiftlake.params import SERVE_EMPLOYEES, SERVE_MONTHS, SERVE_ROLLING, SERVE_TIMESHEETS, SERVE_TOP

ID = "client_employee_id"


def _id_literal(df: DataFrame, emp_id: str):
    return F.lit(emp_id).try_cast(df.schema[ID].dataType)


def _employee_order(df: DataFrame) -> list:
    """Id, then hire date and names: rows inserted with an existing id get a fixed place."""
    extra = [c for c in ("hire_date", "last_name", "first_name") if c in df.columns]
    return [F.col(ID).asc_nulls_last()] + [F.col(c).asc_nulls_last() for c in extra]


def employees(silver_emp: DataFrame, limit: int = SERVE_EMPLOYEES) -> DataFrame:
    """A1: the first ``limit`` employees by id."""
    return silver_emp.orderBy(*_employee_order(silver_emp)).limit(limit)


def employee(silver_emp: DataFrame, emp_id: str) -> DataFrame:
    """A2: the employee with this id (empty if not found); with several rows for
    the id (inserts do not check uniqueness) the earliest hired is returned."""
    rows = silver_emp.where(F.col(ID) == _id_literal(silver_emp, emp_id))
    return rows.orderBy(*_employee_order(rows)).limit(1)


def timesheets(
    silver_ts: DataFrame,
    client_employee_id: str | None = None,
    start_date: str | None = None,
    end_date: str | None = None,
    limit: int = SERVE_TIMESHEETS,
) -> DataFrame:
    """A3: optional AND-ed filters (empty text = no filter), latest first.

    ``end_date`` compares as midnight of that day, as a date-time literal would.
    The predicates reach the Parquet scan as pushed filters; silver files are
    sorted by apply date, so row groups outside the range are skipped.
    """
    preds = []
    if client_employee_id:
        preds.append(F.col(ID) == _id_literal(silver_ts, client_employee_id))
    if start_date:
        preds.append(F.col("punch_apply_date") >= F.lit(start_date).try_cast("timestamp_ntz"))
    if end_date:
        preds.append(F.col("punch_apply_date") <= F.lit(end_date).try_cast("timestamp_ntz"))
    df = silver_ts.where(reduce(lambda a, b: a & b, preds)) if preds else silver_ts
    order = [F.col("punch_apply_date").desc_nulls_last(), F.col(ID).asc_nulls_last(),
             F.col("punch_in_datetime").asc_nulls_last()]
    if "_ingest" in df.columns:
        order.append(F.col("_ingest").asc())
    return df.orderBy(*order).limit(limit)


def timesheets_counted(silver_ts: DataFrame, **filters) -> DataFrame:
    """A3 with the number of returned rows (at most ``limit``) beside each row, in ``count``."""
    rows = timesheets(silver_ts, **filters)
    whole = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.withColumn("count", F.count(F.lit(1)).over(whole))


def active_headcount(kpi: DataFrame) -> DataFrame:
    """A4: the latest 12 months."""
    return kpi.select("month", "active_headcount").orderBy(F.col("month").desc_nulls_last()).limit(SERVE_MONTHS)


def turnover_rate(turnover: DataFrame, headcount: DataFrame) -> DataFrame:
    """A5: the latest 12 months of terminations with terminations / active headcount.

    Both inputs are per-month gold tables (bounded by the calendar), joined on month.
    """
    hc = headcount.where(F.col("month").isNotNull()).select("month", "active_headcount")
    return (
        turnover.join(hc, "month", "left")
        .select(
            "month",
            "terminations",
            F.when(F.col("active_headcount") > 0, F.col("terminations") / F.col("active_headcount")).alias(
                "turnover_rate"
            ),
        )
        .orderBy(F.col("month").desc_nulls_last())
        .limit(SERVE_MONTHS)
    )


def tenure(kpi: DataFrame) -> DataFrame:
    """Tenure by department, renamed."""
    return kpi.select(
        F.col("department_name").alias("department"),
        round_half_away("avg_tenure_years", 2).alias("avg_years"),
        F.col("employee_count").alias("count"),
    ).orderBy(F.col("avg_years").desc_nulls_last(), F.col("department").asc_nulls_last())


def _top(kpi: DataFrame, count_col: str, value_col: str, names: tuple[str, str, str]) -> DataFrame:
    return (
        kpi.orderBy(F.col(count_col).desc(), F.col(ID).asc_nulls_last())
        .limit(SERVE_TOP)
        .select(
            F.col(ID).alias(names[0]),
            F.col(count_col).alias(names[1]),
            round_half_away(value_col, 1).alias(names[2]),
        )
    )


def late_arrivals(kpi: DataFrame) -> DataFrame:
    """Top 20 late, average re-rounded to one place."""
    return _top(kpi, "late_count", "avg_minutes_late", ("employee_id", "late_count", "avg_min_late"))


def overtime(kpi: DataFrame) -> DataFrame:
    """Top 20 overtime, extra hours re-rounded to one place."""
    return _top(kpi, "overtime_days", "total_extra_hours", ("employee_id", "overtime_days", "extra_hours"))


def attrition(kpi: DataFrame) -> DataFrame:
    """Attrition split by count, largest first."""
    return kpi.select(F.col("attrition_type").alias("type"), "count").orderBy(
        F.col("count").desc(), F.col("type").asc()
    )


def avg_working_hours(kpi: DataFrame) -> DataFrame:
    """A10: the latest 20 employee-weeks, re-rounded to one place."""
    return (
        kpi.orderBy(F.col("week").desc_nulls_last(), F.col(ID).asc_nulls_last())
        .limit(SERVE_TOP)
        .select(
            F.col(ID).alias("employee"),
            "week",
            round_half_away("avg_hours", 1).alias("avg_hours"),
            F.col("days_worked").alias("days"),
        )
    )


def early_departures(kpi: DataFrame) -> DataFrame:
    """Top 20 early, re-rounded to one place."""
    return _top(kpi, "early_count", "avg_minutes_early", ("employee_id", "early_count", "avg_min_early"))


def rolling_avg_hours(kpi: DataFrame) -> DataFrame:
    """The latest 50 rolling averages, re-rounded to one place.

    The gold table no longer has the punch order, so several punches of one
    employee on one day are ordered by their value: rows equal in all three
    columns are interchangeable, so the result is fixed.
    """
    return (
        kpi.orderBy(
            F.col("punch_apply_date").desc_nulls_last(), F.col(ID).asc_nulls_last(),
            F.col("rolling_30day_avg").asc_nulls_last(),
        )
        .limit(SERVE_ROLLING)
        .select(
            F.col(ID).alias("employee"),
            F.col("punch_apply_date").alias("date"),
            round_half_away("rolling_30day_avg", 1).alias("rolling_30d_avg"),
        )
    )
