"""Silver cleaning of employees and timesheets.

Both transforms keep every incoming column (the silver schema is open) and
append the derived ones. Input columns may be text (from delimited files) or
already typed (from Parquet); the coercions handle both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftlake.functions.dates import ALL_FORMATS, first_kept_values, first_values, infer_format
from shiftlake.functions.exprs import coerce_timestamp, days_floor, flag, minutes_between
from shiftlake.operators.dedup import keep_first
from shiftlake.params import (
    DEFAULT,
    EMPLOYEE_DATE_COLS,
    EMPLOYEE_KEY,
    INGEST_COL,
    TIMESHEET_KEY,
    TIMESHEET_TS_COLS,
    Params,
)


def _dtype(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


# --- employees -------------------------------------------------------------


def dedup_employees(df: DataFrame) -> DataFrame:
    """First row per employee id in file order."""
    return keep_first(df, [EMPLOYEE_KEY], INGEST_COL)


def _coerced(
    df: DataFrame, dates: list[str], numbers: list[str], params: Params, seen: Observation | None, rows: DataFrame | None, keys: Sequence[str]
) -> DataFrame:
    """The columns as naive timestamps and doubles; ``seen`` is told, per column, how many values were lost.
    ``rows``, if given, are those whose first of each key ``df`` holds."""
    first = {}
    if params.ts_formats is None and INGEST_COL in df.columns:
        first = first_values(df, dates, INGEST_COL) if rows is None else first_kept_values(rows, df, list(keys), dates, INGEST_COL)
    parsed = {}
    for name in dates:
        known = infer_format(first.get(name))
        formats = params.ts_formats or ((known,) if known else ALL_FORMATS)
        parsed[name] = coerce_timestamp(name, _dtype(df, name), formats)
    for name in numbers:
        if not isinstance(_dtype(df, name), T.DoubleType):
            parsed[name] = F.col(name).try_cast("double")
    if seen is not None and parsed:
        new = {name: f"_parsed_{name}" for name in parsed}
        df = df.select("*", *[c.alias(new[name]) for name, c in parsed.items()])
        lost = [F.count_if(F.col(name).isNotNull() & F.col(new[name]).isNull()).alias(f"lost_{name}") for name in parsed]
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"), *lost)
        parsed = {name: F.col(new[name]) for name in parsed}
        return df.select(*[parsed.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns if c not in new.values()])
    return df.withColumns(parsed) if parsed else df


def coerce_employee_dates(
    df: DataFrame, params: Params = DEFAULT, seen: Observation | None = None, rows: DataFrame | None = None
) -> DataFrame:
    """Hire, term and birth dates to naive timestamps; bad values to null."""
    return _coerced(df, [c for c in EMPLOYEE_DATE_COLS if c in df.columns], [], params, seen, rows, [EMPLOYEE_KEY])


def with_is_active(df: DataFrame) -> DataFrame:
    """1 while there is no (parseable) termination date."""
    return df.withColumn("is_active", F.col("term_date").isNull().cast("bigint"))


def with_tenure_days(df: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Whole days from hire to termination, or to ``as_of`` when still employed."""
    end = F.coalesce(F.col("term_date"), F.lit(params.as_of).cast(T.TimestampNTZType()))
    return df.withColumn("tenure_days", days_floor(F.col("hire_date"), end))


def transform_employees(df: DataFrame, params: Params = DEFAULT, seen: Observation | None = None) -> DataFrame:
    """E5: E1 to E4 in order."""
    return (
        df.transform(dedup_employees)
        .transform(coerce_employee_dates, params, seen, df)
        .transform(with_is_active)
        .transform(with_tenure_days, params)
    )


# --- timesheets ------------------------------------------------------------


def dedup_timesheets(df: DataFrame) -> DataFrame:
    """First row per (employee, punch-in) on the values as read, before parsing."""
    return keep_first(df, list(TIMESHEET_KEY), INGEST_COL)


def coerce_timesheet_datetimes(
    df: DataFrame, params: Params = DEFAULT, seen: Observation | None = None, rows: DataFrame | None = None
) -> DataFrame:
    """The five date-time columns to naive timestamps; bad values to null."""
    return _coerced(df, list(TIMESHEET_TS_COLS), [c for c in ("hours_worked",) if c in df.columns], params, seen, rows, TIMESHEET_KEY)


def with_minutes(df: DataFrame) -> DataFrame:
    """Signed minutes late and early; null when a time is missing becomes 0."""
    return df.withColumn(
        "minutes_late",
        F.coalesce(minutes_between("scheduled_start_datetime", "punch_in_datetime"), F.lit(0.0)),
    ).withColumn(
        "minutes_early",
        F.coalesce(minutes_between("punch_out_datetime", "scheduled_end_datetime"), F.lit(0.0)),
    )


def with_flags(df: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Late, early, overtime and normal-hours flags as 0/1."""
    hours = F.col("hours_worked")
    return (
        df.withColumn("is_late", flag(F.col("minutes_late") > params.grace_minutes))
        .withColumn("is_early", flag(F.col("minutes_early") > params.grace_minutes))
        .withColumn("is_overtime", flag(hours > params.overtime_hours))
        .withColumn("is_normal_work", flag(hours.between(params.normal_min_hours, params.normal_max_hours)))
    )


def transform_timesheets(df: DataFrame, params: Params = DEFAULT, seen: Observation | None = None) -> DataFrame:
    """T1 to T8 in order."""
    return (
        df.transform(dedup_timesheets)
        .transform(coerce_timesheet_datetimes, params, seen, df)
        .transform(with_minutes)
        .transform(with_flags, params)
    )


def public_columns(df: DataFrame) -> DataFrame:
    """Drop the internal row-order column for user-facing reads."""
    return df.drop(INGEST_COL)
