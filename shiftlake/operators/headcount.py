"""Active headcount per observed month, without a product of employees and dates.

Definition (G1): for every month that occurs among the timesheet apply dates
(a null date forms a null month), count the distinct employee ids for which
some observed apply date ``d`` of that month has ``hire <= d`` and
``term is null or term > d``. An employee table with no rows at all gives no
months; a null month always counts 0.

Plan (a sweep, linear in the inputs):

1. Day summary: group the apply dates by calendar day -> (min, max). Only
   days inside the timestamp range exist, so this table has at most ~213k
   rows whatever the data size. A calendar built from it (one row per day
   between the first and last observed day, plus one on each side) is
   broadcast with that bound. It is checkpointed to the shared folder, so
   the timesheets are scanned once and the plan below reads small files.
2. For an employee let ``lo`` be the first observed date at or after hire and
   ``hi`` the last one before termination. The months in which they count are
   exactly the observed months from month(lo) to month(hi). Both months come
   from calendar look-ups on the hire day and termination day (same day if
   that day has a qualifying date, else the next / previous observed day),
   so each employee is one equi-join row.
3. Whether ``lo <= hi`` is decided by the days, except when hire and
   termination fall on the same day that holds several distinct apply
   times; those few employees are settled by that day's seconds, and where one second
   holds both ends, by its times.
4. Intervals of one id are merged (duplicate ids after inserts), then the
   count per month is (intervals started by the month) - (intervals ended
   before it), a running sum over the observed months (bounded as in 1).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftlake.functions.exprs import month_start
from shiftlake.session import checkpoint_root


def apply_times(timesheets: DataFrame, date_col: str = "punch_apply_date") -> DataFrame:
    """The distinct observed apply times (a null one included): all that the headcount needs of the timesheets."""
    return timesheets.select(date_col).distinct()


def _scalar(df: DataFrame) -> Column:
    return df.scalar()


def headcount_by_month(
    timesheets: DataFrame,
    employees: DataFrame,
    date_col: str = "punch_apply_date",
    id_col: str = "client_employee_id",
    hire_col: str = "hire_date",
    term_col: str = "term_date",
) -> DataFrame:
    """Returns ``(month DATE, active_headcount BIGINT)`` sorted by month desc."""
    d = F.col(date_col)
    checkpoint_root(timesheets.sparkSession)  # reliable checkpoints go to the shared folder

    # 1. day summary: one scan of the apply-date column, partial aggregates, one
    #    small shuffle. The calendar built from it carries the summary columns,
    #    plus one row with a null day when some apply date is null; it is
    #    bounded by the timestamp range, written once and reused below.
    days = (
        timesheets.select(d.alias("d"))
        .groupBy(F.col("d").cast("date").alias("day"))
        .agg(F.min("d").alias("dmin"), F.max("d").alias("dmax"))
    )
    observed_days = days.where(F.col("day").isNotNull())
    calendar = (
        observed_days.agg(F.date_sub(F.min("day"), 1).alias("a"), F.date_add(F.max("day"), 1).alias("b"))
        .select(F.explode(F.sequence("a", "b")).alias("day"))
        .join(observed_days, "day", "left")
        .withColumn(
            "next_min",
            # the days after, as a running frame over the reverse order (a following frame is recomputed for every row)
            F.min("dmin").over(Window.orderBy(F.col("day").desc()).rowsBetween(Window.unboundedPreceding, -1)),
        )
        .withColumn(
            "prev_max",
            F.max("dmax").over(Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)),
        )
        .unionByName(
            days.where(F.col("day").isNull()).select(
                "day", "dmin", "dmax",
                F.lit(None).cast(days.schema["dmin"].dataType).alias("next_min"),
                F.lit(None).cast(days.schema["dmax"].dataType).alias("prev_max"),
            )
        )
        .checkpoint()
    )
    observed = calendar.where(F.col("dmin").isNotNull())
    months = observed.select(month_start(F.col("day")).alias("month")).distinct().unionByName(
        calendar.where(F.col("day").isNull()).select(F.lit(None).cast("date").alias("month"))
    )
    calendar = calendar.where(F.col("day").isNotNull())

    first_day = _scalar(observed.select(F.min("day")))
    last_day = _scalar(observed.select(F.max("day")))

    # 2. one look-up per employee on the hire day and on the termination day
    lo_edge = F.date_sub(first_day, 1)
    hi_edge = F.date_add(last_day, 1)

    def clamp(c: Column) -> Column:
        return F.least(F.greatest(c, lo_edge), hi_edge)

    emp = employees.select(
        F.col(id_col).alias("id"), F.col(hire_col).alias("hire"), F.col(term_col).alias("term")
    ).where(F.col("id").isNotNull() & F.col("hire").isNotNull())
    emp = emp.withColumn("hday", clamp(F.col("hire").cast("date"))).withColumn(
        "tday", clamp(F.coalesce(F.col("term").cast("date"), hi_edge))
    )
    cal_h = F.broadcast(calendar.select(
        F.col("day").alias("hday"), F.col("dmax").alias("h_dmax"), (F.col("dmin") < F.col("dmax")).alias("h_multi"),
        F.col("next_min").alias("h_next"),
    ))
    cal_t = F.broadcast(calendar.select(
        F.col("day").alias("tday"), F.col("dmin").alias("t_dmin"), F.col("prev_max").alias("t_prev"),
    ))
    emp = emp.join(cal_h, "hday", "left").join(cal_t, "tday", "left")

    h_same = F.coalesce(F.col("h_dmax") >= F.col("hire"), F.lit(False))
    t_same = F.coalesce(F.col("term").isNotNull() & (F.col("t_dmin") < F.col("term")), F.lit(False))
    emp = emp.withColumn("lo_day", F.when(h_same, F.col("hday")).otherwise(F.col("h_next").cast("date")))
    emp = emp.withColumn("hi_day", F.when(t_same, F.col("tday")).otherwise(F.col("t_prev").cast("date")))
    # 3. hire and termination inside one day with several distinct apply times
    needs_points = h_same & t_same & (F.col("hday") == F.col("tday")) & F.col("h_multi")
    emp = emp.withColumn("needs_points", needs_points)
    spans = emp.where(~F.col("needs_points") & (F.col("lo_day") <= F.col("hi_day"))).select("id", "lo_day", "hi_day")
    point_emps = emp.where(F.col("needs_points"))
    # rare: only days holding several distinct apply times can need it (checked on the small day summary)
    if not observed.where(F.col("dmin") < F.col("dmax")).isEmpty():
        spans = spans.unionByName(_same_day_check(timesheets.select(d.alias("d")), point_emps))

    # 4. merge the spans of one id, count starts and ends per month
    spans = spans.select(
        "id", month_start(F.col("lo_day")).alias("s"), month_start(F.col("hi_day")).alias("e")
    ).groupBy("id", "s").agg(F.max("e").alias("e"))
    w_id = Window.partitionBy("id").orderBy("s")
    spans = spans.withColumn(
        "prev_e", F.max("e").over(w_id.rowsBetween(Window.unboundedPreceding, -1))
    ).withColumn(
        "island", F.sum(F.when(F.col("prev_e").isNull() | (F.col("s") > F.col("prev_e")), 1).otherwise(0)).over(
            w_id.rowsBetween(Window.unboundedPreceding, 0)
        )
    )
    islands = spans.groupBy("id", "island").agg(F.min("s").alias("s"), F.max("e").alias("e"))
    starts = islands.groupBy(F.col("s").alias("month")).agg(F.count("*").alias("n_start"))
    ends = islands.groupBy(F.col("e").alias("month")).agg(F.count("*").alias("n_end"))

    sweep = (
        months.where(F.col("month").isNotNull())
        .join(starts, "month", "left")
        .join(ends, "month", "left")
        .fillna(0, ["n_start", "n_end"])
    )
    w_m = Window.orderBy("month")
    sweep = sweep.select(
        "month",
        (
            F.sum("n_start").over(w_m.rowsBetween(Window.unboundedPreceding, 0))
            - F.coalesce(F.sum("n_end").over(w_m.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        ).cast("bigint").alias("active_headcount"),
    )
    null_month = months.where(F.col("month").isNull()).select("month", F.lit(0).cast("bigint").alias("active_headcount"))
    any_employee = _scalar(employees.select(F.count("*"))) > 0
    return sweep.unionByName(null_month).where(any_employee).orderBy(F.col("month").desc_nulls_last())


def _second(t: Column) -> Column:
    """The whole second a time lies in."""
    return F.floor(F.timestamp_diff("MICROSECOND", F.lit(dt.datetime(1970, 1, 1)).cast("timestamp_ntz"), t) / F.lit(1_000_000))


def _same_day_check(dates: DataFrame, emp: DataFrame) -> DataFrame:
    """Spans of employees whose hire and termination share a busy day.

    The employee counts iff some apply time t of that day has hire <= t < term.
    First by seconds: if hire and term lie in different ones, the last time in the
    hire's second and the first time after that second decide, found on at most
    86,400 rows a day. Only spans inside one second need its single times, at most
    a million. Equal spans are judged once; no pairs are formed.
    """
    days = emp.select(F.col("hday").alias("day")).distinct()  # bounded by the days of the timestamp range
    times = (
        dates.where(F.col("d").isNotNull())
        .select(F.col("d").cast("date").alias("day"), F.col("d").cast("timestamp_ntz").alias("t"))
        .join(F.broadcast(days), "day", "left_semi")
        .distinct()
        .withColumn("sec", _second(F.col("t")))
    )
    own = emp.select(F.col("hday").alias("day"), F.col("hire").cast("timestamp_ntz").alias("hire"), F.col("term").cast("timestamp_ntz").alias("term"))
    spans = own.distinct().withColumn("sec", _second(F.col("hire"))).withColumn("end_sec", _second(F.col("term")))

    # per second its first and last time, and the first time of a later second
    none = F.lit(None).cast("timestamp_ntz")
    seconds = times.groupBy("day", "sec").agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
    asked = spans.select("day", "sec", none.alias("lo"), none.alias("hi"))
    line = seconds.unionByName(asked.distinct()).groupBy("day", "sec").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    later = Window.partitionBy("day").orderBy(F.col("sec").desc()).rowsBetween(Window.unboundedPreceding, -1)
    line = line.withColumn("next_lo", F.last("lo", ignorenulls=True).over(later))
    apart = spans.where(F.col("sec") < F.col("end_sec")).join(line, ["day", "sec"]).where((F.col("hi") >= F.col("hire")) | (F.col("next_lo") < F.col("term")))

    # within one second: the first time at or after the hire
    close = spans.where(F.col("sec") == F.col("end_sec"))
    points = times.join(close.select("day", "sec").distinct(), ["day", "sec"], "left_semi").select("day", "sec", "t", none.alias("term"), F.lit(1).alias("is_time"))
    points = points.unionByName(close.select("day", "sec", F.col("hire").alias("t"), "term", F.lit(0).alias("is_time")))
    down = Window.partitionBy("day", "sec").orderBy(F.col("t").desc(), F.col("is_time").desc()).rowsBetween(Window.unboundedPreceding, -1)
    points = points.withColumn("next_t", F.last(F.when(F.col("is_time") == 1, F.col("t")), ignorenulls=True).over(down))
    within = points.where((F.col("is_time") == 0) & (F.col("next_t") < F.col("term")))

    held = apart.select("day", "hire", "term").unionByName(within.select("day", F.col("t").alias("hire"), "term"))
    same = (F.col("hday") == F.col("day")) & (emp["hire"].cast("timestamp_ntz") == held["hire"]) & (emp["term"].cast("timestamp_ntz") == held["term"])
    return emp.join(held, same).select("id", F.col("day").alias("lo_day"), F.col("day").alias("hi_day"))
