"""The counts FIXTURES.md §3 records for sf0.01, recomputed from our silver tables."""

from pyspark.sql import functions as F

from shiftlake.plans import catalog as C

SF = "/root/testdata/sf0.01"


def test_employee_counts(spark):
    emp = C.silver_employees(spark, SF)
    span = F.timestamp_diff("MICROSECOND", "hire_date", "term_date")
    day90 = 90 * 86_400_000_000
    r = emp.agg(
        F.count("*").alias("n"),
        F.count("department_name").alias("dept"),
        F.count("term_date").alias("term"),
        F.count_if(span < day90).alias("under90"),
        F.count_if(span >= day90).alias("over90"),
        F.count_if(span == day90).alias("exactly90"),
    ).first()
    assert tuple(r) == (1500, 1445, 425, 113, 312, 1)


def test_timesheet_counts(spark):
    ts = C.silver_timesheets(spark, SF)
    r = ts.agg(
        F.count("*").alias("n"),
        F.count("punch_apply_date").alias("apply"),
        F.count("punch_out_datetime").alias("out"),
        F.count("hours_worked").alias("hours"),
        F.sum("is_overtime").alias("overtime"),
        F.sum("is_normal_work").alias("normal"),
        F.count_if(F.col("hours_worked").isin(7.5, 8.5)).alias("edge"),
        F.sum("hours_worked").alias("total"),
        F.sum("is_late").alias("late"),
        F.count_if(F.col("minutes_late") == 5).alias("five"),
        F.sum("is_early").alias("early"),
    ).first()
    assert tuple(r) == (49905, 49803, 43875, 47756, 15172, 4733, 1880, 303086.5, 22344, 5007, 13749)
    raw = C.FX.timesheets_raw(spark, SF).count()
    assert raw == 60000


def test_grouping_counts(spark):
    ts = C.silver_timesheets(spark, SF)
    multi = ts.groupBy("client_employee_id", "punch_apply_date").count().where("count > 1").count()
    per_emp = ts.groupBy("client_employee_id").count().agg(F.min("count"), F.max("count")).first()
    weeks = ts.where("is_normal_work = 1").select(
        "client_employee_id", F.date_trunc("week", "punch_apply_date").alias("w")).distinct().count()
    assert (multi, tuple(per_emp), weeks) == (13341, (3, 77), 4109)
