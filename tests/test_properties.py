"""Properties: the scalable plans equal brute force on small random data."""

import datetime as dt
import random

from pyspark.sql import functions as F

from shiftlake.operators import rolling as R
from shiftlake.operators.dedup import keep_first
from shiftlake.operators.headcount import headcount_by_month


def brute_headcount(emps, dates):
    months = {}
    for d in dates:
        m = None if d is None else dt.date(d.year, d.month, 1)
        months.setdefault(m, set())
        if d is None:
            continue
        for eid, hire, term in emps:
            if eid is not None and hire is not None and hire <= d and (term is None or term > d):
                months[m].add(eid)
    return {m: len(v) for m, v in months.items()}


def random_case(rng, n_emp, n_dates, dup_ids):
    base = dt.datetime(2020, 1, 1)
    dates = [base + dt.timedelta(days=rng.randrange(0, 120), hours=rng.choice([0, 0, 0, 7, 13])) for _ in range(n_dates)]
    dates += [None] * rng.randrange(0, 2)
    emps = []
    for i in range(n_emp):
        eid = rng.randrange(0, n_emp // 2 + 1) if dup_ids else i
        hire = base + dt.timedelta(days=rng.randrange(-20, 130), hours=rng.randrange(0, 24))
        term = None if rng.random() < 0.4 else hire + dt.timedelta(hours=rng.randrange(-30, 24 * 80))
        if rng.random() < 0.05:
            hire = None
        emps.append((eid, hire, term))
    return emps, dates


def test_headcount_equals_brute_force(spark):
    rng = random.Random(7)
    for trial in range(6):
        emps, dates = random_case(rng, 40, 60, dup_ids=trial % 2 == 1)
        e = spark.createDataFrame(emps, "client_employee_id long, hire_date timestamp_ntz, term_date timestamp_ntz")
        t = spark.createDataFrame([(d,) for d in dates], "punch_apply_date timestamp_ntz")
        got = {r.month: r.active_headcount for r in headcount_by_month(t, e).collect()}
        assert got == brute_headcount(emps, dates), trial


def test_rolling_cutoff_equals_full_window(spark):
    rng = random.Random(11)
    rows = []
    for k in range(400):
        emp = rng.choice([1, 2, 3, 4, 5, None])
        day = None if rng.random() < 0.05 else dt.datetime(2021, 1, 1) + dt.timedelta(days=rng.randrange(0, 40))
        pin = dt.datetime(2021, 1, 1, 9) + dt.timedelta(minutes=rng.randrange(0, 4))
        hours = None if rng.random() < 0.1 else rng.randrange(1, 48) / 4
        rows.append((emp, day, pin, hours, k))
    ts = spark.createDataFrame(
        rows, "client_employee_id long, punch_apply_date timestamp_ntz, punch_in_datetime timestamp_ntz, "
        "hours_worked double, k long").withColumn("_ingest", F.struct("k")).drop("k")
    for limit, n in ((25, 5), (60, 30), (390, 7)):
        fast = [tuple(r) for r in R.rolling_top(ts, limit, rows=n, digits=2).collect()]
        plain = R.rolling_all(ts, rows=n, digits=2).orderBy(*R.report_order()).limit(limit)
        assert fast == [tuple(r) for r in plain.collect()], (limit, n)


def test_keep_first_is_idempotent_and_first(spark):
    df = spark.createDataFrame(
        [(1, "a", 3), (1, "b", 1), (None, "c", 5), (None, "d", 2), (2, "e", 9)], "k long, v string, o long")
    once = keep_first(df, ["k"], "o")
    twice = keep_first(once, ["k"], "o")
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)
    assert {r.k: r.v for r in once.collect()} == {1: "b", None: "d", 2: "e"}


def test_split_rolling_equals_full_window(spark):
    rng = random.Random(5)
    rows = []
    for k in range(600):
        emp = rng.choice([1, 1, 1, 1, 2, 3, None, None])
        day = None if rng.random() < 0.05 else dt.datetime(2021, 1, 1) + dt.timedelta(days=rng.randrange(0, 30))
        pin = dt.datetime(2021, 1, 1, 9) + dt.timedelta(minutes=rng.randrange(0, 3))
        hours = None if rng.random() < 0.1 else rng.randrange(1, 48) / 4
        rows.append((emp, day, pin, hours, k))
    ts = spark.createDataFrame(
        rows, "client_employee_id long, punch_apply_date timestamp_ntz, punch_in_datetime timestamp_ntz, "
        "hours_worked double, k long").withColumn("_ingest", F.struct("k")).drop("k")
    plain = {tuple(r) for r in R.rolling_all(ts, rows=5).collect()}
    order = [F.col("client_employee_id").asc_nulls_last(), *R.window_order()]
    for n, parts in ((5, 1), (5, 7), (30, 40), (5, 150), (1, 9)):
        plain = [tuple(r) for r in R.rolling_all(ts, rows=n).orderBy(*order).collect()]
        got = R.rolling_all_balanced(ts, rows=n, parts=parts).collect()
        assert [tuple(r) for r in got] == plain, (n, parts)  # in order, too
    assert R.rolling_all_balanced(ts.limit(0)).count() == 0


def test_split_rolling_has_one_exchange_of_the_rows(spark):
    """The skewed employee spreads over the tasks; after the checkpoint only border rows are shuffled."""
    ts = spark.range(20_000).select(
        F.lit(1).cast("long").alias("client_employee_id"), F.lit(dt.datetime(2021, 1, 1)).cast("timestamp_ntz").alias("punch_apply_date"),
        F.lit(None).cast("timestamp_ntz").alias("punch_in_datetime"), F.struct(F.col("id").alias("k")).alias("_ingest"), (F.col("id") % 7).cast("double").alias("hours_worked"))
    out = R.rolling_all_balanced(ts, parts=8)
    sizes = out.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 10_000
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" not in plan and "Sort" not in plan


def test_first_rows_bounds_the_last_sort(spark):
    """One busy day: what is left holds the first rows, and few others."""
    rows = spark.range(400_000).select(F.xxhash64("id").alias("v"))
    left = R.first_rows(rows, F.struct("v"), 100, 400_000)
    assert 100 <= left.count() <= 2000
    assert [r.v for r in left.orderBy("v").limit(100).collect()] == [r.v for r in rows.orderBy("v").limit(100).collect()]
    equal = spark.range(50_000).select(F.lit(1).alias("v"))
    assert R.first_rows(equal, F.struct("v"), 100, 50_000).count() >= 100


def test_split_rolling_on_skewed_table(spark):
    """A third of the rows relabelled to one employee; big enough that the
    range split is sampled, which once made two plan branches disagree."""
    from shiftlake.plans import catalog as C

    ts = C.silver_timesheets(spark, "/root/testdata/sf0.01")
    skewed = ts.withColumn(
        "client_employee_id",
        F.when(F.col("_ingest.l_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("client_employee_id")),
    )
    def digest(df):
        h = F.xxhash64("client_employee_id", "punch_apply_date", "punch_in_datetime", "_ingest", "rolling_30day_avg")
        return df.select(F.count("*"), F.bit_xor(h)).first()

    assert digest(R.rolling_all_balanced(skewed)) == digest(R.rolling_all(skewed))
