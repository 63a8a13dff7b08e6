"""Batch changes against a replay in order, the versioned write, and the bounds of two plans."""

import datetime as dt
import shutil
import time

import pytest
from pyspark.sql import functions as F

from shiftlake.operators import changes as CG
from shiftlake.operators.headcount import headcount_by_month
from shiftlake.operators.rolling import rolling_all, rolling_top
from shiftlake.params import INGEST_COL

D = dt.datetime
SILVER = (
    "client_employee_id long, first_name string, last_name string, department_name string, "
    "hire_date timestamp_ntz, term_date timestamp_ntz, is_active long, tenure_days long"
)
BATCH = [
    ("update", 1, "New", None, None, None, 1), ("update", 1, None, None, "Moved", None, 2),
    ("delete", 2, None, None, None, None, 1), ("insert", 2, "Again", "b", "HR", D(2021, 1, 1), 2),
    ("insert", 7, "Seven", "g", "HR", D(2021, 1, 1), 1), ("update", 7, None, None, "Ops", None, 2),
    ("update", 3, "X", None, None, None, 1), ("delete", 3, None, None, None, None, 2), ("update", 3, "Y", None, None, None, 3),
    ("update", 4, "B", None, None, None, 5), ("update", 4, "A", None, None, None, 5),
    ("update", 5, "Null", "Null", None, None, None), ("update", 5, "Later", None, None, None, 1),
    ("insert", None, "No", "id", "HR", None, 1), ("insert", None, "No2", "id", "HR", None, 1), ("delete", None, None, None, None, None, 2),
    ("delete", 9, None, None, None, None, 3), ("update", 1, None, None, None, None, 9), ("insert", 1, "Twin", "a", "HR", None, 4),
    ("update", 1, None, "Both", None, None, 10),
]


def replay(rows, batch):
    """The definition: one change after another."""
    rows = [dict(zip(("id", "first", "last", "dept"), r, strict=True)) for r in rows]
    order = lambda c: tuple((v is not None, v) for v in (c[6], c[0], *c[2:6]))
    rejected = []
    for op, who, first, last, dept, _hire, _seq in sorted(batch, key=order):
        mine = [r for r in rows if who is not None and r["id"] == who]
        if op == "insert":
            rows.append({"id": who, "first": first, "last": last, "dept": dept})
        elif not mine:
            rejected.append((op, who, "not found"))
        elif op == "delete":
            rows = [r for r in rows if r["id"] != who]
        elif first is None and last is None and dept is None:
            rejected.append((op, who, "no fields to update"))
        else:
            for r in mine:
                r.update({k: v for k, v in (("first", first), ("last", last), ("dept", dept)) if v is not None})
    return sorted(map(str, ((r["id"], r["first"], r["last"], r["dept"]) for r in rows))), sorted(map(str, rejected))


def test_batch_equals_replay(spark):
    base = [(k, f"F{k}", f"L{k}", "Ops") for k in range(1, 7)]
    silver = spark.createDataFrame([(*r, D(2020, 1, 1), None, 1, 100) for r in base], SILVER)
    batch = spark.createDataFrame(BATCH, CG.CHANGE_SCHEMA)
    rows, rejected = replay(base, BATCH)
    got = CG.apply(silver, batch)
    assert got.columns == silver.columns
    assert sorted(str(tuple(r)[:4]) for r in got.collect()) == rows
    assert sorted(str((r.op, r.client_employee_id, r.reason)) for r in CG.rejects(silver, batch).collect()) == rejected
    empty = spark.createDataFrame([], CG.CHANGE_SCHEMA)
    assert CG.apply(silver, empty).count() == 6 and CG.apply(silver.limit(0), batch).where("client_employee_id = 7").count() == 1


def test_rejects_of_one_id_over_many_tasks(spark):
    """All changes concern one id: the state is carried over the parts."""
    ops = ["delete", "insert", "update", "update", "delete", "delete", "insert", "update"]
    batch = [(ops[k % 8], 1, f"n{k}", None, None, None, k) for k in range(400)]
    base = [(1, "F", "L", "Ops")]
    silver = spark.createDataFrame([(*r, D(2020, 1, 1), None, 1, 100) for r in base], SILVER)
    frame = spark.createDataFrame(batch, CG.CHANGE_SCHEMA).repartition(5)
    found = CG.rejects(silver, frame)
    assert sorted(str((r.op, r.client_employee_id, r.reason)) for r in found.collect()) == replay(base, batch)[1]


def test_replace_table_switches_or_leaves(spark, tmp_path):
    from shiftlake.sources import versions
    from shiftlake.sources.lake import Lake, replace_table

    lake = Lake(str(tmp_path))
    with pytest.raises(FileNotFoundError):
        lake.read(spark, "silver", "t")
    replace_table(spark.range(3), lake, "silver", "t")
    old = lake.read(spark, "silver", "t")
    replace_table(old.where("id > 0"), lake, "silver", "t")
    assert lake.read(spark, "silver", "t").count() == 2 and old.count() == 3
    with pytest.raises(Exception):
        replace_table(spark.range(5).select(F.raise_error(F.lit("no")).alias("id")), lake, "silver", "t")
    assert lake.read(spark, "silver", "t").count() == 2 and versions.latest(spark, str(tmp_path)).number == 2
    for _ in range(4):
        replace_table(spark.range(1), lake, "silver", "t")
    gone = versions.vacuum(spark, str(tmp_path), keep=2)
    assert len(gone) == 5 and lake.read(spark, "silver", "t").count() == 1  # three replaced ones, two of failed or older tries
    assert len(list((tmp_path / "silver" / "t").iterdir())) == 2


def test_of_two_commits_on_one_base_the_second_fails(spark, tmp_path):
    from shiftlake.sources import versions

    one, two = (versions.Commit(spark, str(tmp_path)) for _ in range(2))
    for k, commit in enumerate((one, two)):
        commit.write("silver/t", spark.range(k + 1))
    one.publish()
    with pytest.raises(versions.Conflict):
        two.publish()
    assert spark.read.parquet(f"{tmp_path}/{versions.latest(spark, str(tmp_path)).tables['silver/t']}").count() == 1
    assert [p.name for p in (tmp_path / "_versions").glob("*.tmp")] == []


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """A lake with silver and gold, to be copied by each test."""
    from shiftlake.plans import catalog as C
    from shiftlake.plans import job
    from shiftlake.sources.lake import Lake, write_silver

    sf, root = "/root/testdata/sf0.001", tmp_path_factory.mktemp("built")
    write_silver(spark, Lake(str(root)), C.silver_employees_plan(spark, sf), C.silver_timesheets_plan(spark, sf))
    job.build_gold(spark, Lake(str(root)), C.FIXTURE)
    return root


def batch_of(spark):
    return spark.createDataFrame([("insert", -1, "N", "n", "NEW", D(1996, 1, 1), 1), ("delete", -5, None, None, None, None, 2)], CG.CHANGE_SCHEMA)


EMPLOYEE_KPIS = ("kpi_active_headcount", "kpi_turnover_trend", "kpi_avg_tenure", "kpi_early_attrition")


def test_job_applies_changes_once(spark, tmp_path, built):
    from shiftlake.plans import catalog as C
    from shiftlake.plans import job
    from shiftlake.sources import versions
    from shiftlake.sources.lake import Lake

    root = str(shutil.copytree(built, tmp_path / "lake"))
    lake = Lake(root)
    before = lake.read(spark, "silver", "silver_employees").count()
    untouched = {t: f for t, f in versions.latest(spark, root).tables.items() if t.split("/")[1] not in (*EMPLOYEE_KPIS, "silver_employees")}
    report = job.apply_changes(spark, root, batch_of(spark), "batch-1", C.FIXTURE)
    assert report["rejected"] == 1 and not report["failures"] and set(report["gold_rows"]) == set(EMPLOYEE_KPIS)
    number = versions.latest(spark, root).number
    assert job.apply_changes(spark, root, batch_of(spark), "batch-1", C.FIXTURE) == report
    now = versions.latest(spark, root)
    assert now.number == number and untouched.items() <= now.tables.items()
    assert lake.read(spark, "silver", "silver_employees").count() == before + 1
    assert lake.read(spark, "gold", "kpi_avg_tenure").where("department_name = 'NEW'").count() == 1
    # equal to a full rebuild, and no timesheet was read for it
    refreshed = {k: sorted(map(str, lake.read(spark, "gold", k).collect())) for k in EMPLOYEE_KPIS}
    job.build_gold(spark, lake, C.FIXTURE)
    assert refreshed == {k: sorted(map(str, lake.read(spark, "gold", k).collect())) for k in EMPLOYEE_KPIS}


def test_refresh_does_not_read_timesheets(spark, tmp_path, built):
    from shiftlake.plans import catalog as C
    from shiftlake.plans import job
    from shiftlake.sources import versions

    root = shutil.copytree(built, tmp_path / "lake")
    shutil.move(root / versions.latest(spark, str(root)).tables["silver/silver_timesheets"], tmp_path / "away")
    assert not job.apply_changes(spark, str(root), batch_of(spark), "b", C.FIXTURE)["failures"]


@pytest.mark.parametrize("step", ["rejects", "employees", "kpi", "publish"])
def test_killed_at_any_step_the_batch_can_be_run_again(spark, tmp_path, built, monkeypatch, step):
    from shiftlake.plans import catalog as C
    from shiftlake.plans import job
    from shiftlake.sources import versions
    from shiftlake.sources.lake import Lake

    root = str(shutil.copytree(built, tmp_path / "lake"))
    lake = Lake(root)
    before = versions.latest(spark, root)
    rows = lake.read(spark, "silver", "silver_employees").count()
    write, publish = versions.Commit.write, versions.Commit.publish
    stop = {"rejects": "silver/rejected_changes", "employees": "silver/silver_employees", "kpi": "gold/kpi_avg_tenure"}.get(step)

    class Killed(BaseException):
        pass

    def killed_write(self, table, df):
        path = write(self, table, df)
        if table == stop:
            raise Killed
        return path

    def killed_publish(self, *args):
        raise Killed

    with monkeypatch.context() as m:
        m.setattr(versions.Commit, "write", killed_write)
        if step == "publish":
            m.setattr(versions.Commit, "publish", killed_publish)
        with pytest.raises(Killed):
            job.apply_changes(spark, root, batch_of(spark), "b", C.FIXTURE)
    assert versions.latest(spark, root) == before and lake.read(spark, "silver", "silver_employees").count() == rows
    assert publish is versions.Commit.publish
    report = job.apply_changes(spark, root, batch_of(spark), "b", C.FIXTURE)
    assert not report["failures"] and lake.read(spark, "silver", "silver_employees").count() == rows + 1
    assert versions.latest(spark, root).number == before.number + 1


def test_a_batch_starts_again_after_another_commit(spark, tmp_path, built, monkeypatch):
    from shiftlake.plans import catalog as C
    from shiftlake.plans import job
    from shiftlake.sources import versions
    from shiftlake.sources.lake import Lake

    root = str(shutil.copytree(built, tmp_path / "lake"))
    lake = Lake(root)
    rows = lake.read(spark, "silver", "silver_employees").count()
    publish, others = versions.Commit.publish, []

    def late(self, *args):
        if not others:  # another batch gets in between
            others.append(None)
            job.apply_changes(spark, root, batch_of(spark), "other", C.FIXTURE)
        return publish(self, *args)

    monkeypatch.setattr(versions.Commit, "publish", late)
    job.apply_changes(spark, root, batch_of(spark), "mine", C.FIXTURE)
    assert set(versions.latest(spark, root).batches) == {"other", "mine"}
    assert lake.read(spark, "silver", "silver_employees").count() == rows + 2


def test_same_day_hires_by_seconds(spark):
    """Hire and term on one busy day, in one second or in several, against the definition."""
    base, micro = D(2020, 5, 4), dt.timedelta(microseconds=1)
    times = [base, base + dt.timedelta(hours=3), base + dt.timedelta(hours=3, microseconds=5), base + dt.timedelta(hours=3, seconds=7), base + dt.timedelta(hours=9)]
    ends = sorted({t + k * micro for t in times for k in (-1, 0, 1, 3)} | {base + dt.timedelta(hours=5)})
    ends = [e for e in ends if e.date() == base.date()]
    emp = [(n, a, b) for n, (a, b) in enumerate((a, b) for a in ends for b in ends)]
    emp_df = spark.createDataFrame(emp, "client_employee_id long, hire_date timestamp_ntz, term_date timestamp_ntz")
    ts = spark.createDataFrame([(t,) for t in times] * 2 + [(D(2021, 1, 1),)], "punch_apply_date timestamp_ntz")
    got = {str(r.month): r.active_headcount for r in headcount_by_month(ts, emp_df).collect()}
    assert got == {"2020-05-01": sum(any(a <= t < b for t in times) for _, a, b in emp), "2021-01-01": 0}


def test_headcount_with_distant_dates_ends_soon(spark):
    emp = spark.createDataFrame([(1, D(1690, 1, 1), None), (2, D(2000, 1, 1), D(2100, 1, 1))], "client_employee_id long, hire_date timestamp_ntz, term_date timestamp_ntz")
    ts = spark.createDataFrame([(D(1700, 5, 1),), (D(2001, 5, 1),), (D(2200, 5, 1),), (None,)], "punch_apply_date timestamp_ntz")
    start = time.time()
    got = {str(r.month): r.active_headcount for r in headcount_by_month(ts, emp).collect()}
    assert got == {"1700-05-01": 1, "2001-05-01": 2, "2200-05-01": 1, "None": 0}
    assert time.time() - start < 60


def test_rolling_top_leaves_out_null_dated_rows(spark):
    rows = spark.range(20_000).select(
        F.lit(1).cast("long").alias("client_employee_id"), F.lit(None).cast("timestamp_ntz").alias("punch_apply_date"),
        F.lit(None).cast("timestamp_ntz").alias("punch_in_datetime"), F.struct((F.col("id") + 1000).alias("k")).alias(INGEST_COL), F.lit(8.0).alias("hours_worked"),
    )
    dated = spark.createDataFrame(
        [(1 + k % 2, D(2001, 1, 1) + dt.timedelta(days=k), D(2001, 1, 1, 9) + dt.timedelta(days=k), (k,), float(k)) for k in range(200)], rows.schema)
    ts = rows.unionByName(dated)
    for limit in (10, 150, 210):
        got = rolling_top(ts, limit).collect()
        full = rolling_all(ts, digits=2).orderBy(F.col("punch_apply_date").desc_nulls_last(), "client_employee_id", F.col("punch_in_datetime").asc_nulls_last(), INGEST_COL).limit(limit)
        assert sorted(map(str, got)) == sorted(map(str, full.collect()))


def test_a_date_range_opens_only_the_files_that_overlap(spark, tmp_path):
    from shiftlake.plans import catalog as C
    from shiftlake.plans import serving as SV
    from shiftlake.sources import lake as L

    lake, sf = L.Lake(str(tmp_path)), "/root/testdata/sf0.01"
    plain = C.silver_timesheets_plan(spark, sf)
    L.write_silver(spark, lake, C.silver_employees_plan(spark, "/root/testdata/sf0.001"), plain, clustered=True)
    start, end = D(1996, 1, 1), D(1996, 6, 30)
    rows = L.read_timesheets_between(spark, lake, start, end)
    index = {r.file: r for r in lake.read(spark, "silver", "silver_timesheets_files").collect()}
    opened = set(rows.inputFiles())
    named = {f for f, r in index.items() if r.first_date is not None and r.last_date >= start and r.first_date <= end}
    assert {p.split("/")[-1] for p in opened} == {p.split("/")[-1] for p in named} and 0 < len(opened) < len(index) // 2
    want = SV.timesheets(plain, start_date="1996-01-01", end_date="1996-06-30", limit=10**6)
    got = SV.timesheets(rows, start_date="1996-01-01", end_date="1996-06-30", limit=10**6)
    assert sorted(map(str, got.select(*C.TS_RAW_COLS).collect())) == sorted(map(str, want.select(*C.TS_RAW_COLS).collect()))
    assert L.read_timesheets_between(spark, lake, D(2050, 1, 1)).count() == 0
    assert L.read_timesheets_between(spark, lake).count() == sum(r.rows for r in index.values())
    L.write_silver(spark, lake, lake.read(spark, "silver", "silver_employees"), plain)
    assert len(L.read_timesheets_between(spark, lake, start, end).inputFiles()) == len(L.read_silver_timesheets(spark, lake).inputFiles())
