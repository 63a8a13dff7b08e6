"""Hand-written cases for the traps of the cleaning and KPI rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shiftlake.functions.exprs import coerce_timestamp
from shiftlake.operators import silver as S
from shiftlake.params import EARLY_ATTRITION_LABEL, LENIENT_TS_FORMATS, OTHER_ATTRITION_LABEL
from shiftlake.plans import gold as G
from shiftlake.plans.job import run
from shiftlake.sources import raw_csv
from shiftlake.sources.lake import Lake

EMP_HEADER = "client_employee_id|first_name|last_name|department_name|hire_date|term_date|dob"
TS_HEADER = (
    "client_employee_id|punch_apply_date|punch_in_datetime|punch_out_datetime|"
    "scheduled_start_datetime|scheduled_end_datetime|hours_worked"
)


def write(path, lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def ts_line(emp, day, late_min=0, early_min=0, hours="8"):
    d = dt.datetime.fromisoformat(day)
    start, end = d + dt.timedelta(hours=9), d + dt.timedelta(hours=17)
    pin = start + dt.timedelta(minutes=late_min)
    pout = end - dt.timedelta(minutes=early_min)
    f = "%Y-%m-%d %H:%M:%S"
    return f"{emp}|{day}|{pin.strftime(f)}|{pout.strftime(f)}|{start.strftime(f)}|{end.strftime(f)}|{hours}"


def test_keep_first_and_null_ids(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    write(raw / "employee.csv", [
        EMP_HEADER,
        "1|Ann|A|Sales|2020-01-01||",
        "1|Ann|B|Ops|2020-02-01||",
        "|X|Y|Sales|2020-01-01||",
        "|Z|W|Sales|2020-01-01||",
    ])
    emp = S.transform_employees(raw_csv.extract_employees(spark, str(raw)))
    rows = {(r.client_employee_id, r.last_name) for r in emp.collect()}
    assert rows == {("1", "A"), (None, "Y")}


def test_null_tokens_and_strip(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    write(raw / "employee.csv", [
        EMP_HEADER,
        '1| NA |NA|   |2020-01-01||',
        '2|\tBob |N/A|Ops|2020-01-01||',
    ])
    emp = raw_csv.extract_employees(spark, str(raw)).orderBy("client_employee_id").collect()
    assert emp[0].first_name == "NA"          # padded token is text, then stripped
    assert emp[0].last_name is None           # exact token is missing
    assert emp[0].department_name == ""       # blank-only cell strips to empty text
    assert emp[1].first_name == "Bob"         # tab and no-break space removed
    assert emp[1].last_name is None


def test_bad_and_out_of_range_dates_mean_active(spark):
    df = spark.createDataFrame(
        [("1", "2020-01-01", "9999-12-31", 1), ("2", "2020-01-01", "not-a-date", 2), ("3", "2020-01-01", "2021-01-01", 3)],
        "client_employee_id string, hire_date string, term_date string, k long",
    ).withColumn("_ingest", F.struct("k")).drop("k")
    out = {r.client_employee_id: r for r in S.transform_employees(df).collect()}
    assert out["1"].term_date is None and out["1"].is_active == 1
    assert out["2"].term_date is None and out["2"].is_active == 1
    assert out["3"].is_active == 0 and out["3"].tenure_days == 366


def test_tenure_floors_toward_minus_infinity(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(2020, 1, 2, 0, 0), dt.datetime(2020, 1, 1, 18, 0))],
        "client_employee_id long, hire_date timestamp_ntz, term_date timestamp_ntz",
    ).withColumn("_ingest", F.struct("client_employee_id"))
    assert S.transform_employees(df).first().tenure_days == -1


def test_union_by_name_across_headers(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    write(raw / "timesheet_a.csv", [TS_HEADER, ts_line(1, "2020-01-06")])
    cols = TS_HEADER.split("|")
    reordered = list(reversed(cols[:-1]))  # no hours_worked, reversed order
    line = ts_line(2, "2020-01-07").split("|")[:-1]
    write(raw / "timesheet_b.csv", ["|".join(reordered), "|".join(reversed(line))])
    ts = raw_csv.extract_timesheets(spark, str(raw)).orderBy("client_employee_id").collect()
    assert [r.client_employee_id for r in ts] == ["1", "2"]
    assert ts[1].punch_apply_date == "2020-01-07" and ts[1].hours_worked is None


def test_grace_and_hour_boundaries(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    write(raw / "timesheet.csv", [
        TS_HEADER,
        ts_line(1, "2020-01-06", late_min=5, early_min=6, hours="7.5"),
        ts_line(2, "2020-01-06", late_min=6, early_min=5, hours="8.5"),
        ts_line(3, "2020-01-06", hours="8.51"),
        ts_line(4, "2020-01-06", hours=""),
    ])
    ts = S.transform_timesheets(raw_csv.extract_timesheets(spark, str(raw)).withColumn(
        "client_employee_id", F.col("client_employee_id").cast("bigint")))
    r = {x.client_employee_id: x for x in ts.collect()}
    assert (r[1].is_late, r[1].is_early) == (0, 1)
    assert (r[2].is_late, r[2].is_early) == (1, 0)
    assert [(r[i].is_normal_work, r[i].is_overtime) for i in (1, 2, 3, 4)] == [(1, 0), (1, 0), (0, 1), (0, 0)]


def _emp(spark, rows):
    return spark.createDataFrame(rows, "client_employee_id long, hire_date timestamp_ntz, term_date timestamp_ntz")


def _ts(spark, dates):
    return spark.createDataFrame([(d,) for d in dates], "punch_apply_date timestamp_ntz")


def test_headcount_zero_months_and_null_month(spark):
    d = dt.datetime
    emp = _emp(spark, [(1, d(2020, 3, 1), None)])
    ts = _ts(spark, [d(2020, 1, 15), d(2020, 3, 2), None])
    out = {r.month: r.active_headcount for r in G.active_headcount(emp, ts).collect()}
    assert out == {dt.date(2020, 1, 1): 0, dt.date(2020, 3, 1): 1, None: 0}


def test_headcount_no_employees_gives_no_rows(spark):
    emp = _emp(spark, [])
    ts = _ts(spark, [dt.datetime(2020, 1, 15)])
    assert G.active_headcount(emp, ts).count() == 0


def test_headcount_same_day_hire_and_termination(spark):
    d = dt.datetime
    # the day holds several distinct apply times, so the within-day check runs
    ts = _ts(spark, [d(2020, 5, 4, 8), d(2020, 5, 4, 12), d(2020, 6, 1)])
    emp = _emp(spark, [
        (1, d(2020, 5, 4, 9), d(2020, 5, 4, 13)),   # 12:00 inside -> May
        (2, d(2020, 5, 4, 9), d(2020, 5, 4, 11)),   # nothing inside
        (3, d(2020, 5, 4, 12), d(2020, 5, 4, 12, 1)),  # hire equal to a time counts
    ])
    out = {r.month: r.active_headcount for r in G.active_headcount(emp, ts).collect()}
    assert out == {dt.date(2020, 5, 1): 2, dt.date(2020, 6, 1): 0}


def test_no_terminations_two_zero_rows(spark):
    emp = _emp(spark, [(1, dt.datetime(2020, 1, 1), None)])
    rows = {r.attrition_type: r["count"] for r in G.early_attrition(emp).collect()}
    assert rows == {EARLY_ATTRITION_LABEL: 0, OTHER_ATTRITION_LABEL: 0}


def test_exactly_ninety_days_is_other(spark):
    d = dt.datetime
    emp = _emp(spark, [(1, d(2020, 1, 1), d(2020, 1, 1) + dt.timedelta(days=90)),
                       (2, d(2020, 1, 1), d(2020, 1, 1) + dt.timedelta(days=89, hours=23))])
    rows = {r.attrition_type: r["count"] for r in G.early_attrition(emp).collect()}
    assert rows == {EARLY_ATTRITION_LABEL: 1, OTHER_ATTRITION_LABEL: 1}


def test_job_runs_and_reruns(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    write(raw / "employee_2024.csv", [EMP_HEADER, "1|A|B|Sales|2020-01-01||", "2|C|D||2020-01-01|2020-02-01|"])
    write(raw / "timesheet_1.csv", [TS_HEADER] + [ts_line(1, f"2020-01-{d:02d}", late_min=d % 9) for d in range(6, 20)])
    write(raw / "timesheet_2.csv", [TS_HEADER] + [ts_line(2, f"2020-01-{d:02d}", hours="9") for d in range(6, 20)])
    lake = str(tmp_path / "lake")
    first = run(spark, str(raw), lake)
    assert not first["failures"]
    assert first["quality"][("silver_timesheets", "rows")] == 28
    assert set(first["gold_rows"]) == set(G.KPI_NAMES)
    def snapshot():
        return {n: sorted(map(repr, Lake(lake).read(spark, "gold", n).collect())) for n in G.KPI_NAMES}

    before = snapshot()
    second = run(spark, str(raw), lake)
    assert second["gold_rows"] == first["gold_rows"]
    assert snapshot() == before  # a rerun gives the same results
    hc = Lake(lake).read(spark, "gold", "kpi_active_headcount").collect()
    assert [(r.month, r.active_headcount) for r in hc] == [(dt.date(2020, 1, 1), 2)]


def test_reads_by_id_and_optional_filters(spark):
    from shiftlake.plans import serving as SV

    d = dt.datetime
    ts = spark.createDataFrame(
        [(1, d(2020, 1, 6), d(2020, 1, 6, 9), k) for k in range(3)]
        + [(2, d(2020, 1, 7, 0), d(2020, 1, 7, 9), 9), (2, d(2020, 1, 8, 12), d(2020, 1, 8, 9), 10)],
        "client_employee_id long, punch_apply_date timestamp_ntz, punch_in_datetime timestamp_ntz, k long",
    ).withColumn("_ingest", F.struct("k")).drop("k")
    assert SV.timesheets(ts, client_employee_id="2").count() == 2
    assert SV.timesheets(ts, client_employee_id="", start_date="", end_date="").count() == 5
    # the end date compares as midnight: a punch later that day drops out
    assert SV.timesheets(ts, end_date="2020-01-08").count() == 4
    assert SV.timesheets(ts, client_employee_id="abc").count() == 0   # bad id finds nothing
    emp = spark.createDataFrame([(1, "A"), (2, "B")], "client_employee_id long, first_name string")
    assert SV.employee(emp, "2").first().first_name == "B"
    assert SV.employee(emp, "3").count() == 0


def test_batch_changes(spark):
    from shiftlake.operators import changes as CG
    from shiftlake.operators.changes import CHANGE_SCHEMA

    d = dt.datetime
    silver = spark.createDataFrame(
        [(1, "A", "a", "Ops", d(2020, 1, 1), None, 1, 100), (2, "B", "b", "Ops", d(2020, 1, 1), None, 1, 100)],
        "client_employee_id long, first_name string, last_name string, department_name string, "
        "hire_date timestamp_ntz, term_date timestamp_ntz, is_active long, tenure_days long",
    )
    changes = spark.createDataFrame([
        ("insert", 1, "A2", "dup", "HR", d(2021, 1, 1), 1),      # duplicate id allowed
        ("update", 2, None, None, "Sales", None, 1),
        ("delete", 2, None, None, None, None, 2),                 # later delete wins in a batch
        ("update", 1, None, None, None, None, 0),                 # empty update: rejected
        ("delete", 9, None, None, None, None, 3),                 # unknown id: rejected
    ], CHANGE_SCHEMA)
    ins = CG.insert(silver, changes)
    assert ins.where("client_employee_id = 1").count() == 2
    new = ins.where("last_name = 'dup'").first()
    assert new.is_active == 1 and new.term_date is None and new.tenure_days is not None
    assert CG.update(silver, changes).where("client_employee_id = 2").first().department_name == "Sales"
    assert CG.delete(silver, changes).count() == 1
    rej = {(r.client_employee_id, r.reason) for r in CG.rejects(silver, changes).collect()}
    assert rej == {(1, "no fields to update"), (9, "not found")}
    applied = CG.apply(silver, changes)
    # per id the last change applies: id 1 -> insert (seq 1 beats the empty update), id 2 -> delete
    assert sorted((r.client_employee_id, r.last_name) for r in applied.collect()) == [(1, "a"), (1, "dup")]


def test_attrition_classes_add_up(spark):
    import __spark_entry__ as E
    from shiftlake.plans import catalog as C

    emp = C.silver_employees(spark, "/root/testdata/sf0.001")
    split = {r.attrition_type: r["count"] for r in G.early_attrition(emp).collect()}
    known = emp.where("term_date IS NOT NULL AND hire_date IS NOT NULL").count()
    assert sum(split.values()) == known
    assert E.queries()["kpi_early_attrition"](spark, "/root/testdata/sf0.001").count() == 2


def test_one_failing_kpi_does_not_stop_the_others(spark, tmp_path, monkeypatch):
    raw = tmp_path / "raw"
    raw.mkdir()
    write(raw / "employee.csv", [EMP_HEADER, "1|A|B|Sales|2020-01-01||"])
    write(raw / "timesheet.csv", [TS_HEADER] + [ts_line(1, f"2020-01-{d:02d}") for d in range(6, 12)])

    def broken(*args, **kwargs):
        raise RuntimeError("boom")

    monkeypatch.setattr(G, "rolling_avg", broken)
    report = run(spark, str(raw), str(tmp_path / "lake"))
    assert set(report["failures"]) == {"kpi_rolling_avg"} and "boom" in report["failures"]["kpi_rolling_avg"]
    assert set(report["gold_rows"]) == set(G.KPI_NAMES) - {"kpi_rolling_avg"}


def test_quoted_cells(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    write(raw / "employee.csv", [
        EMP_HEADER,
        '1|"Ann|Marie"|"O""Neil"|"Sales"|2020-01-01||',
        '2|""|" NA "|Ops|2020-01-01||',
    ])
    rows = {r.client_employee_id: r for r in raw_csv.extract_employees(spark, str(raw)).collect()}
    assert rows["1"].first_name == "Ann|Marie" and rows["1"].last_name == 'O"Neil'
    assert rows["2"].first_name is None          # quoted empty cell is missing
    assert rows["2"].last_name == "NA"           # quoted padded token stays text, then stripped


def test_quoted_line_breaks_and_short_rows(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "employee.csv").write_text(
        'client_employee_id|first_name|last_name|department_name|hire_date|term_date\n'
        '1|"An\nn"|A|Sales|2020-01-01|\n'
        '2|Bo|"B|b"|Sales\n'
        '3|Cy|"C\n\n""c"""||2020-01-02|2020-02-01\n'
    )
    rows = {r.client_employee_id: r for r in raw_csv.extract_employees(spark, str(raw)).collect()}
    assert sorted(rows) == ["1", "2", "3"]
    assert rows["1"].first_name == "An\nn" and rows["1"].term_date is None
    assert rows["2"].last_name == "B|b" and rows["2"].hire_date is None
    assert rows["3"].last_name == 'C\n\n"c"' and rows["3"].department_name is None


@pytest.mark.parametrize("surplus", ["x", "x|y", "||y"])
def test_surplus_cells_fail_the_read(spark, tmp_path, surplus):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "timesheet_1.csv").write_text(f"client_employee_id|hours_worked\n1|8\n2|7|{surplus}\n")
    with pytest.raises(Exception, match="more cells than the header"):
        raw_csv.extract_timesheets(spark, str(raw)).collect()


def test_date_texts(spark):
    texts = ["2020-03-04", "2020-03-04T05:06", "2020-03-04 05:06:07.123456789", "2020-03-04T05:06:07Z",
             "03/04/2020", "3/4/2020 5:06", "13/04/2020", "not-a-date", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.v for r in df.select("i", coerce_timestamp("t", df.schema["t"].dataType, LENIENT_TS_FORMATS).cast("string").alias("v")).orderBy("i").collect()]
    day = "2020-03-04"
    assert got == [f"{day} 00:00:00", f"{day} 05:06:00", f"{day} 05:06:07.123456", f"{day} 05:06:07",
                   f"{day} 00:00:00", f"{day} 05:06:00", None, None, None]
