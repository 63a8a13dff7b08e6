"""Dates by the column's own format, against pandas; what coercion loses is counted."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from shiftlake.functions.dates import infer_format
from shiftlake.operators import silver as S
from shiftlake.params import LENIENT_TS_FORMATS, Params

COLUMNS = [
    ["15/01/2024", "16/02/2024", "01/13/2024", "2024-01-15", "3/4/2024"],
    ["01/15/2024", "1/5/2024", "15/01/2024", "01/15/2024 10:00"],
    ["15-Jan-2024", "1-feb-2024", "15-Janu-2024", "15 Jan 2024"],
    ["20240115", "20241301", "2024-01-15"],
    ["01/15/2024 09:00 AM", "1/5/2024 12:30 PM", "01/15/2024 13:00 PM", "01/15/2024 09:00"],
    ["2024-01-15", "01/15/2024", "2024-01-16", "2024-01-17 10:00:00"],
    ["2024-01-15 08:30:00", "2024-01-15", "2024-02-30 08:30:00", "2024-01-15 08:61:00"],
    ["2024-01-15T08:30:00.250", "2024-01-15T08:30:00.5"],
    ["Jan 15, 2024", "February 1, 2024", "Feb 1, 2024"],
    ["15 January 2024", "1 February 2024", "1 Feb 2024"],
    ["15.01.2024", "1.2.2024", "15/01/2024"],
    ["01.02.2024", "15.01.2024"],
    [None, None, "2024/1/5", "2024/01/06"],
    ["2024-01-15", "2024-1-5"],
    ["junk", "2024-01-15", "15-Jan-2024"],
]


@pytest.mark.parametrize("texts", COLUMNS, ids=lambda c: str(c[0]))
def test_columns_read_as_pandas_reads_them(spark, texts):
    rows = [(k, t, (k,)) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "client_employee_id long, hire_date string, _ingest struct<k:long>").repartition(3)
    got = [r.hire_date for r in S.coerce_employee_dates(df, Params()).orderBy("client_employee_id").collect()]
    with pd.option_context("mode.chained_assignment", None):
        import warnings

        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            want = [None if pd.isna(v) else v.to_pydatetime() for v in pd.to_datetime(pd.Series(texts, dtype=object), errors="coerce")]
    assert got == want


def test_offsets_become_utc(spark):
    texts = ["2024-01-15T08:30:00+02:00", "2024-01-15T08:30:00-01:30", "2024-01-15T08:30:00"]
    df = spark.createDataFrame([(k, t, (k,)) for k, t in enumerate(texts)], "client_employee_id long, hire_date string, _ingest struct<k:long>")
    got = [r.hire_date for r in S.coerce_employee_dates(df, Params()).orderBy("client_employee_id").collect()]
    assert got == [dt.datetime(2024, 1, 15, 6, 30), dt.datetime(2024, 1, 15, 10, 0), None]


def test_infer_format():
    assert infer_format("2024-01-15T08:30:00Z") == "yyyy-M-d'T'H:mm:ss'Z'"
    assert infer_format("13/01/2024") == "d/M/yyyy" and infer_format("May 5, 2024") == "MMMM d, yyyy"
    assert infer_format("soon") is None and infer_format(None) is None


def test_declared_formats_are_tried_value_by_value(spark):
    df = spark.createDataFrame([(1, "2024-01-15", (1,)), (2, "1/16/2024", (2,))], "client_employee_id long, hire_date string, _ingest struct<k:long>")
    got = S.coerce_employee_dates(df, Params(ts_formats=LENIENT_TS_FORMATS)).orderBy("client_employee_id").collect()
    assert [r.hire_date for r in got] == [dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 16)]


def test_lost_values_are_counted_while_silver_is_written(spark, tmp_path):
    rows = [(1, "15/01/2024", None, (1,)), (2, "2024-01-15", "x", (2,)), (3, None, None, (3,)), (4, "16/01/2024", "17/01/2024", (4,))]
    df = spark.createDataFrame(rows, "client_employee_id long, hire_date string, term_date string, _ingest struct<k:long>")
    seen = Observation()
    out = S.transform_employees(df, Params(), seen)
    assert out.columns == ["client_employee_id", "hire_date", "term_date", "_ingest", "is_active", "tenure_days"]
    out.write.parquet(str(tmp_path / "silver"))
    assert seen.get == {"rows": 4, "lost_hire_date": 1, "lost_term_date": 1}


def test_job_reports_lost_values_and_rejects(spark, tmp_path):
    from shiftlake.plans.job import run
    from shiftlake.sources.lake import Lake

    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "employee.csv").write_text("client_employee_id|first_name|last_name|department_name|hire_date|term_date\n1|A|B|X|15/01/2020|\n2|A|B|X|2020-01-15|\n")
    head = "client_employee_id|punch_apply_date|punch_in_datetime|punch_out_datetime|scheduled_start_datetime|scheduled_end_datetime|hours_worked"
    day = "2020-02-03|2020-02-03 09:00:00|2020-02-03 17:00:00|2020-02-03 09:00:00|2020-02-03 17:00:00"
    (raw / "timesheet.csv").write_text(f"{head}\n1|{day}|8\n2|{day}|eight\n3|{day}|8|extra|x\n")
    with pytest.raises(ValueError, match="timesheet.csv"):
        run(spark, str(raw), str(tmp_path / "lake"))
    lake = Lake(str(tmp_path / "lake"))
    assert lake.read(spark, "bronze", "rejected_rows").first().record == f"3|{day}|8|extra|x"
    report = run(spark, str(raw), str(tmp_path / "lake"), Params(allow_rejects=True))
    assert not report["failures"]
    quality = report["quality"]
    assert quality["bronze_timesheets", "rejected_rows"] == 1 and quality["bronze_employees", "rejected_rows"] == 0
    assert quality["silver_employees", "lost_hire_date"] == 1 and quality["silver_timesheets", "lost_hours_worked"] == 1
    assert quality["silver_timesheets", "rows"] == 2 and quality["silver_timesheets", "lost_punch_apply_date"] == 0
    assert lake.read(spark, "silver", "silver_employees").where(F.col("hire_date") == dt.datetime(2020, 1, 15)).count() == 1
