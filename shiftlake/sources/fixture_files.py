"""The fixture written as raw pipe-delimited files, for the file-source queries.

Written by Spark under the shared checkpoint folder:

  employee.csv/         all fixture employees
  timesheet_1.csv/      order years up to 1996, standard column order
  timesheet_2.csv/      order years 1997-1998, columns in reverse order
  timesheet_3.csv/      order years from 1999, plus the pass-through columns
                        ``shift_label`` (weekday of the scheduled start) and
                        ``shift_note`` (for punches without an end, quoted text
                        with line breaks, separators and quotes)
  timesheet_4.csv/      rejects only: one row for each supplier, with text two to
                        eleven cells beyond the header

Each folder is range-partitioned and sorted on the fixture ingest order, so
path order followed by row order is that ingest order.
"""

from __future__ import annotations

import threading

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftlake.params import CSV_QUOTE, CSV_SEP, INGEST_COL
from shiftlake.session import scratch_path
from shiftlake.sources import fixtures as FX

TS_COLS = [
    "client_employee_id", "punch_apply_date", "punch_in_datetime", "punch_out_datetime",
    "scheduled_start_datetime", "scheduled_end_datetime", "hours_worked",
]
EMP_COLS = ["client_employee_id", "first_name", "last_name", "department_name", "hire_date", "term_date"]

_written: dict[tuple[int, str], str] = {}
_LOCK = threading.Lock()


def _dealt(df: DataFrame, *order: str) -> DataFrame:
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def _write(df: DataFrame, cols: list[str], path: str) -> None:
    (
        df.select(*cols)
        .write.mode("overwrite")
        .option("sep", CSV_SEP)
        .option("quote", CSV_QUOTE)
        .option("escape", CSV_QUOTE)
        .option("header", True)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )


def write_raw(spark: SparkSession, sf_dir: str) -> str:
    """Write (once per session and input folder) and return the raw folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _LOCK:
        if key not in _written:
            _written[key] = _write_all(spark, sf_dir)
        return _written[key]


def _write_all(spark: SparkSession, sf_dir: str) -> str:
    raw = scratch_path(spark, "raw")
    _write(_dealt(FX.employees_raw(spark, sf_dir), INGEST_COL), EMP_COLS, f"{raw}/employee.csv")
    year = F.year("scheduled_start_datetime")
    number = F.when(year <= 1996, 1).when(year <= 1998, 2).when(year >= 1999, 3).alias("number")
    ts = FX.timesheets_raw(spark, sf_dir).select(*TS_COLS, INGEST_COL, number).where("number is not null")
    # joined, dealt out and sorted once for the three of them
    dealt = _dealt(ts, "number", INGEST_COL).drop(INGEST_COL).persist(StorageLevel.DISK_ONLY)
    try:
        _write(dealt.where("number = 1"), TS_COLS, f"{raw}/timesheet_1.csv")
        _write(dealt.where("number = 2"), list(reversed(TS_COLS)), f"{raw}/timesheet_2.csv")
        note = F.concat(F.lit('line one of "'), F.col("client_employee_id").cast("string"), F.lit('"\nline|two\n\nlast'))
        late = dealt.where("number = 3").withColumn("shift_label", F.date_format("scheduled_start_datetime", "EEE"))
        late = late.withColumn("shift_note", F.when(F.col("punch_out_datetime").isNull(), note))
        _write(late, TS_COLS + ["shift_label", "shift_note"], f"{raw}/timesheet_3.csv")
    finally:
        dealt.unpersist()
    _write_surplus(FX.table(spark, sf_dir, "supplier"), f"{raw}/timesheet_4.csv")
    return raw


def _write_surplus(supplier: DataFrame, path: str) -> None:
    """Rows with surplus text as plain lines, the header first in each file."""
    gap = F.repeat(F.lit(CSV_SEP), (F.col("s_suppkey") % 10 + 2).cast("int"))
    row = F.concat(F.col("s_suppkey").cast("string"), F.repeat(F.lit(CSV_SEP), F.lit(len(TS_COLS) - 1)), gap, F.col("s_name"))
    # one column, whose name is the header; its separator occurs in no cell
    supplier.select(row.alias(CSV_SEP.join(TS_COLS))).write.mode("overwrite").option("header", True).option("sep", "\x01").csv(path)
