"""The batch job: raw files -> bronze -> silver -> quality -> gold.

Each layer is written as new table versions that one commit makes current, and
the next one reads the written tables, so every
layer can be rerun alone and a lost executor only repeats tasks of the
current stage. Independent writes of one layer are submitted as concurrent
jobs. Gold KPIs fail one at a time: an error is recorded in the report and
the other KPIs still run.
"""

from __future__ import annotations

import hashlib
import logging
import traceback
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shiftlake.operators.changes import apply, rejects
from shiftlake.operators.headcount import apply_times
from shiftlake.operators.silver import transform_employees, transform_timesheets
from shiftlake.params import DEFAULT, EMPLOYEE_KEY, Params
from shiftlake.plans import gold as G
from shiftlake.plans.quality import loss_counts, reject_counts, row_counts
from shiftlake.session import configure
from shiftlake.sources.lake import Lake, read_silver_timesheets, replace_table, row_count, write_silver
from shiftlake.sources.raw_csv import accepted, extract_employees, extract_timesheets, load_bronze, rejected
from shiftlake.sources.versions import Commit, Conflict, vacuum

log = logging.getLogger(__name__)

GOLD_CONCURRENCY = 4  # KPI jobs submitted at once


def ids_are_integers(*frames: DataFrame) -> bool:
    """True when every non-null employee id in all frames reads as an integer
    (one aggregate over the id columns, like a type inference pass)."""
    ids = None
    for df in frames:
        one = df.select(F.col(EMPLOYEE_KEY).cast("string").alias("id"))
        ids = one if ids is None else ids.unionByName(one)
    bad = ids.select(F.count_if(F.col("id").isNotNull() & F.col("id").try_cast("bigint").isNull())).first()[0]
    return not bad


def type_ids(df: DataFrame, integer: bool) -> DataFrame:
    if integer and dict(df.dtypes).get(EMPLOYEE_KEY) == "string":
        return df.withColumn(EMPLOYEE_KEY, F.col(EMPLOYEE_KEY).try_cast("bigint"))
    return df


def build_silver(spark: SparkSession, lake: Lake, params: Params = DEFAULT, lost: dict | None = None) -> dict[str, str]:
    """Silver from the written bronze tables, without their rejects.

    ``lost`` gets, by table, how many values of each typed column couldn't be
    read; they are counted while silver is written.
    """
    b_emp = accepted(lake.read(spark, "bronze", "bronze_employees"))
    b_ts = accepted(lake.read(spark, "bronze", "bronze_timesheets"))
    integer = ids_are_integers(b_emp, b_ts)
    seen = {name: Observation() for name in ("silver_employees", "silver_timesheets")}
    s_emp = transform_employees(type_ids(b_emp, integer), params, seen["silver_employees"])
    s_ts = transform_timesheets(type_ids(b_ts, integer), params, seen["silver_timesheets"])
    paths = write_silver(spark, lake, s_emp, s_ts, params.cluster_by_date)
    if lost is not None:
        lost |= {name: o.get for name, o in seen.items()}
    return paths


def write_rejects(spark: SparkSession, lake: Lake) -> DataFrame:
    """``bronze/rejected_rows``: (table_name, file, record) of the raw rows with more cells than their header.

    They were found when bronze was written; the null statistics of their column
    let this read skip all other row groups.
    """
    found = [
        rejected(lake.read(spark, "bronze", name)).select(F.lit(name).alias("table_name"), "file", "record")
        for name in ("bronze_employees", "bronze_timesheets")
    ]
    return spark.read.parquet(replace_table(found[0].unionByName(found[1]), lake, "bronze", "rejected_rows"))


#: The distinct observed apply times, all the headcount needs of the timesheets.
APPLY_TIMES = "gold/apply_times"


def _employee_builders(emp: DataFrame, times: DataFrame, params: Params) -> dict:
    """KPI name -> function building its DataFrame, of those that depend on employees (G1 writes its small
    checkpoints when built, so building happens inside the KPI's own task)."""
    return {
        "kpi_active_headcount": lambda: G.active_headcount(emp, times, params),
        "kpi_turnover_trend": lambda: G.turnover_trend(emp, params),
        "kpi_avg_tenure": lambda: G.avg_tenure(emp, params),
        "kpi_early_attrition": lambda: G.early_attrition(emp, params),
    }


def _builders(emp: DataFrame, ts: DataFrame, times: DataFrame, params: Params, per_employee: DataFrame) -> dict:
    """All KPIs; the three top reports share one pass over the timesheets."""
    shared = {
        "kpi_late_arrivals": ("late_count", "avg_minutes_late", params.limit_late),
        "kpi_early_departures": ("early_count", "avg_minutes_early", params.limit_early),
        "kpi_overtime": ("overtime_days", "total_extra_hours", params.limit_overtime),
    }
    out = _employee_builders(emp, times, params) | {
        "kpi_avg_working_hours": lambda: G.avg_working_hours(ts, params),
        "kpi_rolling_avg": lambda: G.rolling_avg(ts, params),
    }
    for name, (count_col, value_col, limit) in shared.items():
        out[name] = lambda c=count_col, v=value_col, n=limit: G.top_by(per_employee, c, v, n)
    return out


def _write_kpis(commit: Commit, builders: dict, concurrency: int) -> tuple[dict[str, int], dict[str, str]]:
    """Write the next version of each KPI. One that fails has no current version after the commit, so no old
    table passes for a new one."""

    def one(name: str):
        try:
            n = row_count(commit.spark, commit.write(f"gold/{name}", builders[name]()))
            log.info("%s: %d rows", name, n)
            return name, n, None
        except Exception as exc:  # one KPI failing does not stop the others
            msg = "".join(traceback.format_exception_only(type(exc), exc)).strip()
            log.warning("%s: %s", name, msg)
            commit.drop(f"gold/{name}")
            return name, None, msg

    rows, failures = {}, {}
    with ThreadPoolExecutor(max_workers=max(1, concurrency)) as pool:
        for name, n, err in pool.map(one, builders):
            if err is None:
                rows[name] = n
            else:
                failures[name] = err
    return rows, failures


def build_gold(
    spark: SparkSession, lake: Lake, params: Params = DEFAULT, concurrency: int = GOLD_CONCURRENCY
) -> tuple[dict[str, int], dict[str, str]]:
    """All KPI tables from the written silver tables, made current together.

    The nine KPIs are independent jobs; they are submitted side by side so
    small ones fill the cores a large one leaves idle. A failure is recorded
    for its KPI and the others still run. The observed apply times are kept as a table of
    their own (``gold/apply_times``), from which a change batch refreshes the
    headcount without the timesheets.
    """
    commit = lake.commit(spark)
    emp = lake.read(spark, "silver", "silver_employees")
    ts = read_silver_timesheets(spark, lake)
    times = spark.read.parquet(commit.write(APPLY_TIMES, apply_times(ts)))
    per_employee = G.per_employee_flags(ts, params).persist(StorageLevel.MEMORY_AND_DISK)  # recomputed if lost
    try:
        rows, failures = _write_kpis(commit, _builders(emp, ts, times, params, per_employee), concurrency)
    finally:
        per_employee.unpersist()
    commit.publish()
    return rows, failures


def run(spark: SparkSession, raw_dir: str, lake_root: str, params: Params = DEFAULT) -> dict:
    """Run every layer; returns a report (paths, quality counts, gold rows, failures).

    A raw row with more cells than its header ends the run after bronze, unless
    ``params.allow_rejects``; ``bronze/rejected_rows`` holds it in either case.
    """
    configure(spark)
    lake = Lake(lake_root)
    emp = extract_employees(spark, raw_dir, multi_line=params.multi_line, several=params.several_employee_files, keep_rejects=True)
    ts = extract_timesheets(spark, raw_dir, multi_line=params.multi_line, keep_rejects=True)
    bronze = load_bronze(emp, ts, lake)
    rejects_table = write_rejects(spark, lake)
    if not params.allow_rejects and (some := rejects_table.limit(3).collect()):
        raise ValueError(f"rows with more cells than their header in {', '.join(sorted({r.file for r in some}))}: see bronze/rejected_rows")
    lost: dict = {}
    silver = build_silver(spark, lake, params, lost)
    quality = row_counts(
        lake.read(spark, "silver", "silver_employees"), read_silver_timesheets(spark, lake)
    ).unionByName(reject_counts(rejects_table)).unionByName(loss_counts(spark, lost))
    replace_table(quality, lake, "gold", "dq_row_counts")
    dq = {(r.table_name, r.metric): r.value for r in lake.read(spark, "gold", "dq_row_counts").collect()}
    rows, failures = build_gold(spark, lake, params)
    vacuum(spark, lake.base)
    return {"bronze": bronze, "silver": silver, "quality": dq, "gold_rows": rows, "failures": failures}


def apply_changes(
    spark: SparkSession, lake_root: str, changes: DataFrame, batch_id: str, params: Params = DEFAULT, tries: int = 3
) -> dict:
    """Apply a change batch to the silver employees (M4) and refresh the KPIs that depend on employees.

    The new employees, the rejected changes and the KPIs become current in one
    commit that also records ``batch_id``, so a batch that was applied before changes nothing
    and returns its first report. Killed at any step, it can be run again under
    its id: it goes on with the tables it had finished. If another writer commits first, it starts again on
    that writer's version. Timesheets aren't read (``gold/apply_times`` stands for them).
    """
    configure(spark)
    lake = Lake(lake_root)
    label = "b" + hashlib.sha256(batch_id.encode()).hexdigest()[:16]
    for left in reversed(range(tries)):
        commit = lake.commit(spark, label)
        if batch_id in commit.base.batches:
            return commit.base.batches[batch_id]
        emp = lake.read(spark, "silver", "silver_employees")
        rejected_path = commit.write("silver/rejected_changes", rejects(emp, changes))
        new = spark.read.parquet(commit.write("silver/silver_employees", apply(emp, changes, params)))
        if APPLY_TIMES not in commit.base.tables:  # gold was never built
            commit.write(APPLY_TIMES, apply_times(read_silver_timesheets(spark, lake)))
        times = spark.read.parquet(f"{lake.base}/{commit.tables[APPLY_TIMES]}")
        builders = _employee_builders(new, times, params)
        rows, failures = _write_kpis(commit, builders, GOLD_CONCURRENCY)
        report = {"rejected": row_count(spark, rejected_path), "gold_rows": rows, "failures": failures}
        try:
            commit.publish(batch_id, report)
        except Conflict:
            if not left:
                raise
            continue
        vacuum(spark, lake.base)
        return report
