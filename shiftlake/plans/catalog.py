"""Registered queries: each is ``(spark, sf_dir) -> DataFrame`` over the driver tables.

The driver tables are mapped to raw employees and timesheets
(``sources.fixtures``), cleaned to silver in the same plan, and fed to the
operator under test. Output columns carry the same names as the oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import datetime as dt
import functools
import threading

from shiftlake.functions.exprs import null_tokens, strip_all
from shiftlake.operators import changes as CG
from shiftlake.operators import silver as S
from shiftlake.params import INGEST_COL, Params
from shiftlake.plans import charts as CH
from shiftlake.plans import gold as G
from shiftlake.plans import job
from shiftlake.plans import quality as Q
from shiftlake.plans import serving as SV
from shiftlake.plans import variants as V
from shiftlake.session import configure, scratch_path
from shiftlake.sources import fixture_files, raw_csv
from shiftlake.sources import fixtures as FX
from shiftlake.sources.lake import Lake, read_silver_timesheets, write_silver

#: The driver tables end in 2001: tenure runs to the day after.
FIXTURE = Params(as_of=dt.datetime(2002, 1, 1))

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

EMP_COLS = ["client_employee_id", "first_name", "last_name", "department_name", "hire_date", "term_date"]
TS_RAW_COLS = [
    "client_employee_id", "punch_apply_date", "punch_in_datetime", "punch_out_datetime",
    "scheduled_start_datetime", "scheduled_end_datetime", "hours_worked",
]
TS_FLAG_COLS = ["minutes_late", "minutes_early", "is_late", "is_early", "is_overtime", "is_normal_work"]


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


def silver_employees_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver employees computed from the driver tables in the query plan."""
    configure(spark)
    return S.transform_employees(FX.employees_raw(spark, sf_dir), FIXTURE)


def silver_timesheets_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver timesheets computed from the driver tables in the query plan."""
    configure(spark)
    return S.transform_timesheets(FX.timesheets_raw(spark, sf_dir), FIXTURE)


_SILVER: dict = {}
_LOCK = threading.RLock()


def _silver_written(spark: SparkSession, sf_dir: str) -> Lake:
    """The fixture silver written once per session and input folder, as the job
    writes it; the KPI, read, chart, variant and change queries read it, as the
    gold layer reads the written silver layer."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _LOCK:
        if key not in _SILVER:
            lake = Lake(scratch_path(spark, "fixture-lake"))
            write_silver(spark, lake, silver_employees_plan(spark, sf_dir), silver_timesheets_plan(spark, sf_dir))
            _SILVER[key] = lake
        return _SILVER[key]


def silver_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return _silver_written(spark, sf_dir).read(spark, "silver", "silver_employees")


def silver_timesheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return read_silver_timesheets(spark, _silver_written(spark, sf_dir))


# --- silver: employees ----------------------------------------------------------


@register("emp_dedup_first")
def q_emp_dedup_first(spark, sf_dir):
    configure(spark)
    return S.dedup_employees(FX.employees_raw(spark, sf_dir)).select(*EMP_COLS)


@register("emp_coerce_dates")
def q_emp_coerce_dates(spark, sf_dir):
    configure(spark)
    emp = S.dedup_employees(FX.employees_raw(spark, sf_dir))
    return S.coerce_employee_dates(emp, FIXTURE).select(*EMP_COLS)


@register("emp_is_active")
def q_emp_is_active(spark, sf_dir):
    return silver_employees_plan(spark, sf_dir).select("client_employee_id", "is_active")


@register("emp_tenure_days")
def q_emp_tenure_days(spark, sf_dir):
    return silver_employees_plan(spark, sf_dir).select("client_employee_id", "tenure_days")


@register("silver_employees")
def q_silver_employees(spark, sf_dir):
    return S.public_columns(silver_employees_plan(spark, sf_dir))


@register("emp_untidy_cells")
def q_emp_untidy_cells(spark, sf_dir):
    """S3, S4 on cells with blanks and missing tokens."""
    configure(spark)
    rows = FX.employees_untidy(spark, sf_dir)
    return rows.select("client_employee_id", "last_name", strip_all(null_tokens("first_name")).alias("first_name"))


@register("emp_untidy_silver")
def q_emp_untidy_silver(spark, sf_dir):
    """E1-E5 on duplicates and dates that can't all be read."""
    configure(spark)
    return S.transform_employees(FX.employees_untidy(spark, sf_dir), FIXTURE).select(
        "client_employee_id", "last_name", "hire_date", "term_date", "is_active", F.col("tenure_days").cast("double").alias("tenure_days"))


# --- silver: timesheets ---------------------------------------------------------


@register("ts_dedup_first")
def q_ts_dedup_first(spark, sf_dir):
    configure(spark)
    return S.dedup_timesheets(FX.timesheets_raw(spark, sf_dir)).select(*TS_RAW_COLS)


@register("ts_coerce_datetimes")
def q_ts_coerce(spark, sf_dir):
    configure(spark)
    ts = S.dedup_timesheets(FX.timesheets_raw(spark, sf_dir))
    return S.coerce_timesheet_datetimes(ts, FIXTURE).select(*TS_RAW_COLS)


def _flag_query(col: str) -> Query:
    def q(spark, sf_dir):
        return silver_timesheets_plan(spark, sf_dir).select("client_employee_id", "punch_in_datetime", col)

    q.__name__ = f"q_ts_{col}"
    return q


for _c in TS_FLAG_COLS:
    register(f"ts_{_c}")(_flag_query(_c))


@register("silver_timesheets")
def q_silver_timesheets(spark, sf_dir):
    return silver_timesheets_plan(spark, sf_dir).select(*TS_RAW_COLS, *TS_FLAG_COLS)


# --- gold -----------------------------------------------------------------------


def gold(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    emp = silver_employees(spark, sf_dir)
    ts = silver_timesheets(spark, sf_dir)
    builders = {
        "kpi_active_headcount": lambda: G.active_headcount(emp, ts, FIXTURE),
        "kpi_turnover_trend": lambda: G.turnover_trend(emp, FIXTURE),
        "kpi_avg_tenure": lambda: G.avg_tenure(emp, FIXTURE),
        "kpi_avg_working_hours": lambda: G.avg_working_hours(ts, FIXTURE),
        "kpi_late_arrivals": lambda: G.late_arrivals(ts, FIXTURE),
        "kpi_early_departures": lambda: G.early_departures(ts, FIXTURE),
        "kpi_overtime": lambda: G.overtime(ts, FIXTURE),
        "kpi_rolling_avg": lambda: G.rolling_avg(ts, FIXTURE),
        "kpi_early_attrition": lambda: G.early_attrition(emp, FIXTURE),
    }
    return builders[name]()


def _gold_query(name: str) -> Query:
    def q(spark, sf_dir):
        return gold(spark, sf_dir, name)

    q.__name__ = f"q_{name}"
    return q


for _name in G.KPI_NAMES:
    register(_name)(_gold_query(_name))


@register("gold_sink")
def q_gold_sink(spark, sf_dir):
    """All KPIs written in one commit, and counted in the written tables."""
    configure(spark)
    lake = _silver_written(spark, sf_dir)
    job.build_gold(spark, lake, FIXTURE)
    counts = [lake.read(spark, "gold", name).agg(F.count("*").alias("rows")).select(F.lit(name).alias("kpi"), "rows") for name in G.KPI_NAMES]
    return functools.reduce(DataFrame.unionByName, counts)


# --- sources and bronze ------------------------------------------------------------


def _raw(spark, sf_dir):
    configure(spark)
    return fixture_files.write_raw(spark, sf_dir)


@register("src_employees_csv")
def q_src_employees_csv(spark, sf_dir):
    return raw_csv.accepted(raw_csv.extract_employees(spark, _raw(spark, sf_dir), keep_rejects=True)).drop(INGEST_COL)


@register("src_timesheets_csv")
def q_src_timesheets_csv(spark, sf_dir):
    return raw_csv.accepted(raw_csv.extract_timesheets(spark, _raw(spark, sf_dir), keep_rejects=True)).drop(INGEST_COL)


DOC_TEXT_COLS = ("text", "lang", "source")


@register("bronze_trim_strings")
def q_bronze_trim_strings(spark, sf_dir):
    configure(spark)
    docs = FX.table(spark, sf_dir, "documents")
    return docs.select(*[strip_all(c).alias(c) if c in DOC_TEXT_COLS else F.col(c) for c in docs.columns])


@register("bronze_null_tokens")
def q_bronze_null_tokens(spark, sf_dir):
    configure(spark)
    docs = FX.table(spark, sf_dir, "documents")
    return docs.select(*[null_tokens(c).alias(c) if c in DOC_TEXT_COLS else F.col(c) for c in docs.columns])


def _bronze(spark, sf_dir) -> Lake:
    raw = _raw(spark, sf_dir)
    key = ("bronze", spark.sparkContext.applicationId, sf_dir)
    with _LOCK:
        if key not in _LAKES:
            lake = Lake(scratch_path(spark, "lake"))
            emp = raw_csv.extract_employees(spark, raw, keep_rejects=True)
            raw_csv.load_bronze(emp, raw_csv.extract_timesheets(spark, raw, keep_rejects=True), lake)
            _LAKES[key] = lake
        return _LAKES[key]


def _silver_lake(spark, sf_dir) -> Lake:
    lake = _bronze(spark, sf_dir)
    key = ("silver", spark.sparkContext.applicationId, sf_dir)
    with _LOCK:
        if key not in _LAKES:
            job.build_silver(spark, lake, FIXTURE)
            _LAKES[key] = lake
    return lake


_LAKES: dict = {}


@register("bronze_employees")
def q_bronze_employees(spark, sf_dir):
    return raw_csv.accepted(_bronze(spark, sf_dir).read(spark, "bronze", "bronze_employees")).drop(INGEST_COL)


@register("bronze_timesheets")
def q_bronze_timesheets(spark, sf_dir):
    return raw_csv.accepted(_bronze(spark, sf_dir).read(spark, "bronze", "bronze_timesheets")).drop(INGEST_COL)


@register("bronze_rejects")
def q_bronze_rejects(spark, sf_dir):
    rejects = job.write_rejects(spark, _bronze(spark, sf_dir))
    return rejects.select("table_name", F.regexp_extract("file", "(timesheet_[0-9]+)", 1).alias("file"), "record")


@register("silver_employees_from_files")
def q_silver_employees_from_files(spark, sf_dir):
    return S.public_columns(_silver_lake(spark, sf_dir).read(spark, "silver", "silver_employees"))


@register("silver_timesheets_from_files")
def q_silver_timesheets_from_files(spark, sf_dir):
    ts = read_silver_timesheets(spark, _silver_lake(spark, sf_dir))
    return ts.select(*TS_RAW_COLS, *TS_FLAG_COLS, "shift_label", "shift_note")


# --- serving reads -------------------------------------------------------------------


@register("read_employees")
def q_read_employees(spark, sf_dir):
    return SV.employees(S.public_columns(silver_employees(spark, sf_dir)))


@register("read_employee_by_id")
def q_read_employee_by_id(spark, sf_dir):
    return SV.employee(S.public_columns(silver_employees(spark, sf_dir)), "7")


@register("read_timesheets_filtered")
def q_read_timesheets_filtered(spark, sf_dir):
    ts = silver_timesheets(spark, sf_dir)
    out = SV.timesheets(ts, start_date="1996-01-01", end_date="1996-06-30")
    return out.select(*TS_RAW_COLS, *TS_FLAG_COLS)


@register("read_timesheets_counted")
def q_read_timesheets_counted(spark, sf_dir):
    ts = silver_timesheets(spark, sf_dir)
    out = SV.timesheets_counted(ts, client_employee_id="7", start_date="1996-01-01", limit=30)
    return out.select(*TS_RAW_COLS, "count")


@register("serve_active_headcount")
def q_serve_active_headcount(spark, sf_dir):
    return SV.active_headcount(gold(spark, sf_dir, "kpi_active_headcount"))


@register("serve_turnover_rate")
def q_serve_turnover_rate(spark, sf_dir):
    return SV.turnover_rate(gold(spark, sf_dir, "kpi_turnover_trend"), gold(spark, sf_dir, "kpi_active_headcount"))


@register("serve_tenure")
def q_serve_tenure(spark, sf_dir):
    return SV.tenure(gold(spark, sf_dir, "kpi_avg_tenure"))


@register("serve_late_arrivals")
def q_serve_late(spark, sf_dir):
    return SV.late_arrivals(gold(spark, sf_dir, "kpi_late_arrivals"))


@register("serve_overtime")
def q_serve_overtime(spark, sf_dir):
    return SV.overtime(gold(spark, sf_dir, "kpi_overtime"))


@register("serve_attrition")
def q_serve_attrition(spark, sf_dir):
    return SV.attrition(gold(spark, sf_dir, "kpi_early_attrition"))


@register("serve_avg_working_hours")
def q_serve_hours(spark, sf_dir):
    return SV.avg_working_hours(gold(spark, sf_dir, "kpi_avg_working_hours"))


@register("serve_early_departures")
def q_serve_early(spark, sf_dir):
    return SV.early_departures(gold(spark, sf_dir, "kpi_early_departures"))


@register("serve_rolling_avg_hours")
def q_serve_rolling(spark, sf_dir):
    return SV.rolling_avg_hours(gold(spark, sf_dir, "kpi_rolling_avg"))


# --- chart datasets ------------------------------------------------------------------

_CHARTS = {
    "chart_active_headcount": ("kpi_active_headcount", CH.active_headcount),
    "chart_turnover": ("kpi_turnover_trend", CH.turnover),
    "chart_tenure": ("kpi_avg_tenure", CH.tenure),
    "chart_late_arrivals": ("kpi_late_arrivals", CH.late_arrivals),
    "chart_overtime": ("kpi_overtime", CH.overtime),
    "chart_attrition": ("kpi_early_attrition", CH.attrition),
    "chart_weekly_hours": ("kpi_avg_working_hours", CH.weekly_hours),
    "chart_early_departures": ("kpi_early_departures", CH.early_departures),
    "chart_rolling_sample": ("kpi_rolling_avg", CH.rolling_sample),
}


def _chart_query(key: str) -> Query:
    kpi, fn = _CHARTS[key]

    def q(spark, sf_dir):
        if key == "chart_weekly_hours":  # from all weeks, not from the cut report
            return fn(G.weekly_hours(silver_timesheets(spark, sf_dir)))
        if key == "chart_rolling_sample":  # from all employees
            return fn(silver_timesheets(spark, sf_dir))
        return fn(gold(spark, sf_dir, kpi))

    q.__name__ = f"q_{key}"
    return q


for _key in _CHARTS:
    register(_key)(_chart_query(_key))


# --- KPI variants ----------------------------------------------------------------------


def _var_inputs(spark, sf_dir):
    return (
        V.rename_employees(silver_employees(spark, sf_dir)),
        V.rename_timesheets(silver_timesheets(spark, sf_dir)),
    )


@register("var_active_headcount")
def q_var_headcount(spark, sf_dir):
    emp, ts = _var_inputs(spark, sf_dir)
    return V.active_headcount(emp, ts)


@register("var_turnover")
def q_var_turnover(spark, sf_dir):
    return V.turnover(_var_inputs(spark, sf_dir)[0])


@register("var_avg_tenure")
def q_var_tenure(spark, sf_dir):
    return V.avg_tenure(_var_inputs(spark, sf_dir)[0], FIXTURE)


@register("var_avg_working_hours")
def q_var_hours(spark, sf_dir):
    return V.avg_working_hours(_var_inputs(spark, sf_dir)[1])


@register("var_late_arrivals")
def q_var_late(spark, sf_dir):
    return V.late_arrivals(_var_inputs(spark, sf_dir)[1], FIXTURE)


@register("var_early_departures")
def q_var_early(spark, sf_dir):
    return V.early_departures(_var_inputs(spark, sf_dir)[1], FIXTURE)


@register("var_overtime")
def q_var_overtime(spark, sf_dir):
    return V.overtime(_var_inputs(spark, sf_dir)[1], FIXTURE)


@register("var_rolling_avg")
def q_var_rolling(spark, sf_dir):
    return V.rolling_avg(_var_inputs(spark, sf_dir)[1], FIXTURE)


@register("var_attrition_months")
def q_var_attrition(spark, sf_dir):
    return V.attrition(_var_inputs(spark, sf_dir)[0], FIXTURE)


# --- row changes -------------------------------------------------------------------------


def change_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change batch derived from the driver tables (fixed rule, see the oracle):
    suppliers join as new employees; rich customers move to their nation's
    department; very poor ones send an empty update; some customers are deleted
    (the richest after their update, so the delete wins); suppliers with a
    negative balance delete ids that do not exist. One customer in 50 each sends
    two partial updates; is deleted and hired again; is hired under a new id and
    moved; is updated and deleted; sends two updates with one seq; sends an
    update without seq and a later one."""
    supplier = FX.table(spark, sf_dir, "supplier")
    customer = FX.table(spark, sf_dir, "customer")
    nation = FX.table(spark, sf_dir, "nation")
    text, time = F.lit(None).cast("string"), F.lit(None).cast("timestamp_ntz")

    def row(op, cid, seq, first=text, last=text, dept=text, hire=time):
        return F.struct(F.lit(op).alias("op"), cid.cast("bigint").alias("client_employee_id"), first.alias("first_name"),
                        last.alias("last_name"), dept.alias("department_name"), hire.alias("hire_date"),
                        F.lit(seq).cast("bigint").alias("seq"))

    def batch(source, rules):
        """One scan of the source: each row gives the changes of the rules it fulfils."""
        changes = F.filter(F.array(*[F.when(rule, change) for rule, change in rules]), lambda x: x.isNotNull())
        return source.select(F.inline(changes))

    base_day = F.lit(dt.datetime(1996, 1, 1)).cast("timestamp_ntz")
    own = F.col("s_suppkey")
    hire = base_day + F.make_dt_interval(own.cast("int"))
    suppliers = batch(supplier, [
        (F.lit(True), row("insert", -own, 1, F.lit("Supplier"), F.col("s_name"), F.lit("SUPPLY"), hire)),
        (F.col("s_acctbal") < 0, row("delete", -own - F.lit(1_000_000_000), 4)),
    ])
    cid, name, money, lit = F.col("c_custkey"), F.col("c_name"), F.col("c_acctbal"), F.lit
    fifty = lambda k: cid % 50 == k
    customers = batch(customer.join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"), "left"), [
        ((money > 9000) & F.col("n_name").isNotNull(), row("update", cid, 2, dept=F.col("n_name"))),
        (money < -990, row("update", cid, 2)),
        (((money < -900) & (money >= -990)) | (money > 9900), row("delete", cid, 3)),
        (fifty(1), row("update", cid, 5, first=lit("Ann"))), (fifty(1), row("update", cid, 6, last=lit("Two"))),
        (fifty(2), row("delete", cid, 7)), (fifty(2), row("insert", cid, 8, lit("Again"), name, lit("REHIRED"), base_day)),
        (fifty(3), row("insert", cid + 10_000_000, 5, lit("New"), name, lit("NEW"), base_day)),
        (fifty(3), row("update", cid + 10_000_000, 6, dept=lit("MOVED"))),
        (fifty(4), row("update", cid, 5, dept=lit("GONE"))), (fifty(4), row("delete", cid, 6)),
        (fifty(5), row("update", cid, 5, last=lit("Alpha"))), (fifty(5), row("update", cid, 5, last=lit("Beta"))),
        (fifty(6), row("update", cid, None, lit("Early"), lit("Early"))), (fifty(6), row("update", cid, 5, lit("Late"))),
    ])
    return suppliers.unionByName(customers)


def _changes(fn):
    def q(spark, sf_dir):
        emp = S.public_columns(silver_employees(spark, sf_dir))
        return fn(emp, change_batch(spark, sf_dir))

    return q


register("changes_insert")(_changes(lambda emp, ch: CG.insert(emp, ch, FIXTURE)))
register("changes_update")(_changes(CG.update))
register("changes_delete")(_changes(CG.delete))
register("changes_apply")(_changes(lambda emp, ch: CG.apply(emp, ch, FIXTURE)))
register("changes_rejects")(_changes(CG.rejects))


# --- data quality ---------------------------------------------------------------------------


@register("dq_row_counts")
def q_dq_row_counts(spark, sf_dir):
    return Q.row_counts(silver_employees(spark, sf_dir), silver_timesheets(spark, sf_dir))
