"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written directly in DuckDB's dialect over the driver tables; shares no code
with the Spark plans. Fixture mapping as in ``shiftlake.sources.fixtures``;
``as_of`` = 2002-01-01.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2002-01-01 00:00:00'"

FX_EMP = """
fx_emp AS (
  SELECT c.c_custkey AS client_employee_id,
         'Customer' AS first_name,
         c.c_name AS last_name,
         CASE WHEN c.c_nationkey = 0 THEN NULL ELSE c.c_mktsegment END AS department_name,
         f.h AS hire_date,
         CASE WHEN c.c_acctbal < 2000
              THEN f.h + to_days(CAST((c.c_custkey * 37) % 360 AS INTEGER)) END AS term_date
  FROM customer c
  JOIN (SELECT o_custkey, min(o_orderdate) AS h FROM orders GROUP BY o_custkey) f
    ON f.o_custkey = c.c_custkey
)"""

SILVER_EMP = """
silver_emp AS (
  SELECT client_employee_id, first_name, last_name, department_name, hire_date, term_date,
         CAST(term_date IS NULL AS BIGINT) AS is_active,
         CAST(floor(date_diff('microsecond', hire_date, coalesce(term_date, {as_of}))
                    / 86400000000.0) AS BIGINT) AS tenure_days
  FROM fx_emp
  QUALIFY row_number() OVER (PARTITION BY client_employee_id ORDER BY client_employee_id) = 1
)""".format(as_of=AS_OF)

FX_TS = """
fx_ts AS (
  SELECT o.o_custkey AS client_employee_id,
         CASE WHEN l.l_partkey % 500 = 0 THEN NULL ELSE o.o_orderdate END AS punch_apply_date,
         o.o_orderdate + to_hours(9)
           + to_minutes(CAST(round(l.l_discount * 100) AS INTEGER)) AS punch_in_datetime,
         CASE WHEN l.l_linenumber = 7 THEN NULL
              ELSE o.o_orderdate + to_hours(17)
                   - to_minutes(CAST(round(l.l_tax * 100) AS INTEGER)) END AS punch_out_datetime,
         o.o_orderdate + to_hours(9) AS scheduled_start_datetime,
         o.o_orderdate + to_hours(17) AS scheduled_end_datetime,
         CASE WHEN l.l_linenumber = 6 AND l.l_returnflag = 'R' THEN NULL
              ELSE l.l_quantity / 4.0 END AS hours_worked,
         l.l_orderkey AS k1, l.l_linenumber AS k2, l.l_partkey AS k3, l.l_suppkey AS k4,
         l.l_extendedprice AS k5
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""

TS_DEDUP = """
ts_dedup AS (
  SELECT * FROM fx_ts
  QUALIFY row_number() OVER (PARTITION BY client_employee_id, punch_in_datetime
                             ORDER BY k1, k2, k3, k4, k5) = 1
)"""

SILVER_TS = """
ts_minutes AS (
  SELECT *,
         coalesce(CAST(date_diff('microsecond', scheduled_start_datetime, punch_in_datetime) AS DOUBLE)
                  / 60000000, 0) AS minutes_late,
         coalesce(CAST(date_diff('microsecond', punch_out_datetime, scheduled_end_datetime) AS DOUBLE)
                  / 60000000, 0) AS minutes_early
  FROM ts_dedup
),
silver_ts AS (
  SELECT *,
         CAST(minutes_late > 5 AS BIGINT) AS is_late,
         CAST(minutes_early > 5 AS BIGINT) AS is_early,
         CAST(coalesce(hours_worked > 8.5, false) AS BIGINT) AS is_overtime,
         CAST(coalesce(hours_worked >= 7.5 AND hours_worked <= 8.5, false) AS BIGINT) AS is_normal_work
  FROM ts_minutes
)"""

EMP_COLS = "client_employee_id, first_name, last_name, department_name, hire_date, term_date"
TS_RAW_COLS = (
    "client_employee_id, punch_apply_date, punch_in_datetime, punch_out_datetime, "
    "scheduled_start_datetime, scheduled_end_datetime, hours_worked"
)
TS_SILVER_COLS = TS_RAW_COLS + (
    ", minutes_late, minutes_early, is_late, is_early, is_overtime, is_normal_work"
)

BASE = "WITH " + ",".join([FX_EMP, SILVER_EMP, FX_TS, TS_DEDUP, SILVER_TS]) + "\n"

# --- gold (each also a CTE so that reads over gold can reuse it) -----------------

GOLD = {
    "kpi_active_headcount": """
  SELECT m.month, (
    SELECT count(*) FROM (SELECT client_employee_id FROM silver_emp GROUP BY 1) i
    WHERE EXISTS (
      SELECT 1 FROM days d JOIN silver_emp s ON d.day >= s.hire_date AND coalesce(d.day < s.term_date, true)
      WHERE s.client_employee_id = i.client_employee_id AND d.month = m.month)) AS active_headcount
  FROM (SELECT DISTINCT month FROM days) m WHERE EXISTS (SELECT 1 FROM silver_emp)""",
    "kpi_turnover_trend": """
  SELECT CAST(date_trunc('month', term_date) AS DATE) AS month, count(*) AS terminations
  FROM silver_emp WHERE term_date IS NOT NULL GROUP BY 1""",
    "kpi_avg_tenure": """
  SELECT department_name, round(avg(tenure_days) / 365.25, 2) AS avg_tenure_years,
         count(*) AS employee_count
  FROM silver_emp WHERE department_name IS NOT NULL GROUP BY department_name""",
    "kpi_avg_working_hours": """
  SELECT client_employee_id, CAST(date_trunc('week', punch_apply_date) AS DATE) AS week,
         round(avg(hours_worked), 2) AS avg_hours, count(*) AS days_worked
  FROM silver_ts WHERE is_normal_work = 1
  GROUP BY 1, 2
  ORDER BY week DESC NULLS LAST, client_employee_id ASC NULLS LAST
  LIMIT 1000""",
    "kpi_late_arrivals": """
  SELECT client_employee_id, count(*) AS late_count, round(avg(minutes_late), 2) AS avg_minutes_late
  FROM silver_ts WHERE is_late = 1 GROUP BY client_employee_id
  ORDER BY late_count DESC, client_employee_id ASC NULLS LAST LIMIT 100""",
    "kpi_early_departures": """
  SELECT client_employee_id, count(*) AS early_count, round(avg(minutes_early), 2) AS avg_minutes_early
  FROM silver_ts WHERE is_early = 1 GROUP BY client_employee_id
  ORDER BY early_count DESC, client_employee_id ASC NULLS LAST LIMIT 100""",
    "kpi_overtime": """
  SELECT client_employee_id, count(*) AS overtime_days, round(sum(hours_worked - 8), 2) AS total_extra_hours
  FROM silver_ts WHERE is_overtime = 1 GROUP BY client_employee_id
  ORDER BY overtime_days DESC, client_employee_id ASC NULLS LAST LIMIT 100""",
    "kpi_rolling_avg": """
  SELECT client_employee_id, punch_apply_date, rolling_30day_avg FROM (
    SELECT client_employee_id, punch_apply_date, punch_in_datetime, k1, k2, k3, k4, k5,
           round(avg(hours_worked) OVER (
             PARTITION BY client_employee_id
             ORDER BY punch_apply_date ASC NULLS LAST, punch_in_datetime ASC NULLS LAST, k1, k2, k3, k4, k5
             ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 2) AS rolling_30day_avg
    FROM silver_ts)
  ORDER BY punch_apply_date DESC NULLS LAST, client_employee_id ASC NULLS LAST,
           punch_in_datetime ASC NULLS LAST, k1, k2, k3, k4, k5
  LIMIT 5000""",
    "kpi_early_attrition": """
  UNPIVOT (
    SELECT count(*) FILTER (WHERE date_diff('microsecond', hire_date, term_date) < 90 * 86400000000)
             AS "Early Attrition (<90 days)",
           count(*) FILTER (WHERE date_diff('microsecond', hire_date, term_date) >= 90 * 86400000000)
             AS "Other Attrition (≥90 days)"
    FROM silver_emp WHERE term_date IS NOT NULL
  ) ON COLUMNS(*) INTO NAME attrition_type VALUE count""",
}


# the distinct apply dates, each with its month
DAYS = """,
days AS (SELECT DISTINCT punch_apply_date AS day, CAST(date_trunc('month', punch_apply_date) AS DATE) AS month FROM silver_ts)"""


def with_gold(final: str) -> str:
    ctes = ",\n".join(f"{k} AS ({v}\n)" for k, v in GOLD.items())
    return BASE.rstrip() + DAYS + ",\n" + ctes + "\n" + final


ORACLE: dict[str, str] = {}

# silver: employees
ORACLE["emp_dedup_first"] = BASE + f"SELECT {EMP_COLS} FROM silver_emp"
ORACLE["emp_coerce_dates"] = BASE + f"SELECT {EMP_COLS} FROM silver_emp"
ORACLE["emp_is_active"] = BASE + "SELECT client_employee_id, is_active FROM silver_emp"
ORACLE["emp_tenure_days"] = BASE + "SELECT client_employee_id, tenure_days FROM silver_emp"
ORACLE["silver_employees"] = BASE + "SELECT * FROM silver_emp"

# silver: timesheets
ORACLE["ts_dedup_first"] = BASE + f"SELECT {TS_RAW_COLS} FROM ts_dedup"
ORACLE["ts_coerce_datetimes"] = BASE + f"SELECT {TS_RAW_COLS} FROM ts_dedup"
for _c in ("minutes_late", "minutes_early", "is_late", "is_early", "is_overtime", "is_normal_work"):
    ORACLE[f"ts_{_c}"] = BASE + f"SELECT client_employee_id, punch_in_datetime, {_c} FROM silver_ts"
ORACLE["silver_timesheets"] = BASE + f"SELECT {TS_SILVER_COLS} FROM silver_ts"

# gold
for _name, _sql in GOLD.items():
    ORACLE[_name] = BASE.rstrip() + DAYS + "\n" + _sql

# --- sources / bronze: the fixture as text, as the files hold it -------------------

TS_FMT = "'%Y-%m-%d %H:%M:%S'"
NOTE = """CASE WHEN year(scheduled_start_datetime) >= 1999 AND punch_out_datetime IS NULL
       THEN 'line one of "' || client_employee_id || '"' || chr(10) || 'line|two' || chr(10) || chr(10) || 'last' END"""
SRC_EMP = f"""
SELECT CAST(client_employee_id AS VARCHAR) AS client_employee_id, first_name, last_name, department_name,
       strftime(hire_date, {TS_FMT}) AS hire_date, strftime(term_date, {TS_FMT}) AS term_date
FROM fx_emp"""
SRC_TS = f"""
SELECT CAST(client_employee_id AS VARCHAR) AS client_employee_id,
       strftime(punch_apply_date, {TS_FMT}) AS punch_apply_date,
       strftime(punch_in_datetime, {TS_FMT}) AS punch_in_datetime,
       strftime(punch_out_datetime, {TS_FMT}) AS punch_out_datetime,
       strftime(scheduled_start_datetime, {TS_FMT}) AS scheduled_start_datetime,
       strftime(scheduled_end_datetime, {TS_FMT}) AS scheduled_end_datetime,
       CAST(hours_worked AS VARCHAR) AS hours_worked,
       CASE WHEN year(scheduled_start_datetime) >= 1999 THEN strftime(scheduled_start_datetime, '%a') END AS shift_label,
       {NOTE} AS shift_note
FROM fx_ts"""
ORACLE["src_employees_csv"] = BASE + SRC_EMP
ORACLE["src_timesheets_csv"] = BASE + SRC_TS
ORACLE["bronze_employees"] = BASE + SRC_EMP
ORACLE["bronze_timesheets"] = BASE + SRC_TS

_WS = (
    "[\\x{9}\\x{a}\\x{b}\\x{c}\\x{d}\\x{1c}\\x{1d}\\x{1e}\\x{1f}\\x{20}\\x{85}\\x{a0}"
    "\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
)


def _strip(col: str) -> str:
    return f"regexp_replace({col}, '\\A{_WS}+|{_WS}+\\z', '', 'g') AS {col}"


_NA = ", ".join(
    "'" + t.replace("'", "''") + "'"
    for t in ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
              "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
)


def _na(col: str) -> str:
    return f"CASE WHEN {col} IN ({_NA}) THEN NULL ELSE {col} END AS {col}"


ORACLE["bronze_trim_strings"] = (
    f"SELECT doc_id, {_strip('text')}, {_strip('lang')}, {_strip('source')}, n_chars FROM documents"
)
ORACLE["bronze_null_tokens"] = f"SELECT doc_id, {_na('text')}, {_na('lang')}, {_na('source')}, n_chars FROM documents"

ORACLE["silver_employees_from_files"] = BASE + "SELECT * FROM silver_emp"
ORACLE["silver_timesheets_from_files"] = BASE + (
    f"SELECT {TS_SILVER_COLS}, CASE WHEN year(scheduled_start_datetime) >= 1999 "
    f"THEN strftime(scheduled_start_datetime, '%a') END AS shift_label, {NOTE} AS shift_note FROM silver_ts"
)
ORACLE["bronze_rejects"] = """
SELECT 'bronze_timesheets' AS table_name, 'timesheet_4' AS file,
       s_suppkey || repeat('|', 6 + s_suppkey % 10 + 2) || s_name AS record FROM supplier"""

# --- serving reads ------------------------------------------------------------------------

ORACLE["read_employees"] = BASE + "SELECT * FROM silver_emp ORDER BY client_employee_id NULLS LAST LIMIT 100"
ORACLE["read_employee_by_id"] = BASE + "SELECT * FROM silver_emp WHERE client_employee_id = 7 LIMIT 1"
ORACLE["read_timesheets_filtered"] = BASE + f"""
SELECT {TS_SILVER_COLS} FROM silver_ts
WHERE punch_apply_date >= TIMESTAMP '1996-01-01' AND punch_apply_date <= TIMESTAMP '1996-06-30'
ORDER BY punch_apply_date DESC NULLS LAST, client_employee_id ASC NULLS LAST,
         punch_in_datetime ASC NULLS LAST, k1, k2, k3, k4, k5
LIMIT 100"""
ORACLE["read_timesheets_counted"] = BASE + f"""
SELECT *, count(*) OVER () AS count FROM (
  SELECT {TS_RAW_COLS} FROM silver_ts
  WHERE client_employee_id = 7 AND punch_apply_date >= TIMESTAMP '1996-01-01'
  ORDER BY punch_apply_date DESC NULLS LAST, client_employee_id ASC NULLS LAST,
           punch_in_datetime ASC NULLS LAST, k1, k2, k3, k4, k5
  LIMIT 30)"""
ORACLE["serve_active_headcount"] = with_gold(
    "SELECT month, active_headcount FROM kpi_active_headcount ORDER BY month DESC NULLS LAST LIMIT 12"
)
ORACLE["serve_turnover_rate"] = with_gold("""
SELECT t.month, t.terminations,
       CASE WHEN h.active_headcount > 0 THEN CAST(t.terminations AS DOUBLE) / h.active_headcount END AS turnover_rate
FROM kpi_turnover_trend t LEFT JOIN kpi_active_headcount h ON h.month = t.month
ORDER BY t.month DESC NULLS LAST LIMIT 12""")
ORACLE["serve_tenure"] = with_gold(
    "SELECT department_name AS department, round(avg_tenure_years, 2) AS avg_years, employee_count AS count "
    "FROM kpi_avg_tenure"
)
ORACLE["serve_late_arrivals"] = with_gold("""
SELECT client_employee_id AS employee_id, late_count, round(avg_minutes_late, 1) AS avg_min_late
FROM kpi_late_arrivals ORDER BY late_count DESC, client_employee_id NULLS LAST LIMIT 20""")
ORACLE["serve_overtime"] = with_gold("""
SELECT client_employee_id AS employee_id, overtime_days, round(total_extra_hours, 1) AS extra_hours
FROM kpi_overtime ORDER BY overtime_days DESC, client_employee_id NULLS LAST LIMIT 20""")
ORACLE["serve_attrition"] = with_gold("SELECT attrition_type AS type, count FROM kpi_early_attrition")
ORACLE["serve_avg_working_hours"] = with_gold("""
SELECT client_employee_id AS employee, week, round(avg_hours, 1) AS avg_hours, days_worked AS days
FROM kpi_avg_working_hours ORDER BY week DESC NULLS LAST, client_employee_id NULLS LAST LIMIT 20""")
ORACLE["serve_early_departures"] = with_gold("""
SELECT client_employee_id AS employee_id, early_count, round(avg_minutes_early, 1) AS avg_min_early
FROM kpi_early_departures ORDER BY early_count DESC, client_employee_id NULLS LAST LIMIT 20""")
ORACLE["serve_rolling_avg_hours"] = with_gold("""
SELECT client_employee_id AS employee, punch_apply_date AS date, round(rolling_30day_avg, 1) AS rolling_30d_avg
FROM kpi_rolling_avg
ORDER BY punch_apply_date DESC NULLS LAST, client_employee_id NULLS LAST, rolling_30day_avg NULLS LAST
LIMIT 50""")

# --- chart datasets ------------------------------------------------------------------------

ORACLE["chart_active_headcount"] = with_gold(
    "SELECT strftime(month, '%Y-%m') AS month, active_headcount FROM kpi_active_headcount"
)
ORACLE["chart_turnover"] = with_gold("SELECT strftime(month, '%Y-%m') AS month, terminations FROM kpi_turnover_trend")
ORACLE["chart_tenure"] = with_gold("SELECT * FROM kpi_avg_tenure")
ORACLE["chart_late_arrivals"] = with_gold(
    "SELECT * FROM kpi_late_arrivals ORDER BY late_count DESC, client_employee_id NULLS LAST LIMIT 20"
)
ORACLE["chart_overtime"] = with_gold(
    "SELECT * FROM kpi_overtime ORDER BY overtime_days DESC, client_employee_id NULLS LAST LIMIT 20"
)
ORACLE["chart_attrition"] = with_gold("SELECT attrition_type, count FROM kpi_early_attrition")
ORACLE["chart_weekly_hours"] = BASE.rstrip() + """,
per_week AS (
  SELECT client_employee_id AS id, date_trunc('week', punch_apply_date) AS wk, round(avg(hours_worked), 2) AS h
  FROM silver_ts WHERE is_normal_work = 1 GROUP BY ALL)
SELECT strftime(wk, '%Y-%m-%d') AS week, round(avg(h), 2) AS avg_hours_all, count(DISTINCT id) AS num_employees
FROM per_week GROUP BY wk ORDER BY wk DESC NULLS LAST LIMIT 50"""
ORACLE["chart_early_departures"] = with_gold(
    "SELECT * FROM kpi_early_departures ORDER BY early_count DESC, client_employee_id NULLS LAST LIMIT 20"
)
ORACLE["chart_rolling_sample"] = BASE.rstrip() + """,
drawn AS (
  SELECT client_employee_id FROM silver_ts WHERE client_employee_id IS NOT NULL GROUP BY 1
  ORDER BY md5('42' || CAST(client_employee_id AS VARCHAR)), client_employee_id LIMIT 10)
SELECT client_employee_id, strftime(punch_apply_date, '%Y-%m-%d') AS punch_apply_date,
       round(avg(hours_worked) OVER (
         PARTITION BY client_employee_id
         ORDER BY punch_apply_date NULLS LAST, punch_in_datetime NULLS LAST, k1, k2, k3, k4, k5
         ROWS 29 PRECEDING), 2) AS rolling_30day_avg
FROM silver_ts SEMI JOIN drawn USING (client_employee_id)"""

# --- KPI variants ---------------------------------------------------------------------------

ORACLE["var_active_headcount"] = with_gold("SELECT CAST(month AS TIMESTAMP) AS month, active_headcount FROM kpi_active_headcount")
ORACLE["var_turnover"] = BASE + (
    "SELECT date_trunc('month', term_date) AS month, count(*) AS terminations "
    "FROM silver_emp WHERE term_date IS NOT NULL GROUP BY 1"
)
ORACLE["var_avg_tenure"] = BASE + f"""
SELECT department_name AS department,
       avg(CAST(trunc(date_diff('microsecond', hire_date, coalesce(term_date, {AS_OF})) / 86400000000.0) AS BIGINT))
         / 365.25 AS avg_tenure_years
FROM silver_emp GROUP BY 1"""
ORACLE["var_avg_working_hours"] = BASE + (
    "SELECT client_employee_id AS employee_id, date_trunc('week', punch_apply_date) AS week, "
    "avg(hours_worked) AS avg_hours FROM silver_ts GROUP BY 1, 2"
)
ORACLE["var_late_arrivals"] = BASE + (
    "SELECT client_employee_id AS employee_id, count(*) AS late_arrivals FROM silver_ts "
    "WHERE epoch(punch_in_datetime - scheduled_start_datetime) / 60 > 5 GROUP BY 1"
)
ORACLE["var_early_departures"] = BASE + (
    "SELECT client_employee_id AS employee_id, count(*) AS early_departures FROM silver_ts "
    "WHERE epoch(scheduled_end_datetime - punch_out_datetime) / 60 > 5 GROUP BY 1"
)
ORACLE["var_overtime"] = BASE + (
    "SELECT client_employee_id AS employee_id, count(*) AS overtime_days FROM silver_ts "
    "WHERE hours_worked > 8.5 GROUP BY 1"
)
ORACLE["var_rolling_avg"] = BASE + """
SELECT client_employee_id AS employee_id, punch_apply_date AS date,
       avg(hours_worked) OVER (
         PARTITION BY client_employee_id
         ORDER BY punch_apply_date ASC NULLS LAST, punch_in_datetime ASC NULLS LAST, k1, k2, k3, k4, k5
         ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS rolling_30day_avg
FROM silver_ts"""
ORACLE["var_attrition_months"] = BASE + """
SELECT CASE WHEN 12 * (year(term_date) - year(hire_date)) + (month(term_date) - month(hire_date))
                 - CASE WHEN day(term_date) < day(hire_date) THEN 1 ELSE 0 END <= 3
            THEN 'Early Attrition' ELSE 'Other' END AS attrition_type,
       count(*) AS count
FROM silver_emp WHERE term_date IS NOT NULL GROUP BY 1"""

# --- row changes ----------------------------------------------------------------------------

CHANGES = """,
changes AS (
  SELECT 'insert' AS op, -s_suppkey AS client_employee_id, 'Supplier' AS first_name, s_name AS last_name,
         'SUPPLY' AS department_name, TIMESTAMP '1996-01-01' + to_days(CAST(s_suppkey AS INTEGER)) AS hire_date,
         CAST(1 AS BIGINT) AS seq
  FROM supplier
  UNION ALL
  SELECT 'update', c_custkey, NULL, NULL, n_name, NULL, 2
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 9000
  UNION ALL
  SELECT 'update', c_custkey, NULL, NULL, NULL, NULL, 2 FROM customer WHERE c_acctbal < -990
  UNION ALL
  SELECT 'delete', c_custkey, NULL, NULL, NULL, NULL, 3 FROM customer
  WHERE (c_acctbal < -900 AND c_acctbal >= -990) OR c_acctbal > 9900
  UNION ALL
  SELECT 'delete', -s_suppkey - 1000000000, NULL, NULL, NULL, NULL, 4 FROM supplier WHERE s_acctbal < 0
  UNION ALL
  SELECT op, CASE WHEN rest = 3 THEN c_custkey + 10000000 ELSE c_custkey END,
         fn, CASE WHEN ln = '=' THEN c_name ELSE ln END, dept, CASE WHEN op = 'insert' THEN TIMESTAMP '1996-01-01' END, sq
  FROM customer JOIN (VALUES
    (1, 'update', 'Ann', NULL, NULL, 5), (1, 'update', NULL, 'Two', NULL, 6),
    (2, 'delete', NULL, NULL, NULL, 7), (2, 'insert', 'Again', '=', 'REHIRED', 8),
    (3, 'insert', 'New', '=', 'NEW', 5), (3, 'update', NULL, NULL, 'MOVED', 6),
    (4, 'update', NULL, NULL, 'GONE', 5), (4, 'delete', NULL, NULL, NULL, 6),
    (5, 'update', NULL, 'Alpha', NULL, 5), (5, 'update', NULL, 'Beta', NULL, 5),
    (6, 'update', 'Early', 'Early', NULL, NULL), (6, 'update', 'Late', NULL, NULL, 5)
  ) v(rest, op, fn, ln, dept, sq) ON c_custkey % 50 = rest
),
-- replay order: seq (missing first), then delete, insert, update, then the values
ch AS (
  SELECT *, row_number() OVER (ORDER BY seq NULLS FIRST, op, first_name NULLS FIRST, last_name NULLS FIRST,
                               department_name NULLS FIRST, hire_date NULLS FIRST) AS pos
  FROM changes
),
born AS (
  SELECT *, 0 AS born FROM silver_emp
  UNION ALL
  SELECT client_employee_id, first_name, last_name, department_name, hire_date, CAST(NULL AS TIMESTAMP), CAST(1 AS BIGINT),
         CAST(floor(date_diff('microsecond', hire_date, {as_of}) / 86400000000.0) AS BIGINT), pos
  FROM ch WHERE op = 'insert'
)
""".format(as_of=AS_OF)
CH_BASE = BASE.rstrip() + CHANGES


def _after(rows: str, deletes: bool) -> str:
    """The rows with each field as the last update after their birth left it; without those deleted later."""
    field = """coalesce((SELECT arg_max(u.{f}, u.pos) FROM ch u WHERE u.op = 'update' AND u.client_employee_id = b.client_employee_id
              AND u.pos > b.born AND u.{f} IS NOT NULL), b.{f}) AS {f}"""
    gone = """
WHERE NOT EXISTS (SELECT 1 FROM ch d WHERE d.op = 'delete' AND d.client_employee_id = b.client_employee_id AND d.pos > b.born)"""
    fields = ",\n  ".join(field.format(f=f) for f in ("first_name", "last_name", "department_name"))
    return f"""
SELECT b.client_employee_id, {fields}, b.hire_date, b.term_date, b.is_active, b.tenure_days
FROM {rows} b""" + (gone if deletes else "")


ORACLE["changes_insert"] = CH_BASE + "SELECT * EXCLUDE born FROM born"
ORACLE["changes_update"] = CH_BASE + _after("(SELECT * FROM born WHERE born = 0)", deletes=False)
ORACLE["changes_delete"] = CH_BASE + """
SELECT * FROM silver_emp s WHERE NOT EXISTS (
  SELECT 1 FROM changes c WHERE c.op = 'delete' AND c.client_employee_id = s.client_employee_id)"""
ORACLE["changes_apply"] = CH_BASE + _after("born", deletes=True)
ORACLE["changes_rejects"] = CH_BASE.rstrip() + """,
judged AS (
  SELECT c.*, EXISTS (
    SELECT 1 FROM born b WHERE b.client_employee_id = c.client_employee_id AND b.born < c.pos AND NOT EXISTS (
      SELECT 1 FROM ch d WHERE d.op = 'delete' AND d.client_employee_id = b.client_employee_id AND d.pos > b.born AND d.pos < c.pos)) AS there
  FROM ch c WHERE op <> 'insert')
SELECT * EXCLUDE (pos, there), CASE WHEN there THEN 'no fields to update' ELSE 'not found' END AS reason FROM judged
WHERE NOT there OR (op = 'update' AND first_name IS NULL AND last_name IS NULL AND department_name IS NULL)"""

# --- data quality -------------------------------------------------------------------------------

ORACLE["dq_row_counts"] = BASE + """
SELECT 'silver_employees' AS table_name, metric, value FROM (
  SELECT 'rows' AS metric, count(*) AS value FROM silver_emp
  UNION ALL SELECT 'null_id', count(*) FILTER (WHERE client_employee_id IS NULL) FROM silver_emp
  UNION ALL SELECT 'duplicate_id', count(client_employee_id) - count(DISTINCT client_employee_id) FROM silver_emp
  UNION ALL SELECT 'null_hire_date', count(*) FILTER (WHERE hire_date IS NULL) FROM silver_emp
  UNION ALL SELECT 'active', count(*) FILTER (WHERE is_active = 1) FROM silver_emp)
UNION ALL
SELECT 'silver_timesheets', metric, value FROM (
  SELECT 'rows' AS metric, count(*) AS value FROM silver_ts
  UNION ALL SELECT 'null_id', count(*) FILTER (WHERE client_employee_id IS NULL) FROM silver_ts
  UNION ALL SELECT 'orphan_id', count(*) FILTER (
      WHERE client_employee_id IS NOT NULL
        AND client_employee_id NOT IN (SELECT client_employee_id FROM silver_emp WHERE client_employee_id IS NOT NULL))
    FROM silver_ts
  UNION ALL SELECT 'null_apply_date', count(*) FILTER (WHERE punch_apply_date IS NULL) FROM silver_ts
  UNION ALL SELECT 'null_hours', count(*) FILTER (WHERE hours_worked IS NULL) FROM silver_ts)"""


# --- untidy employees, and the gold sink ------------------------------------------------------------

UNTIDY = BASE.rstrip() + """,
untidy AS (
  SELECT client_employee_id, last_name, hire_date AS hired, term_date AS left_on FROM fx_emp
  UNION ALL SELECT -1, 'Row', TIMESTAMP '1999-12-31', TIMESTAMP '2000-01-31'),
dated AS (
  SELECT client_employee_id, last_name,
         CASE WHEN client_employee_id % 7 IN (3, 4) THEN NULL ELSE hired END AS hire_date,
         CASE WHEN client_employee_id % 11 = 5 THEN NULL ELSE left_on END AS term_date FROM untidy)
"""
ORACLE["emp_untidy_cells"] = UNTIDY + """
SELECT client_employee_id, name AS last_name,
       CASE WHEN client_employee_id = -1 THEN 'First'
            ELSE CASE client_employee_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'NA' WHEN 2 THEN 'Ann' ELSE '' END END AS first_name
FROM (SELECT client_employee_id, last_name AS name FROM untidy
      UNION ALL SELECT client_employee_id, 'Later' FROM fx_emp WHERE client_employee_id % 5 = 0)"""
ORACLE["emp_untidy_silver"] = UNTIDY + f"""
SELECT client_employee_id, last_name, hire_date, term_date, CAST(term_date IS NULL AS BIGINT) AS is_active,
       CAST(floor(date_diff('microsecond', hire_date, coalesce(term_date, {AS_OF})) / 86400000000.0) AS DOUBLE) AS tenure_days
FROM dated"""
ORACLE["gold_sink"] = with_gold("\nUNION ALL ".join(f"SELECT '{k}' AS kpi, count(*) AS rows FROM {k}" for k in GOLD))
