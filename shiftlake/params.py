"""Parameters and fixed values of the workforce job.

Everything a run can vary is a field of :class:`Params`; the module-level
constants below are fixed values that results depend on.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (results must equal the behaviour being reproduced)
# ---------------------------------------------------------------------------

# Cell texts a pandas ``read_csv`` with default settings reads as missing.
# They are matched on the raw (untrimmed) cell.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# Characters Python's ``str.strip()`` removes (``str.isspace``), by code point,
# and the same set as a regex class.
PY_WHITESPACE_CODES = (
    0x9, 0xA, 0xB, 0xC, 0xD, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680,
    0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A,
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
PY_WHITESPACE_CHARS = tuple(chr(c) for c in PY_WHITESPACE_CODES)
PY_WHITESPACE_CLASS = (
    "[\\x{9}\\x{a}\\x{b}\\x{c}\\x{d}\\x{1c}\\x{1d}\\x{1e}\\x{1f}\\x{20}\\x{85}\\x{a0}"
    "\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
)

# Timestamps a nanosecond datetime can hold; values outside become null.
TS_MIN = _dt.datetime(1677, 9, 21, 0, 12, 44)
TS_MAX = _dt.datetime(2262, 4, 11, 23, 47, 16)

# Raw file patterns and delimiter.
EMPLOYEE_GLOB = "employee*.csv"
TIMESHEET_GLOB = "timesheet*.csv"
CSV_SEP = "|"
CSV_QUOTE = '"'

# Attrition labels of the gold KPI and of the SQL-file variant.
EARLY_ATTRITION_LABEL = "Early Attrition (<90 days)"
OTHER_ATTRITION_LABEL = "Other Attrition (≥90 days)"
VAR_EARLY_LABEL = "Early Attrition"
VAR_OTHER_LABEL = "Other"

# Result limits of serving reads and chart datasets (those of the reports are fields of ``Params``).
SERVE_MONTHS = 12
SERVE_TOP = 20
SERVE_ROLLING = 50
SERVE_EMPLOYEES = 100
SERVE_TIMESHEETS = 100
CHART_TOP = 20
CHART_WEEKS = 50
CHART_SAMPLE_EMPLOYEES = 10

# Column lists.
EMPLOYEE_DATE_COLS = ("hire_date", "term_date", "dob")
TIMESHEET_TS_COLS = (
    "punch_apply_date",
    "punch_in_datetime",
    "punch_out_datetime",
    "scheduled_start_datetime",
    "scheduled_end_datetime",
)
EMPLOYEE_KEY = "client_employee_id"
TIMESHEET_KEY = ("client_employee_id", "punch_in_datetime")
INGEST_COL = "_ingest"  # struct giving the original row order (file order)

# Text formats for timestamp columns, to be tried in order value by value
# (``Params.ts_formats=LENIENT_TS_FORMATS``): an ISO date, optionally followed by a time (space or 'T', seconds
# and up to nine fraction digits optional) and a 'Z'; a month-first date with slashes.
LENIENT_TS_FORMATS = ("yyyy-MM-dd[['T'][ ]HH:mm[:ss][.SSSSSSSSS]]['Z']", "M/d/yyyy[ H:mm[:ss]]")


def _today() -> _dt.datetime:
    return _dt.datetime.combine(_dt.date.today(), _dt.time())


@dataclass(frozen=True)
class Params:
    """Knobs of one job run."""

    as_of: _dt.datetime = field(default_factory=_today)  # end of tenure of those still employed
    grace_minutes: float = 5.0
    normal_min_hours: float = 7.5
    normal_max_hours: float = 8.5
    overtime_hours: float = 8.5
    overtime_base_hours: float = 8.0
    early_attrition_days: int = 90
    rolling_rows: int = 30
    var_early_months: int = 3
    ts_formats: tuple | None = None  # formats tried value by value; none: each column's own, taken from its first value
    sample_seed: str = "42"
    # rows of the top reports
    limit_weekly_hours: int = 1000
    limit_late: int = 100
    limit_early: int = 100
    limit_overtime: int = 100
    limit_rolling: int = 5000
    # raw files
    multi_line: bool = True  # quoted cells may hold line breaks
    several_employee_files: str = "error"  # or "first" (by name), or "all"
    cluster_by_date: bool = False  # silver timesheets in files of a few days each, with an index of the files
    allow_rejects: bool = False  # rows with more cells than their header don't end the run


class _Default:
    """The default parameters, made anew at each use: a long-lived driver's "today" moves on."""

    def __getattr__(self, name: str):
        return getattr(Params(), name)


DEFAULT = _Default()
