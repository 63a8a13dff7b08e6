"""Raw delimited files -> bronze.

* Every cell is read as text (no inference): types are decided in silver.
* Missing-value tokens are matched on the raw cell, then every text cell is
  stripped of surrounding whitespace.
* Each row keeps its file order as ``_ingest = (file path, split start, row
  position)``, written with bronze, so keep-first de-duplication downstream
  is reproducible from the written table.
* One catalogue pass over all files (``sources.records``) gives their headers
  and tells whether any quoted cell holds line breaks; the number of jobs
  doesn't depend on the number of files. All files are then read in one scan whatever their headers:
  cells by position, given their names by the file's header.
* Without such line breaks Spark's CSV source reads the files, split by lines.
  With them, records are put together from the lines of each split, whose
  state at its start is known from the catalogue, so a large file is still
  read by many tasks.
* A row with text beyond its header is a reject: it stays in bronze with its raw
  text in ``_reject`` (null in all other rows), in the same pass (written anew from its cells where the
  CSV source has one cell more than the widest header, and no line for it). Missing cells at the
  end of a row are null.

Lines end with LF or CR LF; files without any text are left out.
"""

from __future__ import annotations

import csv
import fnmatch
import functools
import io
import logging

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftlake.functions.exprs import null_tokens, strip_all
from shiftlake.params import CSV_QUOTE, CSV_SEP, EMPLOYEE_GLOB, INGEST_COL, TIMESHEET_GLOB
from shiftlake.session import scratch_path
from shiftlake.sources import records
from shiftlake.sources.lake import Lake

log = logging.getLogger(__name__)

#: Raw text of a row that has more cells than its file's header.
REJECT_COL = "_reject"
#: Files whose headers may be broadcast (one hash and one number each).
MAX_FILES = 4_000_000

_CSV = {
    "sep": CSV_SEP, "quote": CSV_QUOTE, "escape": CSV_QUOTE, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_raw",
}


def list_entries(spark: SparkSession, raw_dir: str, pattern: str) -> list[str]:
    """The files, and folders of part files (as Spark writes them), that match ``raw_dir/pattern``, sorted.

    Listed with the ``binaryFile`` source selecting only the path, so file
    contents are not read; only distinct entries reach the driver.
    """
    base = raw_dir.rstrip("/")
    try:
        paths = spark.read.format("binaryFile").load(f"{base}/{pattern}").select("path")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    name, parent = F.element_at(F.split("path", "/"), -1), F.element_at(F.split("path", "/"), -2)
    like = fnmatch.translate(pattern).replace("(?s:", "(?s)(?:").replace("\\Z", "\\z").replace("\\z", "$")
    in_folder = parent.rlike(f"^{like}") & ~name.rlike(f"^{like}")
    folder = F.regexp_replace("path", "/[^/]*$", "")
    return sorted(r.e for r in paths.select(F.when(in_folder, folder).otherwise(F.col("path")).alias("e")).distinct().collect())


def header_names(header: str) -> list[str]:
    """Column names of a header record; empty and repeated names get what pandas calls them."""
    names: list[str] = []
    for k, cell in enumerate(next(csv.reader(io.StringIO(header.lstrip("﻿"), newline=""), delimiter=CSV_SEP, quotechar=CSV_QUOTE))):
        name, n = cell or f"Unnamed: {k}", 0
        while (name if not n else f"{name}.{n}") in names:
            n += 1
        names.append(name if not n else f"{name}.{n}")
    return names


def _text_beyond(raw: Column, width: Column) -> Column:
    """Whether a record has text in a cell beyond the first ``width``."""
    plain = F.regexp_replace(F.replace(raw, F.lit('""'), F.lit("")), r'(^|\|)"[^"]*"?', '$1"')
    plain = F.regexp_replace(plain, r"[|\r\n]+$", "")
    return F.length(plain) - F.length(F.replace(plain, F.lit(CSV_SEP), F.lit(""))) >= width


def _is_plain(record: Column, most: int) -> Column:
    """Whether a record has at most ``most`` cells and none of the characters that the parser treats specially."""
    special = functools.reduce(Column.__or__, [record.contains(c) for c in (CSV_QUOTE, "\r", "\n", "\0")])
    return ~special & (F.length(record) - F.length(F.replace(record, F.lit(CSV_SEP), F.lit(""))) < most)


def _as_line(cells: list[str]) -> Column:
    """Cells written as a record again."""
    def text(name: str) -> Column:
        cell = F.coalesce(F.col(name), F.lit(""))
        return F.when(cell.rlike(r'[|"\r\n]'), F.concat(F.lit('"'), F.replace(cell, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(cell)

    return F.concat_ws(CSV_SEP, *[text(c) for c in cells])


def _clean(df: DataFrame) -> DataFrame:
    """Missing tokens to null (on the raw text), then strip every text cell."""
    kept = [c for c in df.columns if c in (INGEST_COL, REJECT_COL)]
    names = [c for c in df.columns if c not in kept]
    # one expression over an array: written out for every column, the code of a row is too long for the JVM to compile
    cells = F.transform(F.array(*[F.col(f"`{c}`") for c in names]), lambda cell: strip_all(null_tokens(cell)))
    clean = df.select(*kept, cells.alias("_cells"))
    return clean.select(*[F.get("_cells", F.lit(k)).alias(c) for k, c in enumerate(names)], *kept)


def read_delimited(spark: SparkSession, paths: list[str], multi_line: bool = True) -> DataFrame:
    """S2 core: all rows of the files under ``paths``, columns united by name, with ``_ingest`` and ``_reject``.

    ``multi_line=False`` takes the files as known to have no line breaks in
    quoted cells.
    """
    if not paths:
        raise FileNotFoundError("no input files")
    catalogue = records.catalogue(spark, paths, CSV_SEP, CSV_QUOTE, scratch_path(spark, "catalogue"))
    if not catalogue.headers:
        raise ValueError(f"no header in {', '.join(paths[:5])}")
    if catalogue.n_files > MAX_FILES:
        raise ValueError(f"{catalogue.n_files} files are more than {MAX_FILES}; merge small ones first")
    names = [header_names(h) for h in catalogue.headers]
    cells = [f"_c{k}" for k in range(max(map(len, names)) + 1)]  # one more than any header has
    schema = ", ".join(f"{c} string" for c in [*cells, "_raw"])
    if multi_line and catalogue.multi_line:
        whole = records.assembled(spark, paths, catalogue, CSV_SEP, CSV_QUOTE)
        record = F.col("record")
        whole = whole.withColumn("record", F.when(record.contains("\r"), F.regexp_replace(record, "\r$", "")).otherwise(record)).where(F.trim("record") != "")
        # a record of plain cells, none too many, is cut at its separators; the parser makes an error of each row that has fewer cells than the schema
        parts = whole.select(*records.PLACE, "record", F.when(_is_plain(record, len(cells)), F.split(record, rf"\{CSV_SEP}", -1)).alias("parts"))
        parsed = F.when(F.col("parts").isNull(), F.from_csv("record", F.lit(schema), {**_CSV, "multiLine": "true"}))
        parts = parts.select(*records.PLACE, "record", "parts", parsed.alias("x"))
        cell = lambda k, c: F.when(F.col("parts").isNotNull(), F.nullif(F.get("parts", F.lit(k)), F.lit(""))).otherwise(F.col(f"x.{c}"))
        rows = parts.select(*records.PLACE, "record", *[cell(k, c).alias(c) for k, c in enumerate(cells)], "x._raw")
        line = F.col("record")
    else:
        # all cells are parsed for each row, as the parser can't tell a surplus among chosen ones
        rows = spark.read.options(header=True, columnPruning=False, **_CSV).schema(schema).csv(paths).select(*cells, "_raw", *records.place())
        line = F.coalesce("_raw", _as_line(cells))  # the parser hands out a line only if its cells don't fit the schema
    # which header a file has: one small row for each file
    rows = rows.join(F.broadcast(catalogue.files()), "file_key", "left") if len(names) > 1 else rows.withColumn("header_no", F.lit(0))
    surplus = F.lit(False)
    for k, own in enumerate(names):
        beyond = F.coalesce(F.col("_raw").isNotNull() & _text_beyond(F.col("_raw"), F.lit(len(own))), F.lit(False))
        for c in cells[len(own) :]:
            beyond = beyond | (F.coalesce(F.col(c), F.lit("")) != "")
        surplus = surplus | ((F.col("header_no") == k) & beyond)
    united = []
    for name in dict.fromkeys(n for own in names for n in own):
        at = [own.index(name) if name in own else None for own in names]
        if len(set(at)) == 1:
            cell = F.col(cells[at[0]])
        else:
            cell = F.coalesce(*[F.when(F.col("header_no") == k, F.col(cells[i])) for k, i in enumerate(at) if i is not None])
        united.append(cell.alias(name))
    ingest = F.struct(F.col("file"), F.col("block"), F.col("pos"))
    return _clean(rows.select(*united, ingest.alias(INGEST_COL), F.when(surplus, line).alias(REJECT_COL)))


def accepted(rows: DataFrame) -> DataFrame:
    """The rows that aren't rejects."""
    return rows.where(F.col(REJECT_COL).isNull()).drop(REJECT_COL)


def rejected(rows: DataFrame) -> DataFrame:
    """(file, record) of the rejects."""
    return rows.where(F.col(REJECT_COL).isNotNull()).select(F.col(f"{INGEST_COL}.file").alias("file"), F.col(REJECT_COL).alias("record"))


def _strict(rows: DataFrame) -> DataFrame:
    """The rows; a reject fails the read, naming its file."""
    fault = F.raise_error(F.concat(F.lit("more cells than the header in "), F.col(f"{INGEST_COL}.file")))
    return rows.where(F.when(F.col(REJECT_COL).isNull(), F.lit(True)).otherwise(fault.cast("boolean"))).drop(REJECT_COL)


def extract_employees(
    spark: SparkSession, raw_dir: str, pattern: str = EMPLOYEE_GLOB, multi_line: bool = True,
    several: str = "error", keep_rejects: bool = False,
) -> DataFrame:
    """The matching employee file; an error if there is none.

    ``several`` says what to do if more than one file matches: ``error``, ``first``
    (by name) or ``all``. With ``keep_rejects`` the rejects are returned in
    ``_reject``, else a reject fails the read.
    """
    entries = list_entries(spark, raw_dir, pattern)
    if not entries:
        raise FileNotFoundError(f"no {pattern} in {raw_dir}")
    if len(entries) > 1 and several not in ("first", "all"):
        raise ValueError(f"several employee files match ({', '.join(entries[:5])}): choose several='first' or 'all'")
    rows = read_delimited(spark, entries if several == "all" else entries[:1], multi_line)
    return rows if keep_rejects else _strict(rows)


def extract_timesheets(
    spark: SparkSession, raw_dir: str, pattern: str = TIMESHEET_GLOB, multi_line: bool = True, keep_rejects: bool = False
) -> DataFrame:
    """Every matching timesheet file in path order, united by column name."""
    glob = f"{raw_dir.rstrip('/')}/{pattern}"
    try:
        rows = read_delimited(spark, [glob], multi_line)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no {pattern} in {raw_dir}") from error
    return rows if keep_rejects else _strict(rows)


def load_bronze(emp: DataFrame, ts: DataFrame, lake: Lake) -> dict[str, str]:
    """Both bronze tables (text cells, ingest order, rejects included), made current together."""
    commit = lake.commit(emp.sparkSession)
    paths = commit.write_all({f"bronze/{name}": df for name, df in (("bronze_employees", emp), ("bronze_timesheets", ts))})
    commit.publish()
    return {table.split("/")[1]: path for table, path in paths.items()}
