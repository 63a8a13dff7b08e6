"""Lake layout: one folder per layer and table, whose versions are named by manifests."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftlake.sources import versions
from shiftlake.sources.versions import latest


@dataclass(frozen=True)
class Lake:
    root: str

    @property
    def base(self) -> str:
        return self.root.rstrip("/")

    def path(self, spark: SparkSession, layer: str, name: str) -> str:
        """Folder of the table's current version."""
        folder = latest(spark, self.base).tables.get(f"{layer}/{name}")
        if folder is None:
            raise FileNotFoundError(f"no table {layer}/{name} in {self.root}")
        return f"{self.base}/{folder}"

    def read(self, spark: SparkSession, layer: str, name: str) -> DataFrame:
        return spark.read.parquet(self.path(spark, layer, name))

    def has(self, spark: SparkSession, layer: str, name: str) -> bool:
        return f"{layer}/{name}" in latest(spark, self.base).tables

    def commit(self, spark: SparkSession, label: str | None = None) -> versions.Commit:
        return versions.Commit(spark, self.base, label)


DATE, ID = "punch_apply_date", "client_employee_id"
TIMESHEETS, INDEX = "silver/silver_timesheets", "silver/silver_timesheets_files"
#: Files that a read names one by one; beyond it the whole table is read, and row-group statistics skip what they can.
MAX_NAMED_FILES = 10_000


def by_date(ts: DataFrame, clustered: bool = False) -> DataFrame:
    """Timesheets as silver is written, each file sorted by apply date.

    As the de-duplication left them partitioned: row-group statistics then skip
    most of a file for a date-range read. ``clustered`` deals them out by ranges of (date, id) first, at the cost of one
    more shuffle of the table, so that a file holds a few days only.
    """
    keys = [F.col(DATE).asc_nulls_last(), F.col(ID).asc_nulls_last()]
    if clustered:
        ts = ts.repartitionByRange(int(ts.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
    return ts.sortWithinPartitions(*keys)


def file_index(spark: SparkSession, path: str) -> DataFrame:
    """(file, rows, first and last date and id) of every file of a timesheet version."""
    rows = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), DATE, ID)
    return rows.groupBy("file").agg(
        F.count(F.lit(1)).alias("rows"), F.min(DATE).alias("first_date"), F.max(DATE).alias("last_date"), F.min(ID).alias("first_id"), F.max(ID).alias("last_id")
    )


def write_silver(spark: SparkSession, lake: Lake, emp: DataFrame, ts: DataFrame, clustered: bool = False) -> dict[str, str]:
    """Both silver tables, made current together; with ``clustered`` also the index of the timesheet files."""
    commit = lake.commit(spark)
    paths = commit.write_all({"silver/silver_employees": emp, TIMESHEETS: by_date(ts, clustered)})
    if clustered:
        commit.write(INDEX, file_index(spark, paths[TIMESHEETS]))
    else:
        commit.drop(INDEX)
    commit.publish()
    return {table.split("/")[1]: path for table, path in paths.items()}


def read_timesheets_between(spark: SparkSession, lake: Lake, start: dt.datetime | None = None, end: dt.datetime | None = None) -> DataFrame:
    """Silver timesheets from files that may hold apply dates from ``start`` to ``end``; others aren't opened.

    The rows themselves aren't filtered (``plans.serving.timesheets`` does that). Without
    an index, or without a bound, all files are read.
    """
    tables = latest(spark, lake.base).tables
    whole = spark.read.parquet(f"{lake.base}/{tables[TIMESHEETS]}")
    if INDEX not in tables or (start is None and end is None):
        return whole
    index = spark.read.parquet(f"{lake.base}/{tables[INDEX]}")
    if start is not None:
        index = index.where(F.col("last_date") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        index = index.where(F.col("first_date") <= F.lit(end).cast("timestamp_ntz"))
    files = [r.file for r in index.select("file").limit(MAX_NAMED_FILES + 1).collect()]
    if len(files) > MAX_NAMED_FILES:
        return whole
    return spark.read.schema(whole.schema).parquet(*files) if files else whole.limit(0)


def read_silver_timesheets(spark: SparkSession, lake: Lake) -> DataFrame:
    return lake.read(spark, *TIMESHEETS.split("/"))


def replace_table(df: DataFrame, lake: Lake, layer: str, name: str) -> str:
    """Commit a new version of one table; the frame may read the version it replaces."""
    commit = lake.commit(df.sparkSession)
    path = commit.write(f"{layer}/{name}", df)
    commit.publish()
    return path


def row_count(spark: SparkSession, path: str) -> int:
    """Rows of a written version (from the files' footers)."""
    return spark.read.parquet(path).select(F.count("*")).first()[0]
