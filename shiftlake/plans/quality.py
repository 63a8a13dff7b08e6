"""Data-quality counts over the silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ID = "client_employee_id"


def row_counts(emp: DataFrame, ts: DataFrame) -> DataFrame:
    """Long table ``(table_name, metric, value)``: row counts plus null, duplicate
    and orphan counts. One aggregate per table; the timesheet counts are taken
    per id before they meet the distinct employee ids."""
    e = emp.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col(ID).isNull()).alias("null_id"),
        (F.count(ID) - F.count_distinct(ID)).alias("duplicate_id"),
        F.count_if(F.col("hire_date").isNull()).alias("null_hire_date"),
        F.count_if(F.col("is_active") == 1).alias("active"),
    ).select(
        F.expr(
            "stack(5, 'rows', rows, 'null_id', null_id, 'duplicate_id', duplicate_id, "
            "'null_hire_date', null_hire_date, 'active', active) as (metric, value)"
        )
    ).select(F.lit("silver_employees").alias("table_name"), "metric", "value")

    # per-id counts first (combined map-side): the join to the employee ids then
    # sees one row per id, however many punches one id has
    per_id = ts.groupBy(ID).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("punch_apply_date").isNull()).alias("n_null_date"),
        F.count_if(F.col("hours_worked").isNull()).alias("n_null_hours"),
    )
    known = emp.where(F.col(ID).isNotNull()).select(ID).distinct().withColumn("_known", F.lit(True))
    def total(c):
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    t = per_id.join(known, ID, "left").agg(
        total("n").alias("rows"),
        total(F.when(F.col(ID).isNull(), F.col("n")).otherwise(0)).alias("null_id"),
        total(F.when(F.col(ID).isNotNull() & F.col("_known").isNull(), F.col("n")).otherwise(0)).alias("orphan_id"),
        total("n_null_date").alias("null_apply_date"),
        total("n_null_hours").alias("null_hours"),
    ).select(
        F.expr(
            "stack(5, 'rows', rows, 'null_id', null_id, 'orphan_id', orphan_id, "
            "'null_apply_date', null_apply_date, 'null_hours', null_hours) as (metric, value)"
        )
    ).select(F.lit("silver_timesheets").alias("table_name"), "metric", "value")
    return e.unionByName(t)


def reject_counts(rejects: DataFrame) -> DataFrame:
    """The rejected raw rows of each bronze table, in the shape of ``row_counts``."""
    n = rejects.groupBy("table_name").agg(F.count("*").alias("n"))
    both = rejects.sparkSession.createDataFrame([("bronze_employees",), ("bronze_timesheets",)], "table_name string")
    return both.join(n, "table_name", "left").select("table_name", F.lit("rejected_rows").alias("metric"), F.coalesce("n", F.lit(0)).cast("bigint").alias("value"))


def loss_counts(spark: SparkSession, seen: dict[str, dict[str, int]]) -> DataFrame:
    """Values lost when silver was typed, as observed while it was written: table -> metrics; in the shape of ``row_counts``."""
    rows = [(table, metric, value) for table, metrics in seen.items() for metric, value in metrics.items() if metric.startswith("lost_")]
    return spark.createDataFrame(rows, "table_name string, metric string, value bigint")
