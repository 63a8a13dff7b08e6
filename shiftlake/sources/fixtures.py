"""Driver test tables mapped to the raw employee and timesheet shapes.

Fixed mapping (equal in the SQL oracle):

employees, one row per customer that has orders; ``h`` = first order date
  client_employee_id = c_custkey
  first_name = 'Customer', last_name = c_name
  department_name = c_mktsegment, null where c_nationkey = 0
  hire_date = h
  term_date = h + ((c_custkey * 37) % 360) days where c_acctbal < 2000, else null

timesheets, one row per lineitem joined to its order
  client_employee_id = o_custkey
  punch_apply_date = o_orderdate, null where l_partkey % 500 = 0
  scheduled_start_datetime = o_orderdate + 9 hours
  punch_in_datetime = scheduled start + round(l_discount * 100) minutes
  scheduled_end_datetime = o_orderdate + 17 hours
  punch_out_datetime = scheduled end - round(l_tax * 100) minutes, null where l_linenumber = 7
  hours_worked = l_quantity / 4.0, null where l_linenumber = 6 and l_returnflag = 'R'
  ingest order = (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftlake.params import INGEST_COL


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def employees_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders")
    # partial aggregation collapses orders to one row per customer before the shuffle
    first_order = orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("h"))
    offset_days = ((F.col("c_custkey") * 37) % 360).cast("int")
    return (
        customer.join(first_order, customer.c_custkey == first_order.o_custkey, "inner")
        .select(
            F.col("c_custkey").alias("client_employee_id"),
            F.lit("Customer").alias("first_name"),
            F.col("c_name").alias("last_name"),
            F.when(F.col("c_nationkey") != 0, F.col("c_mktsegment")).alias("department_name"),
            F.col("h").alias("hire_date"),
            F.when(F.col("c_acctbal") < 2000, F.col("h") + F.make_dt_interval(offset_days)).alias("term_date"),
            # a single-file source: the key is the file order
            F.struct(F.col("c_custkey").alias("k")).alias(INGEST_COL),
        )
    )


def employees_untidy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Employees as untidy text: later duplicates, dates that can't be read or lie out of range, blanks, missing tokens.

      every fifth id again, later in the file, with another last name
      hire_date month first with slashes; ISO where id % 7 = 3, year 9999 where id % 7 = 4
      term_date as 'yyyy-MM-dd'; 'unknown' where id % 11 = 5
      first_name by id % 4: 'NA', ' NA ', a tab and a no-break space around a name, three blanks
    """
    emp = employees_raw(spark, sf_dir)
    own = F.col("client_employee_id")
    hire, term = (F.date_format(c, f) for c, f in (("hire_date", "MM/dd/yyyy"), ("term_date", "yyyy-MM-dd")))
    hire = F.when(own % 7 == 3, F.date_format("hire_date", "yyyy-MM-dd")).when(own % 7 == 4, "01/31/9999").otherwise(hire)
    # the first row of the file settles each column's format
    first = F.struct(F.lit(-1).cast("bigint").alias("k"))
    row = [own, F.array(F.lit("NA"), F.lit(" NA "), F.lit("\tAnn\u00a0"), F.lit("   "))[(own % 4).cast("int")].alias("first_name"), F.col("last_name"), F.col("department_name"),
           hire.alias("hire_date"), F.when((own % 11 == 5) & term.isNotNull(), "unknown").otherwise(term).alias("term_date")]
    tidy = emp.select(*row, F.struct(own.cast("bigint").alias("k")).alias(INGEST_COL))
    again = tidy.where(own % 5 == 0).withColumn("last_name", F.lit("Later")).withColumn(INGEST_COL, F.struct((own + 10_000_000_000).alias("k")))
    head = spark.range(1).select(F.lit(-1).cast("bigint").alias("client_employee_id"), *[F.lit(v).alias(c) for c, v in (
        ("first_name", "First"), ("last_name", "Row"), ("department_name", None), ("hire_date", "12/31/1999"), ("term_date", "2000-01-31"))], first.alias(INGEST_COL))
    return tidy.unionByName(again).unionByName(head.select(*[F.col(c).cast(t).alias(c) if c != INGEST_COL else F.col(c) for c, t in tidy.dtypes]))


def _spread(df: DataFrame, key: str) -> DataFrame:
    """The driver writes each table as one file with one row group, which Spark
    reads in a single task. Hash-spread such a table once before the per-row
    work; a join on the key needs no further shuffle of it, and the parts follow its size, not the number of
    cores. Inputs made of many files are left as they are."""
    if len(df.inputFiles()) > 1:
        return df
    return df.repartition(key)


def timesheets_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = _spread(table(spark, sf_dir, "lineitem"), "l_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    day = F.col("o_orderdate")
    start = day + F.make_dt_interval(F.lit(0), F.lit(9))
    end = day + F.make_dt_interval(F.lit(0), F.lit(17))
    late_min = F.round(F.col("l_discount") * 100).cast("int")
    early_min = F.round(F.col("l_tax") * 100).cast("int")
    return lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey, "inner").select(
        F.col("o_custkey").alias("client_employee_id"),
        F.when(F.col("l_partkey") % 500 != 0, day).alias("punch_apply_date"),
        (start + F.make_dt_interval(F.lit(0), F.lit(0), late_min)).alias("punch_in_datetime"),
        F.when(F.col("l_linenumber") != 7, end - F.make_dt_interval(F.lit(0), F.lit(0), early_min)).alias(
            "punch_out_datetime"
        ),
        start.alias("scheduled_start_datetime"),
        end.alias("scheduled_end_datetime"),
        F.when(
            ~((F.col("l_linenumber") == 6) & (F.col("l_returnflag") == "R")), F.col("l_quantity") / 4.0
        ).alias("hours_worked"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias(INGEST_COL),
    )
