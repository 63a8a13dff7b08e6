"""Rolling average of hours over the previous N rows of each employee.

Row order inside an employee: apply date ascending (nulls last), then
punch-in time, then ingest order, so that several punches on one day have a
fixed order. Result order for the top-k report: apply date descending (nulls
last), employee id, punch-in, ingest order.
"""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shiftlake.functions.exprs import round_half_away
from shiftlake.params import INGEST_COL
from shiftlake.session import checkpoint_root

ID = "client_employee_id"
DATE = "punch_apply_date"
PIN = "punch_in_datetime"


def window_order() -> list[Column]:
    return [F.col(DATE).asc_nulls_last(), F.col(PIN).asc_nulls_last(), F.col(INGEST_COL).asc_nulls_last()]


def report_order() -> list[Column]:
    return [
        F.col(DATE).desc_nulls_last(),
        F.col(ID).asc_nulls_last(),
        F.col(PIN).asc_nulls_last(),
        F.col(INGEST_COL).asc_nulls_last(),
    ]


def rolling_window(rows: int) -> Window:
    return Window.partitionBy(ID).orderBy(*window_order()).rowsBetween(-(rows - 1), 0)


def rolling_all(ts: DataFrame, rows: int = 30, digits: int | None = None, out: str = "rolling_30day_avg") -> DataFrame:
    """Every row with its rolling average (one shuffle by employee + sort)."""
    avg = F.avg("hours_worked").over(rolling_window(rows))
    if digits is not None:
        avg = round_half_away(avg, digits)
    return ts.select(ID, DATE, PIN, INGEST_COL, avg.alias(out))


def _wkey() -> Column:
    """Window order as one comparable value."""
    return F.struct(
        F.col(DATE).isNull().alias("dn"), F.col(DATE).alias("d"),
        F.col(PIN).isNull().alias("pn"), F.col(PIN).alias("p"), F.col(INGEST_COL).alias("i"),
    )


#: Rows drawn to find a bound of the first k rows.
SAMPLE = 20_000


def first_rows(rows: DataFrame, key: Column, k: int, n: int) -> DataFrame:
    """Rows that hold the first ``k`` of the ``n`` rows in the order of ``key``, and few others.

    Selection by rounds: in a sample of at most about SAMPLE rows, the one whose
    rank stands for twice k (or a hundredth of the rows, if that is more) bounds
    the next round. Each bound is counted before it is used, so the result always holds the first k
    rows; a round that doesn't cut ends the search (equal keys, or an unlucky draw).
    """
    spark, held = rows.sparkSession, rows.withColumn("_key", key)
    kept, seed = held, 0
    while n > 4 * k:
        share = min(1.0, SAMPLE / n)
        rank = max(1, math.ceil(max(2 * k, n / 100) * share))
        drawn = kept.where(F.rand(seed) < share).select("_key").orderBy("_key").limit(rank).agg(F.max("_key").alias("_key"))
        bound = spark.createDataFrame(drawn.collect(), drawn.schema).scalar()
        fewer = held.where(F.col("_key") <= bound)
        m = fewer.count()
        if not k <= m < n:
            break
        kept, n, seed = fewer, m, seed + 1
    return kept.drop("_key")


def _report_key() -> Column:
    """Report order as one comparable value (later dates first)."""
    back = F.timestamp_diff("MICROSECOND", F.col(DATE).cast("timestamp_ntz"), F.lit(dt.datetime(1970, 1, 1)).cast("timestamp_ntz"))
    return F.struct(
        F.col(DATE).isNull().alias("dn"), back.alias("d"), F.col(ID).isNull().alias("en"), F.col(ID).alias("e"),
        F.col(PIN).isNull().alias("pn"), F.col(PIN).alias("p"), F.col(INGEST_COL).alias("i"),
    )


def rolling_top(ts: DataFrame, limit: int, rows: int = 30, digits: int = 2, out: str = "rolling_30day_avg") -> DataFrame:
    """The first ``limit`` rows in report order with their rolling averages.

    Only these rows are reported, so the window runs only over the rows they
    need: the selected rows and, per selected employee, the ``rows - 1``
    predecessors of its earliest selected row.

    1. rows per day (one small aggregate, run when the query is built) give the
       cut-off: the latest day from which on there are ``limit`` rows. If that day
       holds many rows, ``first_rows`` bounds them, so that only a few times ``limit`` rows are
       ordered for the top-k (the date filter reaches the Parquet scan);
    2. per selected employee (at most ``limit`` ids) the earliest and latest
       selected position and the ``rows - 1`` predecessors of the earliest (a
       per-employee top-k, limited map-side);
    3. the window over those candidate rows (between both positions, and the
       predecessors), then the same top-k.
    """
    base = ts.select(ID, DATE, PIN, INGEST_COL, "hours_worked").withColumn("_w", _wkey())
    days = ts.where(F.col(DATE).isNotNull()).groupBy(F.col(DATE).cast("date").alias("day")).count()
    from_day = F.sum("count").over(Window.orderBy(F.col("day").desc()))  # as many rows as days
    cut = days.withColumn("rows", from_day).where(F.col("rows") >= limit).agg(F.max("day").alias("day"), F.min("rows").alias("rows")).first()
    if cut.day is None:  # undated rows are wanted only if there are fewer dated ones
        late, n = base, base.count()
    else:
        late, n = base.where(F.col(DATE) >= F.lit(cut.day).cast(ts.schema[DATE].dataType)), cut.rows
    late = first_rows(late, _report_key(), limit, n)
    top = late.select(ID, DATE, PIN, INGEST_COL, "_w").orderBy(*report_order()).limit(limit)
    # null ids are an employee too, hence the null-safe joins
    first_sel = F.broadcast(  # at most ``limit`` rows, as are the bounds below
        top.groupBy(F.col(ID).alias("_sid")).agg(F.min("_w").alias("_first"), F.max("_w").alias("_last")))
    same_emp = F.col(ID).eqNullSafe(F.col("_sid"))

    # the rows - 1 rows just before each employee's earliest selected row: a
    # per-employee top-k, which Spark cuts map-side (partial group limit) before
    # the shuffle, so even a very large employee sends only rows - 1 rows per split
    older = base.join(first_sel, same_emp, "inner").where(F.col("_w") < F.col("_first")).select(ID, "_w")
    back = Window.partitionBy(ID).orderBy(F.col("_w").desc())
    kept = older.withColumn("_rk", F.row_number().over(back)).where(F.col("_rk") <= rows - 1)
    needed_from = kept.groupBy(F.col(ID).alias("_nid")).agg(F.min("_w").alias("_from"))

    bounds = F.broadcast(first_sel.join(needed_from, F.col("_sid").eqNullSafe(F.col("_nid")), "left").select(
        "_sid", F.coalesce("_from", "_first").alias("_start"), "_last"
    ))
    cand = base.join(bounds, same_emp, "inner").where(F.col("_w").between(F.col("_start"), F.col("_last")))
    avg = round_half_away(F.avg("hours_worked").over(rolling_window(rows)), digits)
    scored = cand.select(ID, DATE, PIN, INGEST_COL, avg.alias(out))
    return scored.orderBy(*report_order()).limit(limit)


# --- all rows, safe against one employee holding a large share of the rows ----------


def _rolled(rows: int, names: list[str], schema: pa.Schema):
    """Averages of one task's part of the rows in the order (employee, date, ...).

    ``_cut`` marks the rows whose frame may begin in an earlier part (the first rows
    of the part's first employee), ``_tail`` the last rows of its last employee.
    """
    back = rows - 1

    def run(batches):
        part, n = TaskContext.get().partitionId(), 0
        held, first_run = np.empty(0), True  # hours of the current employee's last rows; the part's first employee
        seen, last = 0, None  # rows of the current employee so far; its id
        ready: list[pa.RecordBatch] = []
        tail_from = 0  # where the last employee's rows begin
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, many = batch.column(ID), batch.num_rows
            hours = batch.column("hours_worked").to_numpy(zero_copy_only=False).astype(float)
            codes = pc.fill_null(ids.dictionary_encode().indices, -1).to_numpy()
            new = np.concatenate(([n > 0 and ids[0] != last or n == 0], codes[1:] != codes[:-1]))
            starts = np.maximum.accumulate(np.where(new, np.arange(many), -1))
            place = np.where(starts >= 0, np.arange(many) - starts, np.arange(many) + seen)
            line = np.concatenate((held, hours))
            total, count = np.zeros(many), np.zeros(many, np.int64)
            for b in range(back, -1, -1):  # oldest first, as a running sum adds them
                at = np.arange(many) + len(held) - b
                value = line[np.maximum(at, 0)]
                used = (place >= b) & (at >= 0) & ~np.isnan(value)
                total += np.where(used, value, 0.0)
                count += used
            own = first_run & (np.cumsum(new) - (n == 0) == 0)
            with np.errstate(invalid="ignore"):
                average = pa.array(total / count, mask=count == 0)
            extra = [average, pa.array(np.full(many, part, np.int32)), pa.array(n + np.arange(many)), pa.array(own & (place < back))]
            ready.append(pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *extra, pa.array(np.zeros(many, bool))], schema=schema))
            first_run = bool(own[-1])
            if starts[-1] >= 0:
                tail_from = n + int(starts[-1])
            seen, last, n = int(place[-1]) + 1, ids[-1], n + many
            held = line[max(0, len(line) - min(back, seen)) :]
            while len(ready) > 1 and sum(r.num_rows for r in ready[1:]) >= back:
                yield ready.pop(0)
        tail_from = max(tail_from, n - back)
        for batch in ready:
            tail = pc.greater_equal(batch.column("_pos"), tail_from)
            yield batch.set_column(batch.num_columns - 1, "_tail", tail)

    return run


def rolling_all_balanced(ts: DataFrame, rows: int = 30, digits: int | None = None, out: str = "rolling_30day_avg", parts: int | None = None) -> DataFrame:
    """Every row with its rolling average (as ``rolling_all``), sorted by employee and window order,
    however many rows one employee has.

    One range exchange on (employee, window order) deals the rows out, so a large
    employee spreads over many tasks. A task averages its part in one pass. The rows whose frame reaches
    back over the part's start, and the last ``rows - 1`` rows of every part's last employee
    (together at most 2 * rows a part) are a small table of their own, in which a window gives
    the frames that cross borders, over as many parts as they need. The parts
    are checkpointed, as a range split is sampled and must stay the same for both.
    """
    checkpoint_root(ts.sparkSession)
    parts = parts or int(ts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [ID, DATE, PIN, INGEST_COL, "hours_worked"]
    base = ts.select(*names[:4], F.col("hours_worked").cast("double").alias("hours_worked"))
    key = [F.col(ID).asc_nulls_last(), *window_order()]
    ranged = base.repartitionByRange(parts, *key).sortWithinPartitions(*key)
    more = "_avg double, _part int, _pos long, _cut boolean, _tail boolean"
    schema = T.StructType([*base.schema.fields, *T.StructType.fromDDL(more).fields])
    rolled = ranged.mapInArrow(_rolled(rows, names, to_arrow_schema(schema)), schema).checkpoint()
    edges = rolled.where(F.col("_cut") | F.col("_tail"))
    crossing = edges.withColumn("_whole", F.avg("hours_worked").over(rolling_window(rows))).where("_cut")
    fixed = F.broadcast(crossing.select("_part", "_pos", "_whole"))  # fewer than ``rows`` rows a part
    average = F.when(F.col("_cut"), F.col("_whole")).otherwise(F.col("_avg"))
    if digits is not None:
        average = round_half_away(average, digits)
    return rolled.join(fixed, ["_part", "_pos"], "left").select(ID, DATE, PIN, INGEST_COL, average.alias(out))
