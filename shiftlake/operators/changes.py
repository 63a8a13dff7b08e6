"""Batch row changes to the silver employee table (M1-M4).

A change table has columns ``(op, client_employee_id, first_name, last_name,
department_name, hire_date, seq)`` with ``op`` in insert / update / delete.
A batch has the effect of its changes applied one after another: by ``seq``
(a missing one first), then delete before insert before update, then by the
values. ``plans/job.apply_changes`` writes the result as a new version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftlake.operators.silver import with_is_active, with_tenure_days
from shiftlake.params import DEFAULT, Params
from shiftlake.session import checkpoint_root

ID = "client_employee_id"
UPDATABLE = ("first_name", "last_name", "department_name")
CHANGE_SCHEMA = (
    "op string, client_employee_id bigint, first_name string, last_name string, "
    "department_name string, hire_date timestamp_ntz, seq bigint"
)


def _ids(df: DataFrame) -> DataFrame:
    return df.select(ID).where(F.col(ID).isNotNull()).distinct()


def insert(silver: DataFrame, changes: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """M1: append the inserted employees (five fields, the rest null); no uniqueness
    check. The hire date is stored as ``hire_date`` and the derived columns are
    computed for the new rows."""
    return silver.unionByName(_inserted(changes, params).drop("_born"), allowMissingColumns=True)


def reduce_or(conds):
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def _updates(changes: DataFrame) -> DataFrame:
    """Updates that set at least one field (an empty update is rejected)."""
    return changes.where((F.col("op") == "update") & reduce_or([F.col(c).isNotNull() for c in UPDATABLE]))


def _place() -> Column:
    """A change's place in the replay order, as one comparable value."""
    return F.struct("seq", "op", "first_name", "last_name", "department_name", "hire_date")


def _summary(changes: DataFrame) -> DataFrame:
    """Per id: the last delete's place, and for each field the last value set, with its place.

    Aggregates that are combined map-side, so an id changed very often costs
    no single large task.
    """
    place = _place()
    is_update = F.col("op") == "update"
    return changes.where(F.col(ID).isNotNull()).groupBy(F.col(ID).alias("_id")).agg(
        F.max(F.when(F.col("op") == "delete", place)).alias("_deleted"),
        *[F.max(F.when(is_update & F.col(c).isNotNull(), F.struct(place.alias("at"), F.col(c).alias("v")))).alias(f"_set_{c}") for c in UPDATABLE],
    )


def update(silver: DataFrame, changes: DataFrame) -> DataFrame:
    """M2: every field as the last update that sets it left it, for existing ids.

    The batch is cut to one row per id and joins by hash, as its size follows
    the batch.
    """
    joined = silver.join(_summary(_updates(changes)), F.col(ID) == F.col("_id"), "left")
    return joined.select(*[F.coalesce(F.col(f"_set_{c}.v"), F.col(c)).alias(c) if c in UPDATABLE else F.col(c) for c in silver.columns])


def delete(silver: DataFrame, changes: DataFrame) -> DataFrame:
    """M3: remove the rows of deleted ids."""
    dels = _ids(changes.where(F.col("op") == "delete"))
    return silver.join(dels, ID, "left_anti")


def rejects(silver: DataFrame, changes: DataFrame) -> DataFrame:
    """Changes that cannot apply: an update or delete of an id that does not exist
    at its turn, or an update with no field (the 404 / 400 answers of a
    row-at-a-time service).

    Whether an id exists is a scan over its changes in order. The changes are
    range-split on (id, place), so one id may fill many tasks; each part's last delete and insert of an
    id go to the later parts.
    """
    checkpoint_root(silver.sparkSession)
    parts = int(silver.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    op_at = lambda op: F.max(F.when(F.col("op") == op, F.col("_at")))
    # the split is sampled, so it is checkpointed: what is carried over a border must belong to it
    placed = changes.withColumn("_at", _place()).repartitionByRange(parts, ID, "_at").withColumn("_part", F.spark_partition_id()).checkpoint()
    # the last delete and insert of an id in each part, carried over to the later parts
    per_part = placed.where(F.col(ID).isNotNull()).groupBy("_part", ID).agg(op_at("delete").alias("_d"), op_at("insert").alias("_i"))
    earlier = Window.partitionBy(ID).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_part.select("_part", ID, F.max("_d").over(earlier).alias("_d"), F.max("_i").over(earlier).alias("_i"))
    before = Window.partitionBy("_part", ID).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    known = _ids(silver).withColumn("_known", F.lit(True))
    judged = placed.join(carried, ["_part", ID], "left")
    judged = judged.withColumn("_del", F.greatest("_d", op_at("delete").over(before))).withColumn("_ins", F.greatest("_i", op_at("insert").over(before)))
    judged = judged.join(known, ID, "left")
    there = F.when(F.col("_del").isNull(), F.col("_known").isNotNull() | F.col("_ins").isNotNull()).otherwise(
        F.col("_ins").isNotNull() & F.coalesce(F.col("_ins") > F.col("_del"), F.lit(False))
    ) & F.col(ID).isNotNull()
    empty = (F.col("op") == "update") & ~reduce_or([F.col(c).isNotNull() for c in UPDATABLE])
    reason = F.when(~there, "not found").when(empty, "no fields to update")
    out = judged.where(F.col("op").isin("update", "delete")).withColumn("reason", reason).where(F.col("reason").isNotNull())
    return out.select(*changes.columns, "reason")


def _inserted(changes: DataFrame, params: Params) -> DataFrame:
    """The inserted rows (the fields a change has, derived columns, the rest missing) with their places."""
    rows = changes.where(F.col("op") == "insert").select(
        ID, "first_name", "last_name", "department_name", F.col("hire_date").cast("timestamp_ntz").alias("hire_date"), _place().alias("_born")
    )
    rows = rows.withColumn("term_date", F.lit(None).cast("timestamp_ntz"))
    return with_tenure_days(with_is_active(rows), params)


def apply(silver: DataFrame, changes: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """M4: the whole batch in order. A row that exists from the start lives on if
    its id is never deleted, an inserted one if its id isn't deleted later; of
    the fields set, those count that were set after the row's insert."""
    per_id = _summary(changes)
    new = _inserted(changes, params)
    rows = silver.withColumn("_born", F.lit(None).cast(new.schema["_born"].dataType)).unionByName(new, allowMissingColumns=True)
    joined = rows.join(per_id, F.col(ID) == F.col("_id"), "left")
    later = lambda at: at.isNotNull() & (F.col("_born").isNull() | (at > F.col("_born")))
    alive = joined.where(~F.coalesce(later(F.col("_deleted")), F.lit(False)))
    return alive.select(*[
        F.when(later(F.col(f"_set_{c}.at")), F.col(f"_set_{c}.v")).otherwise(F.col(c)).alias(c) if c in UPDATABLE else F.col(c) for c in silver.columns
    ])
