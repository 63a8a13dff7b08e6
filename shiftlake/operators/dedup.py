"""Keep-first de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """One row per key: the row with the smallest ``order_col`` (first in file order).

    Null keys form one group, as in a pandas ``drop_duplicates``. Written as
    ``row_number() == 1`` so Spark plans a *partial* group limit before the
    shuffle (each input split keeps one row per key) and a final one after
    it: a key holding a large share of the rows reaches the shuffle as one row
    per split, not as all its rows in one task.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(order_col).asc_nulls_last())
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
