"""One row per key by a stated order.

``row_number() = 1`` is planned by Spark with a group limit before the shuffle: each map
task keeps one row per key, so a key holding a large part of the table reaches the reducer
as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key.  ``order`` should leave no ties but identical rows."""
    keys = [key] if isinstance(key, str) else list(key)
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rn") == 1).drop("_rn")


def latest_per_key(df: DataFrame, key: str | Sequence[str], by: Sequence[str]) -> DataFrame:
    """Keep the newest row of each key by ``by`` descending, then by every other column."""
    rest = [c for c in df.columns if c not in by]
    order = [F.col(c).desc_nulls_last() for c in by] + [F.col(c).asc_nulls_last() for c in rest]
    return first_per_key(df, key, order)
