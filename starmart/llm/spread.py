"""Joining rows to a table of keys where some keys are hot: their rows are dealt to several tasks.

A key with more rows than its share is cut into slices by a hash of the row's own id, and the table repeats that key once
for each slice. The share is one SHARES-th of all rows, so at most SHARES keys can be hot whatever the size of
the data: that many rows are broadcast, and no task gets more than a share of one key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most keys that can be hot, and so the most rows that are broadcast.
SHARES = 20_000
#: Rows of one key that are never worth a slice of their own.
LEAST_SHARE = 1_000


def spread_join(rows: DataFrame, table: DataFrame, keys: list[str], count: str, spread_by: str, how: str = "inner") -> DataFrame:
    """`rows` joined to `table` (one row per key) on `keys`; `count` in `table` says how many of `rows` have the key, `spread_by` is
    the column of `rows` whose hash picks the slice. `table` is read twice: write it down first."""
    total = table.agg(F.sum(count)).first()[0] or 0
    share = max(LEAST_SHARE, -(-total // SHARES))
    slices = F.ceil(F.col(count) / share).cast("int")
    hot = F.broadcast(table.where(F.col(count) > share).select(*keys, slices.alias("_slices")))
    of = F.coalesce("_slices", F.lit(1))
    dealt = rows.join(hot, keys, "left").withColumn("_slice", F.expr(f"pmod(xxhash64({spread_by}), coalesce(_slices, 1))").cast("int")).drop("_slices")
    copies = table.withColumn("_slices", F.when(F.col(count) > share, slices)).withColumn("_slice", F.explode(F.sequence(F.lit(0), of - 1))).drop("_slices", count)
    return dealt.join(copies, [*keys, "_slice"], how).drop("_slice")
