"""Dense surrogate keys in key order, without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BLOCK_BITS = 20


def surrogate_keys(
    df: DataFrame,
    key: str,
    name: str = "productsk",
    after: Column | int = 0,
) -> DataFrame:
    """Add ``name`` = ``after`` + rank of the unique BIGINT ``key`` (1, 2, 3, ...).

    Rows are numbered inside blocks of 2**20 consecutive key values, so no window group
    can exceed 2**20 rows.  Block offsets are prefix sums over block counts, taken in two
    steps in the same way.  All of it is a function of the data alone: recomputing a lost
    partition gives the same keys.
    """
    start = F.lit(after) if isinstance(after, int) else after
    block = F.shiftright(F.col(key), _BLOCK_BITS)
    zone = F.shiftright(F.col("_block"), _BLOCK_BITS)
    counts = df.groupBy(block.alias("_block")).agg(F.count(F.lit(1)).alias("_n"))
    in_zone = counts.withColumn("_zone", zone)
    before = Window.orderBy("_zone").rowsBetween(Window.unboundedPreceding, -1)
    # At most 2**24 zones exist for 64-bit keys; keys below 2**40 all share one.
    zone_base = (
        in_zone.groupBy("_zone")
        .agg(F.sum("_n").alias("_zone_n"))
        .select("_zone", F.coalesce(F.sum("_zone_n").over(before), F.lit(0)).alias("_zone_base"))
    )
    earlier = (
        Window.partitionBy("_zone").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        in_zone.withColumn("_in_zone", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .join(zone_base, "_zone")
        .select("_block", (F.col("_in_zone") + F.col("_zone_base")).alias("_offset"))
    )
    numbered = df.withColumn("_block", block).withColumn(
        "_rank", F.row_number().over(Window.partitionBy("_block").orderBy(key))
    )
    return numbered.join(offsets, "_block").select(
        (F.col("_rank") + F.col("_offset") + start).cast("bigint").alias(name), *df.columns
    )
