"""Lookup joins that stay fast when the looked-up table is large or one key is hot.

A lookup table goes out as a broadcast only after its rows were counted and found
within a bound.  Beyond the bound both sides are shuffled, and keys with many rows on the
probing side are split over several slices.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Most bytes of one broadcast, counted as rows times the width of a row.
BROADCAST_BYTES = 100_000_000
# Widths in a hash table: every row costs its header, texts are short names and keys.
_ROW_BYTES, _TEXT_BYTES = 32, 64
# Rows of one key that a single task should handle; more are split.
SLICE_ROWS = 5_000_000


def table_rows(tables: Mapping[str, DataFrame]) -> dict[str, int]:
    """Row counts of several tables in one job."""
    if not tables:
        return {}
    counts = None
    for name, df in tables.items():
        one = df.select(F.lit(name).alias("name")).groupBy("name").count()
        counts = one if counts is None else counts.unionByName(one)
    found = {r["name"]: r["count"] for r in counts.collect()}
    return {name: found.get(name, 0) for name in tables}


def row_bytes(df: DataFrame) -> int:
    """Width of a hashed row: eight bytes for a number or date, more for a text."""
    return _ROW_BYTES + sum(_TEXT_BYTES if f.dataType.typeName() in ("string", "binary") else 8 for f in df.schema)


def fits(df: DataFrame, rows: int, max_broadcast: int = BROADCAST_BYTES) -> bool:
    """May ``df`` of so many rows be broadcast?"""
    return rows * row_bytes(df) <= max_broadcast


def lookup(
    probe: DataFrame,
    table: DataFrame,
    key: str,
    table_key: str,
    rows: int,
    condition: Callable[[], Column] | None = None,
    how: str = "left",
    max_broadcast: int = BROADCAST_BYTES,
    slice_rows: int = SLICE_ROWS,
    key_source: DataFrame | None = None,
) -> DataFrame:
    """Join ``probe.key = table.table_key`` (and ``condition``), dropping ``table_key``.

    ``rows`` is the known row count of ``table``.  ``condition`` may refer to columns of
    both sides by name.  ``key_source`` is a cheaper frame with the same ``key`` values, such
    as ``probe`` before earlier lookups, for counting hot keys.
    """
    if fits(table, rows, max_broadcast):
        on = F.col(key) == F.col(table_key)
        if condition is not None:
            on = on & condition()
        return probe.join(F.broadcast(table), on, how).drop(table_key)
    hot = hot_keys(probe if key_source is None else key_source, key, slice_rows)
    return _sliced_join(probe, table, key, table_key, condition, how, hot)


def key_block(key: str) -> Column:
    """The block of 64 consecutive whole numbers that a key is in."""
    return F.shiftright(F.col(key).cast("bigint"), 6)


def _place(key: str) -> Column:
    return F.col(key).cast("bigint").bitwiseAND(F.lit(63)).cast("int")


def has_bit(key: str) -> Column:
    """Is the key among those of its block's ``_bits``?"""
    return F.call_function("shiftright", F.col("_bits"), _place(key)).bitwiseAND(F.lit(1)) == 1


def key_bits(table: DataFrame, key: str, max_broadcast: int = BROADCAST_BYTES) -> DataFrame | None:
    """The keys that a table has as ``(_block, _bits)``, a bit for each key of a block, if that may be broadcast.

    Blocks are counted first: keys that lie close need a row for up to 64 of them, keys far apart a row each, and nothing is gained.
    """
    if table.schema[key].dataType.typeName() not in ("long", "integer", "short", "byte"):
        return None
    bits = table.filter(F.col(key).isNotNull()).groupBy(key_block(key).alias("_block")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), _place(key))).alias("_bits"))
    return bits if fits(bits, bits.count(), max_broadcast) else None


def hot_keys(df: DataFrame, key: str, slice_rows: int) -> DataFrame:
    """``(_hot_key, _slices)`` for keys with more than ``slice_rows`` rows.

    Counted with map-side partial aggregation over one narrow column.  At most
    ``rows / slice_rows`` keys can pass, which bounds the broadcast of the result.
    """
    return (
        df.groupBy(F.col(key).alias("_hot_key"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > slice_rows)
        .select("_hot_key", F.ceil(F.col("_n") / slice_rows).cast("int").alias("_slices"))
    )


def with_slices(probe: DataFrame, key: str, table: DataFrame, table_key: str, slice_rows: int, key_source: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sides with a column ``_slice``, so that (key, slice) deals hot keys to several tasks: each row of ``probe`` is in one slice of
    its key, each of ``table`` in all of them."""
    hot = hot_keys(probe if key_source is None else key_source, key, slice_rows)
    return _probe_slices(probe, key, hot), _table_slices(table, table_key, hot)


def _probe_slices(probe: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    row_hash = F.xxhash64(*[F.col(c) for c in probe.columns])
    # A NULL key matches nothing, so its rows may go to any slice.
    slices = F.when(F.col(key).isNull(), F.lit(1024)).otherwise(F.coalesce(F.col("_slices"), F.lit(1)))
    return (
        probe.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
        .withColumn("_slice", F.pmod(row_hash, slices).cast("int"))
        .drop("_hot_key", "_slices")
    )


def _table_slices(table: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    return (
        table.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_slices"), F.lit(1)) - 1)))
        .drop("_hot_key", "_slices")
    )


def _sliced_join(
    probe: DataFrame,
    table: DataFrame,
    key: str,
    table_key: str,
    condition: Callable[[], Column] | None,
    how: str,
    hot: DataFrame,
) -> DataFrame:
    left = _probe_slices(probe, key, hot)
    right = _table_slices(table, table_key, hot).withColumnRenamed("_slice", "_table_slice")
    on = (F.col(key) == F.col(table_key)) & (F.col("_slice") == F.col("_table_slice"))
    if condition is not None:
        on = on & condition()
    return left.join(right, on, how).drop(table_key, "_slice", "_table_slice")
