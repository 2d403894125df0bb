"""Apply a log of inserts, updates and deletes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.operators.dedup import latest_per_key

#: Insert, update, delete.
OPS = ("I", "U", "D")


def apply_changes(
    target: DataFrame, changes: DataFrame, key: str, newest_by: Sequence[str], op: str = "op"
) -> DataFrame:
    """The newest change of each key decides: ``I``/``U`` set the row, ``D`` removes it.

    Changes with another ``op``, or none, are left out; ``bad_changes`` has them.
    """
    latest = latest_per_key(changes.filter(known_op(op)), key, newest_by)
    kept = target.join(latest.select(key), key, "left_anti")
    written = latest.filter(F.col(op) != "D")
    return kept.select(*target.columns).unionByName(written.select(*target.columns))


def known_op(op: str = "op") -> Column:
    """Is it one of the codes of a change log?"""
    return F.coalesce(F.col(op).isin(*OPS), F.lit(False))


def bad_changes(changes: DataFrame, op: str = "op") -> DataFrame:
    return changes.filter(~known_op(op))


def update_by_key(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Overwrite the columns ``updates`` has, for keys both sides have; other rows stay."""
    changed = [c for c in updates.columns if c != key]
    one = latest_per_key(updates, key, ())  # of repeated keys, the row that sorts first
    new = one.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in changed])
    hit = F.col("_key").isNotNull()
    return target.join(new, F.col(key) == F.col("_key"), "left").select(
        *[F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in changed else F.col(c)
          for c in target.columns]
    )


def delete_by_key(target: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return target.join(keys.select(key).distinct(), key, "left_anti").select(*target.columns)


def last_processed(changes: DataFrame, at: str, seq: str) -> DataFrame:
    """One row: time and sequence number of the newest change, the next run's starting point."""
    newest = changes.agg(F.max(F.struct(at, seq)).alias("_m"))
    return newest.select(F.col(f"_m.{at}").alias(at), F.col(f"_m.{seq}").alias(seq))
