"""Upserts and slowly changing dimensions as functions ``(target, source) -> new target``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions import any_changed
from starmart.operators.dedup import first_per_key, latest_per_key
from starmart.operators.keys import surrogate_keys

# Fixed value: start of validity when the earlier history of a row is unknown.
BEGINNING = "1900-01-01"
PRODUCT_ATTRIBUTES = ("productname", "seriesname", "price", "pricerange")


def scd1_upsert(
    target: DataFrame, source: DataFrame, key: str, newest_by: Sequence[str] = ()
) -> DataFrame:
    """Overwrite by key: source rows replace target rows whole (NULLs too), new keys are added.

    Repeated keys in ``source`` count once, the newest by ``newest_by`` winning.
    """
    fresh = latest_per_key(source, key, newest_by).select(*target.columns)
    kept = target.join(fresh.select(key), key, "left_anti")
    return kept.select(*target.columns).unionByName(fresh)


def insert_if_absent(
    target: DataFrame, source: DataFrame, key: str, order: Sequence[Column]
) -> DataFrame:
    """The rows of ``source`` to add: first per key, for keys ``target`` lacks."""
    first = first_per_key(source, key, order)
    return first.join(target.select(key), key, "left_anti").select(*source.columns)


def scd2_initialize(
    source: DataFrame,
    key: str = "productid",
    sk: str = "productsk",
    valid_from: str = BEGINNING,
) -> DataFrame:
    """First load: every row is the current version, valid from ``valid_from``."""
    return surrogate_keys(source, key, sk).select(
        sk,
        *source.columns,
        F.lit(valid_from).cast("date").alias("validfrom"),
        F.lit(None).cast("date").alias("validto"),
        F.lit(True).alias("iscurrent"),
    )


def scd2_changes(
    dim: DataFrame,
    source: DataFrame,
    key: str = "productid",
    attributes: Sequence[str] = PRODUCT_ATTRIBUTES,
) -> DataFrame:
    """Source rows that are new or differ from their current version.

    Adds ``had_current`` and ``current_from`` (start of the version they replace).
    """
    current = dim.filter("iscurrent").select(
        F.col(key).alias("_key"),
        F.col("validfrom").alias("current_from"),
        *[F.col(a).alias(f"_old_{a}") for a in attributes],
    )
    differs = any_changed([(F.col(f"_old_{a}"), F.col(a)) for a in attributes])
    return (
        source.join(current, F.col(key) == F.col("_key"), "left")
        .filter(F.col("_key").isNull() | differs)
        .select(*source.columns, F.col("_key").isNotNull().alias("had_current"), "current_from")
    )


def scd2_apply(
    dim: DataFrame,
    changes: DataFrame,
    run_date: str,
    key: str = "productid",
    attributes: Sequence[str] = PRODUCT_ATTRIBUTES,
    sk: str = "productsk",
    first_version_from: str = BEGINNING,
) -> DataFrame:
    """Close the current version of each changed key the day before ``run_date``, add the new one.

    A second change on the day a version began rewrites that version in place, so no version
    ends before it starts.  A key seen for the first time is valid from ``first_version_from``; one that
    comes back after its last version was closed is valid from ``run_date``, or the day after that end if it is later.
    """
    day = F.lit(run_date).cast("date")
    new = changes.select(
        F.col(key).alias("_key"), F.col("current_from"), *[F.col(a).alias(f"_new_{a}") for a in attributes]
    )
    # Closed versions pass by untouched; only current ones, one per key, meet the changes.
    closed = dim.filter(~F.col("iscurrent"))
    current = dim.filter("iscurrent").join(new.drop("current_from"), F.col(key) == F.col("_key"), "left")
    hit = F.col("_key").isNotNull()
    in_place = hit & (F.col("validfrom") >= day)
    ends = hit & (F.col("validfrom") < day)
    revised = current.select(
        sk,
        key,
        *[F.when(in_place, F.col(f"_new_{a}")).otherwise(F.col(a)).alias(a) for a in attributes],
        "validfrom",
        F.when(ends, F.date_sub(day, 1)).otherwise(F.col("validto")).alias("validto"),
        (~ends).alias("iscurrent"),
    )
    ended = closed.groupBy(F.col(key).alias("_key")).agg(F.max("validto").alias("_ended"))
    opened = changes.filter(~F.col("had_current") | (F.col("current_from") < day)).join(ended, F.col(key) == F.col("_key"), "left").drop("_key")
    back = F.greatest(day, F.date_add(F.col("_ended"), 1))
    top = dim.agg(F.coalesce(F.max(sk), F.lit(0))).scalar()
    added = surrogate_keys(opened, key, sk, top).select(
        sk,
        key,
        *attributes,
        F.when(F.col("had_current"), day).when(F.col("_ended").isNotNull(), back).otherwise(F.lit(first_version_from).cast("date")).alias("validfrom"),
        F.lit(None).cast("date").alias("validto"),
        F.lit(True).alias("iscurrent"),
    )
    return closed.select(*revised.columns).unionByName(revised).unionByName(added)
