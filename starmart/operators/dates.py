"""Date dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from starmart.functions import date_key, end_of_year, event_date, start_of_year

# Range used when the source has no usable dates.
DEFAULT_FIRST_DATE = "2015-01-01"
DEFAULT_LAST_DATE = "2030-12-31"
#: Years a date dimension may cover.  A date outside them has no row, so its facts are rejected for want of a date;
#: the dimension never exceeds 366 rows for each of these years, whatever the source holds.
YEARS = (1900, 2199)


def _in_years(d: Column) -> Column:
    return F.when(F.year(d).between(*YEARS), d)


def seen_dates(pipeline: DataFrame, unusable: Column | None = None) -> DataFrame:
    """One row ``(lo, hi, engaged, rows, unusable)``: first engagement or event date, last event date, first engagement
    (NULL where there is none), size, and how many rows are ``unusable``."""
    event = _in_years(event_date(F.col("closedate"), F.col("engagedate")))
    return pipeline.agg(
        F.min(F.least(_in_years(F.col("engagedate")), event)).alias("lo"),
        F.max(event).alias("hi"),
        F.min(_in_years(F.col("engagedate"))).alias("engaged"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.lit(False) if unusable is None else unusable).alias("unusable"),
    )


def date_bounds(pipeline: DataFrame) -> DataFrame:
    """``seen_dates`` with the default range when no engagement or no event has a date."""
    return _or_default(seen_dates(pipeline))


def known_bounds(spark: SparkSession, seen: Row) -> DataFrame:
    """``date_bounds`` from the collected row of ``seen_dates``."""
    days = {c: F.lit(seen[c]).cast("date").alias(c) for c in ("lo", "hi", "engaged")}
    return _or_default(spark.range(1).select(*days.values()))


def _or_default(seen: DataFrame) -> DataFrame:
    usable = F.col("engaged").isNotNull() & F.col("hi").isNotNull()
    return seen.select(
        F.when(usable, F.col("lo")).otherwise(F.lit(DEFAULT_FIRST_DATE).cast("date")).alias("lo"),
        F.when(usable, F.col("hi")).otherwise(F.lit(DEFAULT_LAST_DATE).cast("date")).alias("hi"),
    )


def date_dimension(bounds: DataFrame) -> DataFrame:
    """Every day of the whole years covering one-row ``bounds(lo, hi)``.

    The calendar bounds the result (366 rows per year), whatever the size of the facts.
    """
    days = bounds.select(
        F.explode(
            F.sequence(start_of_year(F.col("lo")), end_of_year(F.col("hi")), F.expr("interval 1 day"))
        ).alias("date")
    )
    d = F.col("date")
    return days.select(
        date_key(d).alias("datekey"),
        d,
        F.dayofmonth(d).alias("day"),
        F.month(d).alias("month"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
    )


def extended_dates(dates: DataFrame, seen: DataFrame) -> DataFrame:
    """A date dimension grown to cover one-row ``seen(lo, hi)`` as well."""
    have = dates.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    both = have.unionByName(seen.select("lo", "hi")).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return date_dimension(
        both.select(
            F.coalesce("lo", F.lit(DEFAULT_FIRST_DATE).cast("date")).alias("lo"),
            F.coalesce("hi", F.lit(DEFAULT_LAST_DATE).cast("date")).alias("hi"),
        )
    )
