"""Shape the sales pipeline into facts and apply them to the fact table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions import duration_days, event_date, stage_rate
from starmart.operators.dedup import first_per_key
from starmart.operators.lookup import BROADCAST_BYTES, fits, lookup, table_rows
from starmart.schemas import FACT_COLUMNS, STORED_FACT

MODES = ("insert_only", "insert_if_absent", "upsert")
_TIE_BREAKS = ("updated_at", "productkey", "salesagentkey", "datekey", "closevalue", "dealstagekey",
               "durationdays", "accountkey", "expectedsuccessrate")


#: Keys that a usable pipeline row has.
REQUIRED = ("accountid", "productid", "salesagentid", "dealstageid")


def incomplete() -> Column:
    """Does a pipeline row lack a required key or an event date?"""
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in REQUIRED]) | event_date(F.col("closedate"), F.col("engagedate")).isNull()


def shape_pipeline(pipeline: DataFrame, stages: DataFrame, stage_count: int | None = None, complete: bool = True) -> DataFrame:
    """Rows usable as facts: required keys and an event date present, measures derived.

    ``stages`` has one row per stage; it is counted here unless ``stage_count`` is given.  ``complete=False`` keeps
    rows without a required key or date too; resolving them gives rejects with the flags of what is missing (without a
    date no version of a product can be told, so its flag is set too).
    """
    event = event_date(F.col("closedate"), F.col("engagedate"))
    usable = pipeline.filter(~incomplete()) if complete else pipeline
    if stage_count is None:
        stage_count = table_rows({"stages": stages})["stages"]
    names = stages.select(F.col("dealstageid").alias("_stage"), "stagename")
    return lookup(usable, names, "dealstageid", "_stage", stage_count).select(
        *pipeline.columns,
        duration_days(F.col("engagedate"), F.col("closedate")).alias("durationdays"),
        stage_rate(F.col("stagename")).alias("expectedsuccessrate"),
        event.alias("eventdate"),
    )


def first_order() -> list[Column]:
    """Order in which rows of one opportunity compete: oldest first, no tie but identical rows."""
    return [F.col(c).asc_nulls_last() for c in _TIE_BREAKS]


def newest_order() -> list[Column]:
    return [F.col("updated_at").desc_nulls_last(), *first_order()[1:]]


def fact_load(existing: DataFrame, resolved: DataFrame, mode: str = "insert_if_absent") -> DataFrame:
    """The fact table after loading ``resolved`` rows into ``existing``.

    ``insert_only`` appends every row, ``insert_if_absent`` the first row of each unseen
    opportunity, ``upsert`` replaces an opportunity by its newest row.  ``resolved`` is used once: the
    batch is reduced to a row per opportunity before it meets the facts in one shuffle.
    """
    if mode == "insert_only":
        return existing.select(*FACT_COLUMNS).unionByName(resolved.select(*FACT_COLUMNS))
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    one = first_per_key(resolved, "opportunityid", newest_order() if mode == "upsert" else first_order())
    both = existing.select(*FACT_COLUMNS, F.lit(0).alias("_new")).unionByName(one.select(*FACT_COLUMNS, F.lit(1).alias("_new")))
    of_key = Window.partitionBy("opportunityid")
    if mode == "upsert":
        keep = (F.col("_new") == 1) | (F.max("_new").over(of_key) == 0)
    else:
        keep = (F.col("_new") == 0) | (F.min("_new").over(of_key) == 1)
    # A missing key equals no other.
    return both.withColumn("_keep", keep | F.col("opportunityid").isNull()).filter("_keep").select(*FACT_COLUMNS)


def new_facts(
    existing: DataFrame,
    resolved: DataFrame,
    mode: str = "insert_if_absent",
    batch_rows: int | None = None,
    max_broadcast: int = BROADCAST_BYTES,
    columns: Sequence[str] = FACT_COLUMNS,
) -> DataFrame:
    """Only the rows an appending load adds.

    ``batch_rows``, the size of ``resolved`` where it is known and small, sends the batch's keys
    to the existing table: that is then scanned for one column and neither sorted nor shuffled.
    """
    if mode == "insert_only":
        return resolved.select(*columns)
    if mode != "insert_if_absent":
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    present = existing.select("opportunityid")
    keys = resolved.select("opportunityid")
    if batch_rows is not None and fits(keys, batch_rows, max_broadcast):
        batch = F.broadcast(keys.distinct())
        present = present.join(batch, "opportunityid", "left_semi")
    first = first_per_key(resolved, "opportunityid", first_order())
    return first.join(present.distinct(), "opportunityid", "left_anti").select(*columns)


def newer_only(newest: DataFrame, existing: DataFrame, batch_rows: int, max_broadcast: int = BROADCAST_BYTES) -> DataFrame:
    """Rows of ``newest`` (one per opportunity) that ``existing`` does not have in a newer state.

    Equal instants replace; a row without one replaces only what has none.
    """
    keys = newest.select("opportunityid")
    side = F.broadcast(keys) if fits(keys, batch_rows, max_broadcast) else keys
    held = existing.join(side, "opportunityid", "left_semi").groupBy("opportunityid").agg(F.max("updated_at").alias("_held"))
    wins = F.col("_held").isNull() | (F.col("updated_at") >= F.col("_held"))
    return newest.join(held, "opportunityid", "left").filter(wins).select(*newest.columns)


def with_month(facts: DataFrame) -> DataFrame:
    """Add the partition columns ``year`` and ``month`` from the date key."""
    return facts.withColumn("year", F.floor(F.col("datekey") / 10000).cast("int")).withColumn(
        "month", F.floor(F.col("datekey") / 100).cast("int") % 100
    )


def archive_split(facts: DataFrame, cutoff_datekey: int) -> tuple[DataFrame, DataFrame]:
    """``(kept, archived)``: facts from the cut-off on, and those before it."""
    before = F.col("datekey") < cutoff_datekey
    return facts.filter(~before), facts.filter(before)


def probe_facts(facts: DataFrame, product: DataFrame, productid: int, **equal) -> DataFrame:
    """Count facts of a product's current version with the given column values.

    A scalar subquery finds the version; one row is returned even when nothing matches.
    """
    current = product.filter((F.col("productid") == productid) & F.col("iscurrent"))
    sk = current.agg(F.min("productsk")).scalar()
    hit = F.col("productkey") == sk
    for column, value in equal.items():
        hit = hit & (F.col(column) == value)
    return facts.filter(hit).agg(F.count(F.lit(1)).alias("matches"))
