"""Summaries of facts that loads add to: partial sums with a sign, in place of reading the facts again.

A load knows the rows it puts in and the rows it takes out.  Both are reduced to a few lines, the latter with
a minus, and the lines of all loads together say what one pass over the facts would say.  Their number follows the
dimensions and months, not the facts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.operators.lookup import BROADCAST_BYTES, fits

#: Sums for the monthly aggregate, by the region that the agents had in ``REGIONS_DDL``.
SALES_DDL = (
    "year INT, month INT, region STRING, dealstagekey BIGINT, deals BIGINT, valuesum DECIMAL(38,2), valued BIGINT, "
    "dayssum BIGINT, timed BIGINT, ratesum DECIMAL(38,6), rated BIGINT"
)
REGIONS_DDL = "salesagentkey BIGINT, region STRING"
_SALES_SUMS = {"deals": "bigint", "valuesum": "decimal(38,2)", "valued": "bigint", "dayssum": "bigint", "timed": "bigint",
               "ratesum": "decimal(38,6)", "rated": "bigint"}

#: How many facts use each dimension key, lie in each month (``yyyymm``) or lack a key; opportunities held more than once; rows
#: that were counted while they were written.
USES_DDL = "kind STRING, key BIGINT, n BIGINT"
#: Of each dimension: the fact's key, the table and its key.
FACT_KEYS = {
    "date": ("datekey", "dimdate", "datekey"), "account": ("accountkey", "dimaccount", "accountid"), "product": ("productkey", "dimproduct", "productsk"),
    "agent": ("salesagentkey", "dimsalesagent", "salesagentid"), "stage": ("dealstagekey", "dimdealstage", "stageid"),
}


def signed(added: DataFrame | None, removed: DataFrame | None, like: DataFrame) -> DataFrame:
    """Facts put in and taken out, with ``_sign``; ``like`` gives the columns where there are none."""
    parts = [df.select(*like.columns, F.lit(sign).alias("_sign")) for df, sign in ((added, 1), (removed, -1)) if df is not None]
    return reduce(DataFrame.unionByName, parts) if parts else like.filter(F.lit(False)).withColumn("_sign", F.lit(1))


def _sales_group(by: str) -> tuple[str, ...]:
    return "year", "month", by, "dealstagekey"


def regions(agents: DataFrame) -> DataFrame:
    """The region of each agent, as the aggregate names it."""
    return agents.select(F.col("salesagentid").alias("salesagentkey"), F.coalesce("region", F.lit("Unknown")).alias("region"))


def region_lines(rows: DataFrame, held: DataFrame, held_rows: int, max_broadcast: int = BROADCAST_BYTES) -> DataFrame:
    """``sales_lines`` by the region that ``held`` has for the agent; rows of other agents are left out, as the aggregate does.

    The sign of a row is its own, or that of ``held`` where it has one.
    """
    small = fits(held, held_rows, max_broadcast)
    if small or "_sign" in held.columns:
        return sales_lines(rows.join(F.broadcast(held) if small else held, "salesagentkey"), "region")
    return merged_sales(sales_lines(rows).join(held, "salesagentkey").drop("salesagentkey"))


def moved_agents(before: DataFrame, now: DataFrame) -> DataFrame:
    """Agents whose region is another, or who came or went, with ``_sign`` and ``region``: a line to take out and one to put in."""
    both = before.withColumn("_sign", F.lit(-1)).unionByName(now.withColumn("_sign", F.lit(1)))
    # What is the same before and now cancels out.
    return both.groupBy("salesagentkey", "region").agg(F.sum("_sign").cast("int").alias("_sign")).filter("_sign <> 0")


def sales_lines(rows: DataFrame, by: str = "salesagentkey") -> DataFrame:
    """Signed sums and non-null counts of ``signed`` rows, by month, agent (or region) and stage."""

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("_sign") > 0, c).otherwise(-c)), F.lit(0))

    def held(c: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col(c).isNotNull(), F.col("_sign"))), F.lit(0))

    made = {
        "deals": F.sum("_sign"),
        "valuesum": total(F.col("closevalue")), "valued": held("closevalue"),
        "dayssum": total(F.col("durationdays").cast("bigint")), "timed": held("durationdays"),
        "ratesum": total(F.col("expectedsuccessrate").cast("decimal(18,6)")), "rated": held("expectedsuccessrate"),
    }
    return rows.groupBy(*_sales_group(by)).agg(*[made[name].cast(kind).alias(name) for name, kind in _SALES_SUMS.items()])


def merged_sales(lines: DataFrame) -> DataFrame:
    """One line for each month, agent (or region) and stage; those that cancel out are gone."""
    by = "region" if "region" in lines.columns else "salesagentkey"
    summed = lines.groupBy(*_sales_group(by)).agg(*[F.sum(name).cast(kind).alias(name) for name, kind in _SALES_SUMS.items()])
    return summed.filter("deals <> 0")


def monthly_from_lines(lines: DataFrame, agents: DataFrame, agent_rows: int, max_broadcast: int = BROADCAST_BYTES) -> DataFrame:
    """The monthly aggregate from sales lines: the rows that ``monthly_sales`` makes from the facts.

    A fact's month is that of its date key.  Lines by region need no agents; of those by agent, lines of agents who are not there are left out, as their facts would be.
    """
    side = regions(agents)
    lines = lines.filter("year is not null")
    if "region" in lines.columns:
        held = lines
    elif fits(side, agent_rows, max_broadcast):
        # Lines get their region where they are read, so only sums by region are shuffled.
        held = lines.join(F.broadcast(side), "salesagentkey")
    else:
        # Merged first, so that a long row of loads costs an agent no more than a line in the join.
        held = merged_sales(lines).join(side, "salesagentkey")
    # Lines that cancel out add nothing; a group of nothing else is gone.
    out = held.groupBy("year", "month", "region", "dealstagekey").agg(
        *[F.sum(name).cast(kind).alias(name) for name, kind in _SALES_SUMS.items()]).filter("deals <> 0")

    def mean(total: str, n: str) -> Column:
        return F.col(total).cast("double") / F.nullif(F.col(n), F.lit(0))

    return out.select(
        "year", "month", "region", "dealstagekey", F.col("deals").alias("totaldealcount"),
        F.when(F.col("valued") > 0, F.col("valuesum").cast("double")).alias("totalclosevalue"),
        mean("valuesum", "valued").alias("avgdealvalue"),
        mean("dayssum", "timed").alias("avgdurationdays"),
        mean("ratesum", "rated").alias("expectedsuccessrate"),
    )


def use_lines(rows: DataFrame) -> DataFrame:
    """Signed uses of each dimension key and month, and rows without a key.

    Days, stages and months are few: ``signed`` rows are summed by all of them together, and lines are made of the sums.  A key of a larger dimension is
    summed by itself, so a pass over the rows makes no line for each of its keys.
    """
    lacks = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in ("opportunityid", *[key for key, _, _ in FACT_KEYS.values()])])
    month = (F.col("year") * 100 + F.col("month")).cast("bigint")
    few = {label: FACT_KEYS[label][0] for label in ("date", "stage")}
    sums = rows.groupBy(*[F.col(key).cast("bigint").alias(label) for label, key in few.items()], month.alias("month"), lacks.alias("_lacks")).agg(F.sum("_sign").alias("_n"))
    kinds = [(F.lit(label), F.col(label)) for label in (*few, "month")] + [(F.when(F.col("_lacks"), "null"), F.lit(None).cast("bigint"))]
    lines = sums.select("_n", F.inline(F.array(*[F.struct(kind.alias("kind"), key.alias("key")) for kind, key in kinds])))
    out = lines.filter("kind is not null").groupBy("kind", "key").agg(F.sum("_n").alias("n"))
    for label, (key, _, _) in FACT_KEYS.items():
        if label not in few:
            one = rows.groupBy(F.col(key).cast("bigint").alias("key")).agg(F.sum("_sign").alias("n"))
            out = out.unionByName(one.select(F.lit(label).alias("kind"), "key", "n"))
    return out


def repeat_lines(before: DataFrame | None, after: DataFrame | None, like: DataFrame) -> DataFrame:
    """By how many the opportunities held more than once grow, from all rows of the opportunities touched, before and after."""
    def keys(df: DataFrame | None) -> DataFrame | None:
        return None if df is None else df.select("opportunityid")

    rows = signed(keys(after), keys(before), like.select("opportunityid"))
    of_key = rows.groupBy("opportunityid").agg(F.count_if(F.col("_sign") > 0).alias("now"), F.count_if(F.col("_sign") < 0).alias("was"))
    grown = F.coalesce(F.sum((F.col("now") > 1).cast("bigint") - (F.col("was") > 1).cast("bigint")), F.lit(0))
    return of_key.agg(grown.alias("n")).select(F.lit("repeated").alias("kind"), F.lit(None).cast("bigint").alias("key"), "n")


def merged_uses(lines: DataFrame) -> DataFrame:
    return lines.groupBy("kind", "key").agg(F.sum("n").alias("n")).filter("n <> 0")


def summary_checks(lines: DataFrame, t: dict[str, DataFrame], archived: int) -> DataFrame:
    """The checks of facts from use lines: what a pass over the facts would count, read from lines and dimensions.

    The total compares rows counted while they were written with the deals of the aggregate, which come from sales lines.
    """
    fact, monthly = "factsalesperformance", "factsalesmonthlyaggregate"
    known = reduce(DataFrame.unionByName, [
        t[name].select(F.lit(label).alias("kind"), F.col(parent).cast("bigint").alias("key")) for label, (_, name, parent) in FACT_KEYS.items()])
    uses = merged_uses(lines).join(known.distinct().withColumn("_known", F.lit(True)), ["kind", "key"], "left")

    def count(test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))

    tests = {"fact_key_unique": F.col("kind") == "repeated", "fact_null_key": F.col("kind") == "null"}
    for label in FACT_KEYS:
        tests[f"orphan_{label}"] = (F.col("kind") == label) & F.col("key").isNotNull() & F.col("_known").isNull()
    deals = t[monthly].agg(F.coalesce(F.sum("totaldealcount"), F.lit(0))).scalar()
    counted = uses.agg(*[count(test).alias(name) for name, test in tests.items()], F.abs(count(F.col("kind") == "rows") + archived - deals).alias("aggregate_total"))
    lines_of = [(name, fact) for name in tests] + [("aggregate_total", monthly)]
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("check_name"), F.lit(of).alias("table_name"), F.col(name).cast("bigint").alias("violations")) for name, of in lines_of])))
