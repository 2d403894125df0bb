"""The stored summaries of the facts: kept in line by loads, made anew where something else changed the facts."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators.quality import all_checks, dimension_checks, validate_warehouse
from starmart.operators.summaries import (
    REGIONS_DDL,
    SALES_DDL,
    USES_DDL,
    merged_sales,
    merged_uses,
    moved_agents,
    region_lines,
    regions,
    repeat_lines,
    signed,
    summary_checks,
    use_lines,
)
from starmart.plans.options import LoadOptions
from starmart.schemas import STORED_FACT, WAREHOUSE_DDL
from starmart.sources.warehouse import Entry, Warehouse

FACT, ARCHIVE = "factsalesperformance", "factsarchive"
SALES, USES = "regionsales", "factuses"
#: The regions of the agents that the sales lines speak of.
REGIONS, AGENT = "agentregions", "dimsalesagent"
#: Directories of a summary that are read together; the next load after so many joins them.
FOLD_AFTER = 32


@dataclass(frozen=True)
class Change:
    """What a load does to the facts: rows put in and taken out.

    ``before`` and ``after`` are all rows of the opportunities touched, where those are more than the rows taken out and put in.
    ``archived`` marks rows that stay in the aggregate.
    """

    added: DataFrame | None = None
    removed: DataFrame | None = None
    before: DataFrame | None = None
    after: DataFrame | None = None
    archived: bool = False


def _directories(wh: Warehouse, name: str, done: Mapping[str, Sequence[Entry]]) -> list[Entry]:
    """The directories of a table once ``done`` is committed."""
    out = wh.live(name)
    for e in done.get(name, ()):
        out = [e] if e.action == "replace" else [*out, e]
    return out


def _cover(wh: Warehouse, done: Mapping[str, Sequence[Entry]]) -> str:
    """Names the directories of facts and archive that a summary speaks of."""
    paths = [[e.path for e in _directories(wh, name, done)] for name in (FACT, ARCHIVE)]
    return hashlib.sha256(repr(paths).encode()).hexdigest()


def current(wh: Warehouse) -> bool:
    """Do the summaries speak of exactly the facts that are there?"""
    cover = _cover(wh, {})
    return bool(wh.live(REGIONS)) and all(held and held[-1].message == cover for held in (wh.live(SALES), wh.live(USES)))


def _lines(wh: Warehouse, name: str, ddl: str, made: Mapping[str, Entry]) -> DataFrame:
    return wh.side(_directories(wh, name, {n: [e] for n, e in made.items()}), ddl)


def sales(wh: Warehouse, made: Mapping[str, Entry]) -> DataFrame:
    """Sales lines of all loads and those ``made`` by a running one."""
    return _lines(wh, SALES, SALES_DDL, made)


def _agents(wh: Warehouse, done: Mapping[str, Sequence[Entry]]) -> tuple[str, DataFrame, int]:
    """The agents' directories once ``done`` is committed, named, their regions and how many there are."""
    held = _directories(wh, AGENT, done)
    return repr([e.path for e in held]), regions(wh.read(AGENT, held)), sum(e.rows_written or 0 for e in held)


def _moved(wh: Warehouse, name: str, now: DataFrame, n: int, batch: str, options: LoadOptions) -> tuple[dict[str, Entry], DataFrame | None]:
    """The agents' regions noted, where they are not those that the sales lines speak of, and the lines of facts whose agent moved."""
    held = wh.live(REGIONS)
    if held[-1].message == name:
        return {}, None
    made = {REGIONS: wh.write_side(REGIONS, now, batch, "replace", name)}
    moved = wh.stage("moved", moved_agents(wh.side(held, REGIONS_DDL), wh.side([made[REGIONS]], REGIONS_DDL)))
    if moved.isEmpty():
        return made, None
    both = wh.table(FACT).unionByName(wh.table(ARCHIVE))
    lines = region_lines(both, moved, sum(e.rows_written or 0 for e in held) + n, options.max_broadcast)
    return made, lines


def whole(wh: Warehouse, done: Mapping[str, Sequence[Entry]], batch: str, options: LoadOptions = LoadOptions()) -> dict[str, Entry]:
    """Summaries made from all facts and the archive, as ``done`` leaves them."""
    cover = _cover(wh, done)
    name, held, n = _agents(wh, done)
    facts = wh.read(FACT, _directories(wh, FACT, done))
    both = facts.unionByName(wh.read(ARCHIVE, _directories(wh, ARCHIVE, done)))
    rows = facts.agg(F.count(F.lit(1)).alias("n")).select(F.lit("rows").alias("kind"), F.lit(None).cast("bigint").alias("key"), "n")
    uses = use_lines(signed(facts, None, facts)).unionByName(repeat_lines(None, facts, facts)).unionByName(rows)
    return {
        SALES: wh.write_side(SALES, region_lines(signed(both, None, both), held, n, options.max_broadcast), batch, "replace", cover),
        REGIONS: wh.write_side(REGIONS, held, batch, "replace", name),
        USES: wh.write_side(USES, uses, batch, "replace", cover),
    }


def advanced(wh: Warehouse, done: Mapping[str, Entry], change: Change, batch: str, options: LoadOptions = LoadOptions()) -> dict[str, Entry]:
    """Summaries after a load: its own lines, written beside those there are.

    If they do not speak of the facts as they were, they are made anew.
    """
    tables = {name: [done[name]] for name in (FACT, ARCHIVE) if name in done}
    agents = {AGENT: [done[AGENT]]} if AGENT in done else {}
    if not current(wh):
        return whole(wh, {**tables, **agents}, batch, options)
    name, held_regions, n = _agents(wh, agents)
    made, moved = _moved(wh, name, held_regions, n, batch, options)
    if not tables and moved is None:
        return made
    cover = _cover(wh, tables)
    like = wh.read(FACT, []).select(*STORED_FACT, "year", "month")
    rows = signed(change.added, change.removed, like)
    before = change.removed if change.before is None else change.before
    after = change.added if change.after is None else change.after
    counted = wh.spark.range(1).select(
        F.lit("rows").alias("kind"), F.lit(None).cast("bigint").alias("key"), F.lit(_grown(wh, done.get(FACT))).cast("bigint").alias("n"))
    uses = use_lines(rows).unionByName(repeat_lines(before, after, like)).unionByName(counted)
    sold = region_lines(signed(None, None, like) if change.archived else rows, held_regions, n, options.max_broadcast)
    if moved is not None:
        sold = sold.unionByName(moved)
    for name, lines, ddl, merged in ((SALES, sold, SALES_DDL, merged_sales), (USES, uses, USES_DDL, merged_uses)):
        held = wh.live(name)
        if len(held) < FOLD_AFTER:
            made[name] = wh.write_side(name, lines, batch, message=cover)
        else:
            made[name] = wh.write_side(name, merged(wh.side(held, ddl).unionByName(lines)), batch, "replace", cover)
    return made


def _grown(wh: Warehouse, entry: Entry | None) -> int:
    """By how many rows the facts grow with a directory, as counted while it was written."""
    if entry is None:
        return 0
    lines = wh.side(wh.live(USES), USES_DDL)
    if entry.action == "replace":
        gone = lines.filter("kind = 'rows'")
    elif entry.months:
        gone = lines.filter((F.col("kind") == "month") & F.col("key").isin(list(entry.months)))
    else:
        return entry.rows_written
    return entry.rows_written - (gone.agg(F.sum("n")).first()[0] or 0)


def checks(wh: Warehouse, options: LoadOptions) -> DataFrame:
    """The validation of a load: from the summaries, or by reading all facts (``validate="full"``)."""
    tables = wh.tables()
    if options.validate == "full" or not current(wh):
        return validate_warehouse(tables, options.max_broadcast, {n: wh.rows(n) for n in WAREHOUSE_DDL})
    lines = wh.side(wh.live(USES), USES_DDL)
    return all_checks(summary_checks(lines, tables, wh.rows(ARCHIVE)), dimension_checks(tables))
