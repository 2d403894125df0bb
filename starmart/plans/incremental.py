"""Incremental load: changed dimension rows first, then facts and kept rejects, then marks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from starmart.functions import change_window
from starmart.operators.aggregates import in_months, refresh_months
from starmart.operators.dates import extended_dates, seen_dates
from starmart.operators.dedup import first_per_key, latest_per_key
from starmart.operators.dims import account_rows, agent_rows, product_rows, stage_rows
from starmart.operators.facts import incomplete, new_facts, newer_only, newest_order, shape_pipeline, with_month
from starmart.operators.lookup import fits, table_rows
from starmart.operators.resolve import KEY_FLAGS, mark_retries, resolve_keys
from starmart.operators.scd import scd1_upsert, scd2_apply, scd2_changes
from starmart.operators.summaries import monthly_from_lines
from starmart.plans import summaries
from starmart.plans.initial import FACT, MONTHLY, dimensions_of, left_out, stage_resolved
from starmart.plans.options import LoadOptions, batch_name, loaded_before, logged, utc
from starmart.schemas import STORED_FACT
from starmart.sources.warehouse import MARKED_TABLES, Entry, Warehouse

#: Of each dimension: the flag of a reject that misses it, its own key, and the source key that a reject holds.
DIM_KEYS = {
    "dimdate": ("missing_date", "datekey", "date"),
    "dimaccount": ("missing_account", "accountid", "accountid"),
    "dimproduct": ("missing_product", "productsk", "productid"),
    "dimsalesagent": ("missing_agent", "salesagentid", "salesagentid"),
    "dimdealstage": ("missing_stage", "stageid", "stageid"),
}
#: Keys that dimensions gained by change logs since the last incremental run.
ARRIVALS, ARRIVALS_DDL = "arrivals", "flag STRING, id BIGINT"


def incremental_load(
    src: Mapping[str, DataFrame],
    wh: Warehouse,
    run_ts: str,
    batch_id: str | None = None,
    options: LoadOptions = LoadOptions(),
    fact_batch: DataFrame | None = None,
) -> None:
    """Bring the warehouse up to ``run_ts``.

    Kept rejects are tried again when a key that they wait for has arrived.

    Each source table is read over ``(its mark, run_ts]``, the same ``run_ts`` for all.
    ``fact_batch`` replaces the window on the pipeline, for rows that arrive as a stream.
    A batch already committed is not loaded again.  Archived opportunities count as present and
    are final: their late rows change neither the facts nor the archive.
    """
    run_ts = utc(run_ts)
    batch = batch_id or batch_name(run_ts)
    if loaded_before(wh, batch):
        return
    with logged(wh, batch, run_ts):
        back = timedelta(seconds=options.overlap_seconds)
        marks = {t: (datetime.fromisoformat(m) - back).isoformat() for t, m in wh.marks().items()}
        window = {
            t: src[t].filter(change_window(F.col("updated_at"), marks[t], run_ts)) for t in MARKED_TABLES if t in src
        }
        if fact_batch is not None:
            window["salespipeline"] = fact_batch
        facts = window.pop("salespipeline")
        read = table_rows(window)
        seen = seen_dates(facts, incomplete()).first()
        read["salespipeline"] = seen["rows"]

        done = _load_dimensions(src, wh, window, read, run_ts, batch, options)
        if _outside(wh, seen):
            span = wh.spark.range(1).select(F.lit(seen["lo"]).alias("lo"), F.lit(seen["hi"]).alias("hi"))
            done["dimdate"] = wh.write("dimdate", extended_dates(wh.table("dimdate"), span), batch)
        done, months, change = _load_facts(src, wh, facts, seen, done, batch, options)
        made = summaries.advanced(wh, done, change, batch, options)
        lines = summaries.sales(wh, made)
        months = sorted({*months, *_months_of_moved_agents(wh, done, options)})
        if months:
            done[MONTHLY] = refresh_aggregate(wh, done, lines, months, batch, options)
        moved = MARKED_TABLES if fact_batch is None else [t for t in MARKED_TABLES if t != "salespipeline"]
        used = [Entry(ARRIVALS, "reset")] if wh.live(ARRIVALS) else []
        wh.commit(batch, run_ts, [*done.values(), *made.values(), *used], {t: run_ts for t in moved})
        if options.validate:
            wh.note_checks(batch, run_ts, summaries.checks(wh, options))


def _load_dimensions(
    src: Mapping[str, DataFrame],
    wh: Warehouse,
    window: Mapping[str, DataFrame],
    read: Mapping[str, int],
    run_ts: str,
    batch: str,
    options: LoadOptions,
) -> dict[str, Entry]:
    """New versions of the dimensions that changed; the others keep their directories."""
    run_date = run_ts[:10]
    new: dict[str, DataFrame] = {}
    if read["accounts"]:
        rows = account_rows(window["accounts"], src["sectors"], "updated_at")
        new["dimaccount"] = scd1_upsert(wh.table("dimaccount"), rows, "accountid", ["updated_at"])
    if read["products"]:
        rows = product_rows(window["products"], src["productseries"], "updated_at")
        newest = latest_per_key(rows, "productid", ["updated_at"]).drop("updated_at")
        dim = wh.table("dimproduct")
        first_from = run_date if options.first_version_from == "run_date" else options.first_version_from
        new["dimproduct"] = scd2_apply(
            dim,
            scd2_changes(dim, newest),
            run_date,
            first_version_from=first_from,
        )
    if read["salesagents"]:
        rows = agent_rows(window["salesagents"], src["salesmanagers"], src["locations"], "updated_at")
        new["dimsalesagent"] = scd1_upsert(wh.table("dimsalesagent"), rows, "salesagentid", ["updated_at"])
    new["dimdealstage"] = scd1_upsert(wh.table("dimdealstage"), stage_rows(src["dealstages"]), "stageid")
    return wh.write_all(new, batch)


def _outside(wh: Warehouse, seen: Row) -> bool:
    """Do the dates seen reach beyond the date dimension?"""
    days = [d for d in (seen["lo"], seen["hi"]) if d is not None]
    have = wh.table("dimdate").agg(F.min("date").alias("lo"), F.max("date").alias("hi")).first()
    return bool(days) and (have["lo"] is None or min(days) < have["lo"] or max(days) > have["hi"])


def _gained(wh: Warehouse, entry: Entry) -> DataFrame:
    """Keys that a new version of a dimension has and the committed one lacks, as source keys."""
    own, source = DIM_KEYS[entry.table_name][1:]
    return wh.read(entry.table_name, [entry]).join(wh.table(entry.table_name).select(own), own, "left_anti").select(F.col(source).alias("id"))


def note_arrivals(wh: Warehouse, entry: Entry, batch: str) -> Entry:
    """Note the keys that a dimension gains outside of an incremental run, for the next one."""
    flag = DIM_KEYS[entry.table_name][0]
    return wh.write_side(ARRIVALS, _gained(wh, entry).distinct().select(F.lit(flag).alias("flag"), "id"), batch)


def _arrived(wh: Warehouse, done: Mapping[str, Entry]) -> dict[str, tuple[DataFrame, int]]:
    """By flag, the keys that dimensions gained in this run or by change logs before it, and their number at most."""
    out: dict[str, tuple[DataFrame, int]] = {}
    for table, (flag, _, _) in DIM_KEYS.items():
        # Incremental runs take no key away, so the growth says how many are new.
        more = done[table].rows_written - wh.rows(table) if table in done else 0
        if more > 0:
            out[flag] = (_gained(wh, done[table]), more)
    noted = [e for e in wh.live(ARRIVALS) if e.rows_written]
    if noted:
        keys, rows = wh.side(noted, ARRIVALS_DDL), sum(e.rows_written for e in noted)
        for flag in ("missing_account", "missing_product", "missing_agent"):
            mine, more = keys.filter(F.col("flag") == flag).select("id"), rows
            if flag in out:
                mine, more = mine.unionByName(out[flag][0]), rows + out[flag][1]
            out[flag] = (mine, more)
    return out


def _kept_back(wh: Warehouse, shaped: DataFrame, arrived: Mapping[str, tuple[DataFrame, int]], options: LoadOptions) -> DataFrame:
    """Rejects that the window does not read again, with ``_retry``.  Those it does are kept as often as they are read."""
    rejects = wh.table("factrejects")
    source = [c for c in rejects.columns if c not in KEY_FLAGS.values()]
    marked = rejects.withColumn("_retry", F.lit(True)) if options.replay == "all" else mark_retries(rejects, arrived, **options.sizes)
    keys = rejects.select("opportunityid")
    if fits(keys, wh.rows("factrejects"), options.max_broadcast):
        shaped = shaped.join(F.broadcast(keys.distinct()), "opportunityid", "left_semi")
    # The window is shuffled as digests, the rejects with theirs.
    again = shaped.select(row_digest(source).alias("_again"))
    mine = marked.withColumn("_mine", row_digest(source))
    return mine.join(again, F.col("_mine") == F.col("_again"), "left_anti").drop("_mine")


def row_digest(columns: Sequence[str]) -> Column:
    """The first 16 bytes of the SHA-256 of a pipeline row: equal for equal rows, null for a row without an opportunity."""
    # The opportunity, the only text, comes last: no other value has the separator or the mark of a null.
    rest = [c for c in columns if c != "opportunityid"]
    # Equal numbers read alike, whatever their type's scale or the sign of a zero.
    values = [F.col(c).cast("decimal(38,10)") if c in ("closevalue", "expectedsuccessrate") else F.col(c) for c in rest]
    text = F.concat_ws("|", *[F.coalesce(v.cast("string"), F.lit("?")) for v in values], "opportunityid")
    return F.when(F.col("opportunityid").isNotNull(), F.unhex(F.substring(F.sha2(text, 256), 1, 32)))


def _load_facts(
    src: Mapping[str, DataFrame],
    wh: Warehouse,
    rows: DataFrame,
    seen: Row,
    done: dict[str, Entry],
    batch: str,
    options: LoadOptions,
) -> tuple[dict[str, Entry], list[int], summaries.Change]:
    """Facts of the window and of rejects whose keys arrived, the remaining rejects, the months touched, and the facts put in and taken out."""
    if options.replay not in ("arrived", "all"):
        raise ValueError(f"replay must be 'arrived' or 'all', not {options.replay!r}")
    waiting = wh.rows("factrejects")
    arrived = _arrived(wh, done) if waiting else {}
    if not seen["rows"] and not (waiting and (arrived or options.replay == "all")):
        return done, [], summaries.Change()
    n = seen["rows"] + waiting
    rejects = wh.table("factrejects")
    source = [c for c in rejects.columns if c not in KEY_FLAGS.values()]
    rows_now = shape_pipeline(rows, latest_per_key(src["dealstages"], "dealstageid", ())).select(*source)
    left = None
    if waiting:
        held = wh.stage("rejects", _kept_back(wh, rows_now, arrived, options))
        rows_now = rows_now.unionByName(held.filter("_retry").select(*source))
        left = held.filter("not _retry").drop("_retry")
    how = {"product": "as_of", "bounds": options.bounds, "emit": options.emit, **options.sizes}
    flagged = resolve_keys(rows_now, dimensions_of(wh, done), **how).flagged
    # The batch is resolved once; facts, rejects and months are all taken from the result.
    resolved = stage_resolved(wh, flagged)
    writes = {"factrejects": resolved.rejects if left is None else resolved.rejects.unionByName(left)}
    existing = wh.table(FACT)
    final = wh.table("factsarchive").select("opportunityid")
    if options.fact_mode == "upsert":
        written = wh.write_all(writes, batch)
        entry, change = _upsert(wh, existing, final, resolved.facts, n, batch, options)
    else:
        present = existing.select("opportunityid").unionByName(final)
        added = new_facts(present, resolved.facts, options.fact_mode, n, options.max_broadcast, STORED_FACT)
        if options.fact_mode == "insert_only":
            added = added.join(archived_keys(wh, resolved.facts.select("opportunityid"), options), "opportunityid", "left_anti")
        written = wh.write_all({**writes, FACT: with_month(added)}, batch, {FACT: "append"})
        entry = written[FACT]
        added = wh.read(FACT, [entry])
        change = summaries.Change(added)
        if options.fact_mode == "insert_only":
            keys = added.select("opportunityid").distinct()
            side = F.broadcast(keys) if fits(keys, entry.rows_written, options.max_broadcast) else keys
            held = existing.select("opportunityid").join(side, "opportunityid", "left_semi")
            change = summaries.Change(added, before=held, after=held.unionByName(added.select("opportunityid")))
    entry = replace(entry, rows_read=seen["rows"], rows_rejected=written["factrejects"].rows_written, message=left_out(seen["unusable"]))
    months = entry.months or months_of(wh.read(FACT, [entry]))
    return {**done, FACT: entry, "factrejects": written["factrejects"]}, list(months), change


def archived_keys(wh: Warehouse, side: DataFrame, options: LoadOptions) -> DataFrame:
    """Archived opportunities among those of ``side``, to be left out of a load."""
    keys = wh.table("factsarchive").select("opportunityid")
    if fits(keys, wh.rows("factsarchive"), options.max_broadcast):
        return F.broadcast(keys.distinct())
    return keys.join(side, "opportunityid", "left_semi").distinct()


def months_of(facts: DataFrame) -> list[int]:
    """Months present, from partition columns; the calendar bounds the list."""
    found = facts.select((F.col("year") * 100 + F.col("month")).alias("m")).distinct()
    return sorted(r.m for r in found.collect())


def _upsert(
    wh: Warehouse, existing: DataFrame, final: DataFrame, resolved: DataFrame, n: int, batch: str, options: LoadOptions
) -> tuple[Entry, summaries.Change]:
    """The newest row of each opportunity, where the facts hold no newer one and the archive none."""
    newest = first_per_key(resolved, "opportunityid", newest_order()).join(final, "opportunityid", "left_anti")
    winners = wh.stage("winners", with_month(newer_only(newest.select(*STORED_FACT), existing, n, options.max_broadcast)))
    return rewrite_months(wh, existing, winners.select("opportunityid"), n, winners, batch, options)


def rewrite_months(
    wh: Warehouse,
    existing: DataFrame,
    keys: DataFrame,
    n: int,
    added: DataFrame,
    batch: str,
    options: LoadOptions,
) -> tuple[Entry, summaries.Change]:
    """Take the opportunities ``keys`` (at most ``n``) out of the facts and put ``added`` in.

    Only months that lose or gain a row are written again; the others keep their files.
    """
    columns = [*STORED_FACT, "year", "month"]
    if fits(keys, n, options.max_broadcast):
        keys = F.broadcast(keys)
        losing = wh.stage("losing", existing.join(keys, "opportunityid", "left_semi").select(*columns))
        staying = existing.join(keys, "opportunityid", "left_anti")
    else:
        # The facts are shuffled to meet many keys: once, for those that go and those that stay.
        met = existing.join(keys.distinct().withColumn("_goes", F.lit(True)), "opportunityid", "left")
        met = wh.stage("met", met.select(*columns, "_goes"))
        losing, staying = met.filter("_goes").drop("_goes"), met.filter("_goes is null").drop("_goes")
    months = months_of(losing.select("year", "month").unionByName(added.select("year", "month")))
    rest = staying.filter(in_months(F.col("year"), F.col("month"), months))
    content = rest.select(*columns).unionByName(added.select(*columns))
    return wh.write(FACT, content, batch, action="append", months=months), summaries.Change(added.select(*columns), losing)


def _months_of_moved_agents(wh: Warehouse, done: Mapping[str, Entry], options: LoadOptions) -> list[int]:
    """Months whose totals shift because an agent now belongs to another region."""
    if "dimsalesagent" not in done:
        return []
    old = wh.table("dimsalesagent").select(F.col("salesagentid").alias("_id"), F.col("region").alias("_old"))
    now = wh.read("dimsalesagent", [done["dimsalesagent"]])
    moved = (
        now.join(old, F.col("salesagentid") == F.col("_id"))
        .filter(~F.col("region").eqNullSafe(F.col("_old")))
        .select(F.col("salesagentid").alias("salesagentkey"))
    )
    if moved.isEmpty():
        return []
    side = F.broadcast(moved) if fits(moved, wh.rows("dimsalesagent"), options.max_broadcast) else moved
    facts = wh.table(FACT).unionByName(wh.table("factsarchive")).select("year", "month", "salesagentkey")
    return months_of(facts.filter("year is not null").join(side, "salesagentkey", "left_semi"))


def refresh_aggregate(
    wh: Warehouse, done: Mapping[str, Entry], lines: DataFrame, months: list[int], batch: str, options: LoadOptions
) -> Entry:
    """The aggregate with ``months`` made anew from sales lines; no fact is read."""
    dims = dimensions_of(wh, done)
    touched = lines.filter(in_months(F.col("year"), F.col("month"), months))
    again = monthly_from_lines(touched, dims.agent, dims.rows["agent"], options.max_broadcast)
    return wh.write(MONTHLY, refresh_months(wh.table(MONTHLY), again, months), batch)
