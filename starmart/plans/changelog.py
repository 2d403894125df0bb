"""Apply a log of inserted, updated and deleted pipeline rows to the facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators.changes import delete_by_key, known_op
from starmart.operators.dedup import latest_per_key
from starmart.operators.dims import account_rows, agent_rows, product_rows
from starmart.operators.facts import shape_pipeline, with_month
from starmart.operators.lookup import fits
from starmart.operators.resolve import KEY_FLAGS, resolve_keys
from starmart.operators.scd import scd1_upsert, scd2_apply, scd2_changes
from starmart.plans.incremental import FACT, MONTHLY, archived_keys, months_of, note_arrivals, refresh_aggregate, rewrite_months
from starmart.plans.initial import dimensions_of, stage_resolved
from starmart.plans import summaries
from starmart.plans.options import LoadOptions, batch_name, loaded_before, logged, utc
from starmart.sources.warehouse import Entry, Warehouse


#: Newest change of each opportunity that was applied, deletes included: one directory for each batch, merged when read.
STATE = "changestate"


def apply_pipeline_changes(
    src: Mapping[str, DataFrame],
    wh: Warehouse,
    changes: DataFrame,
    newest_by: Sequence[str],
    run_ts: str,
    batch_id: str | None = None,
    options: LoadOptions = LoadOptions(),
    at: str | None = None,
) -> None:
    """Bring the facts in line with ``changes``: pipeline columns and ``op`` (I, U or D).

    The newest change of an opportunity by ``newest_by`` decides, over all batches ever applied: the warehouse keeps
    each opportunity's newest change, deletes too, and a change that is not newer changes nothing.  So a log may be
    cut into batches anywhere, and come in any order.  A deleted opportunity leaves the facts; an inserted or updated one
    that resolves replaces what was there; one that does not resolve takes the fact back and joins the
    rejects, with flags for the keys that were missing or not found, in place of older rejects of that opportunity.  Archived
    opportunities are final.

    Changes with another ``op``, or without an opportunity, change nothing; the log says how many there were.  ``at`` names the
    column with a change's instant, for logs that come in that order: the newest is noted as the mark, changes before the mark are
    skipped and counted, and those without an instant are counted as rejected.
    """
    run_ts = utc(run_ts)
    batch = batch_id or f"changes{batch_name(run_ts)}"
    if loaded_before(wh, batch):
        return
    with logged(wh, batch, run_ts):
        timed, older = F.lit(True), 0
        if at is not None:
            mark = F.lit(wh.last_change("salespipeline")).cast("timestamp_ntz")
            timed = F.col(at).isNotNull()
            older = changes.filter(F.col(at) < mark).count()
            changes = changes.filter(~timed | (F.col(at) >= mark))
        named = F.col("opportunityid").isNotNull()
        newest_at = F.max(F.col(at)) if at is not None else F.lit(None).cast("timestamp_ntz")
        text = F.date_format(newest_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        n, bad, nulls, nameless, until = changes.agg(
            F.count(F.lit(1)), F.count_if(~known_op()), F.count_if(known_op() & ~timed), F.count_if(known_op() & timed & ~named), text).first()
        state, winners = _applied(wh, changes.filter(known_op() & timed & named), n, newest_by, batch, options)
        keys = winners.select("opportunityid")
        side = F.broadcast(keys) if fits(keys, n, options.max_broadcast) else keys
        final = archived_keys(wh, side, options)
        kept = wh.table("factrejects").drop(*KEY_FLAGS.values())
        stages = latest_per_key(src["dealstages"], "dealstageid", ())
        alive = winners.filter("op <> 'D'").join(final, "opportunityid", "left_anti")
        shaped = shape_pipeline(alive.drop("op"), stages, complete=False).select(*kept.columns)
        how = {"product": "as_of", "bounds": options.bounds, "emit": options.emit, **options.sizes}
        resolved = stage_resolved(wh, resolve_keys(shaped, dimensions_of(wh, {}), **how).flagged)
        waiting = _untouched(wh, side, options)
        rejects = wh.write("factrejects", waiting.unionByName(resolved.rejects), batch)
        entry, change = rewrite_months(wh, wh.table(FACT), keys, n, with_month(resolved.facts), batch, options)
        said = {
            "changes with an unknown op": bad, "changes without an instant": nulls, "changes without an opportunity": nameless, "changes older than the mark": older}
        entry = replace(entry, rows_read=n, rows_rejected=bad + nulls + nameless, message=", ".join(f"{x} {why}" for why, x in said.items() if x) or None)
        done: dict[str, Entry] = {FACT: entry, "factrejects": rejects}
        made = summaries.advanced(wh, done, change, batch, options)
        if entry.months:
            done[MONTHLY] = refresh_aggregate(wh, done, summaries.sales(wh, made), list(entry.months), batch, options)
        wh.commit(batch, run_ts, [*done.values(), *made.values(), state], {"changes:salespipeline": until} if until else {})


def _applied(
    wh: Warehouse, changes: DataFrame, n: int, newest_by: Sequence[str], batch: str, options: LoadOptions
) -> tuple[Entry, DataFrame]:
    """The newest change of each opportunity where it beats the state, written as the state's next directory."""
    order = ",".join(newest_by)
    held = wh.live(STATE)
    for entry in held:
        if entry.message != order:
            raise ValueError(f"the change log was ordered by {entry.message!r} before, not by {order!r}")
    if not held:
        beats = latest_per_key(changes, "opportunityid", newest_by)
    else:
        before, batch_rows = wh.side(held, changes.schema), changes
        keys = changes.select("opportunityid")
        if fits(keys, n, options.max_broadcast):
            # Few changes: only what the state has of their opportunities is shuffled.
            batch_rows = wh.stage("changes", latest_per_key(changes, "opportunityid", newest_by))
            before = before.join(F.broadcast(batch_rows.select("opportunityid")), "opportunityid", "left_semi")
        # Changes and state compete in one shuffle.  Of equal changes the one applied before sorts first.
        both = batch_rows.withColumn("_new", F.lit(True)).unionByName(before.withColumn("_new", F.lit(False)))
        beats = latest_per_key(both, "opportunityid", newest_by).filter("_new").drop("_new")
    entry = wh.write_side(STATE, beats, batch, message=order)
    return entry, wh.side([entry], changes.schema)


def _untouched(wh: Warehouse, side: DataFrame, options: LoadOptions) -> DataFrame:
    """Kept rejects of opportunities that ``side`` does not have."""
    rejects = wh.table("factrejects")
    keys = rejects.select("opportunityid")
    if fits(keys, wh.rows("factrejects"), options.max_broadcast):
        # Few rejects: of the changes only the keys that meet them are shuffled.
        side = side.join(F.broadcast(keys.distinct()), "opportunityid", "left_semi")
    return rejects.join(side, "opportunityid", "left_anti")


def fold_changes(wh: Warehouse, run_ts: str, batch_id: str | None = None) -> None:
    """Write the state of the change log as one directory with one change for each opportunity."""
    run_ts = utc(run_ts)
    held = wh.live(STATE)
    if not held:
        return
    batch = wh.fresh_batch(batch_id or f"fold{batch_name(run_ts)}")
    with logged(wh, batch, run_ts):
        order = held[0].message
        newest = latest_per_key(wh.side(held), "opportunityid", order.split(","))
        wh.commit(batch, run_ts, [wh.write_side(STATE, newest, batch, "replace", order)], {})


def apply_dimension_changes(
    src: Mapping[str, DataFrame],
    wh: Warehouse,
    table: str,
    changes: DataFrame,
    newest_by: Sequence[str],
    run_ts: str,
    batch_id: str | None = None,
) -> None:
    """Bring a dimension in line with a change log of ``accounts``, ``products`` or ``salesagents``.

    ``changes`` has the source table's columns and ``op``.  Accounts and agents are overwritten or
    removed; a changed product opens a version, a deleted one closes its current version the day
    before the run.  Facts keep the keys they have.  Keys that are new are noted, so that the next incremental run
    tries the rejects again that wait for them.
    """
    run_ts = utc(run_ts)
    batch = batch_id or f"{table}changes{batch_name(run_ts)}"
    if loaded_before(wh, batch):
        return
    name, key = {"accounts": ("dimaccount", "accountid"), "products": ("dimproduct", "productid"), "salesagents": ("dimsalesagent", "salesagentid")}[table]
    with logged(wh, batch, run_ts):
        latest = wh.stage("changes", latest_per_key(changes.filter(known_op()), key, newest_by))
        gone, kept = latest.filter("op = 'D'").select(key), latest.filter("op <> 'D'")
        dim = wh.table(name)
        if table == "products":
            rows = product_rows(kept, src["productseries"])
            left = scd2_apply(dim, scd2_changes(dim, rows), run_ts[:10])
            closes = F.col("_gone").isNotNull() & F.col("iscurrent")
            end = F.greatest(F.date_sub(F.lit(run_ts[:10]).cast("date"), 1), F.col("validfrom"))
            new = left.join(gone.withColumn("_gone", F.lit(1)), key, "left").withColumns(
                {"validto": F.when(closes, end).otherwise(F.col("validto")), "iscurrent": F.col("iscurrent") & ~closes}).select(*dim.columns)
        else:
            rows = account_rows(kept, src["sectors"]) if table == "accounts" else agent_rows(kept, src["salesmanagers"], src["locations"])
            new = delete_by_key(scd1_upsert(dim, rows, key), gone, key)
        n, bad = changes.agg(F.count(F.lit(1)), F.count_if(~known_op())).first()
        entry = replace(wh.write(name, new, batch), rows_read=n, rows_rejected=bad, message=f"{bad} changes with an unknown op" if bad else None)
        wh.commit(batch, run_ts, [entry, note_arrivals(wh, entry, batch)], {})


def archive_facts(wh: Warehouse, before_month: int, run_ts: str, batch_id: str | None = None) -> None:
    """Move the facts of months before ``before_month`` (yyyymm) to the archive table.

    The archived months are written once, to the archive; the other months keep their files.
    """
    run_ts = utc(run_ts)
    batch = batch_id or f"archive{batch_name(run_ts)}"
    if loaded_before(wh, batch):
        return
    with logged(wh, batch, run_ts):
        facts = wh.table(FACT)
        old = facts.filter(F.col("year") * 100 + F.col("month") < before_month)
        months = months_of(old)
        if months:
            moved = wh.write("factsarchive", old, batch, action="append")
            emptied = wh.write(FACT, old.filter(F.lit(False)), batch, action="append", months=months)
            made = {}
            if summaries.current(wh):
                keys = facts.join(old.select("opportunityid").distinct(), "opportunityid", "left_semi")
                stay = keys.filter(F.col("year") * 100 + F.col("month") >= before_month)
                change = summaries.Change(removed=old, before=keys, after=stay, archived=True)
                made = summaries.advanced(wh, {FACT: emptied, "factsarchive": moved}, change, batch)
            wh.commit(batch, run_ts, [moved, emptied, *made.values()], {})


def compact(wh: Warehouse, name: str, run_ts: str, batch_id: str | None = None) -> None:
    """Write a table that many loads have added to as one directory, which replaces them all.

    Reading it then lists one directory and filters no replaced months.
    """
    run_ts = utc(run_ts)
    batch = wh.fresh_batch(batch_id or f"compact{name}{batch_name(run_ts)}")
    with logged(wh, batch, run_ts):
        known = name in (FACT, "factsarchive") and summaries.current(wh)
        entry = wh.write(name, wh.table(name), batch)
        made = summaries.advanced(wh, {name: entry}, summaries.Change(), batch) if known else {}
        wh.commit(batch, run_ts, [entry, *made.values()], {})
