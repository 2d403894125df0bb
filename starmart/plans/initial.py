"""Full load: every dimension, the facts, the rejects, the aggregate, then the marks."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame

from starmart.operators.dates import date_dimension, known_bounds, seen_dates
from starmart.operators.dims import account_rows, agent_rows, product_rows, stage_rows
from starmart.operators.facts import first_order, incomplete, shape_pipeline, with_month
from starmart.operators.dedup import first_per_key, latest_per_key
from starmart.operators.resolve import Dimensions, Resolved, packed, resolve_keys, unpacked
from starmart.operators.scd import scd2_initialize
from starmart.operators.summaries import monthly_from_lines as monthly_sales
from starmart.plans import summaries
from starmart.plans.options import LoadOptions, batch_name, logged, utc
from starmart.schemas import STORED_FACT, schema_of
from starmart.sources.readers import text_edges
from starmart.sources.warehouse import MARKED_TABLES, NO_MARK, Entry, Warehouse

FACT = "factsalesperformance"
MONTHLY = "factsalesmonthlyaggregate"
#: Tables that loads keep for themselves: a full load empties them.
SIDE_TABLES = ("changestate", "arrivals")


def dimensions_of(wh: Warehouse, entries: Mapping[str, Entry]) -> Dimensions:
    """Dimensions as written by a running load, falling back to the committed ones."""

    def read(name: str) -> DataFrame:
        return wh.read(name, [entries[name]]) if name in entries else wh.table(name)

    def rows(name: str) -> int:
        return entries[name].rows_written if name in entries else wh.rows(name)

    return Dimensions(
        read("dimdate"),
        read("dimaccount"),
        read("dimproduct"),
        read("dimsalesagent"),
        read("dimdealstage"),
        {
            "account": rows("dimaccount"),
            "product": rows("dimproduct"),
            "agent": rows("dimsalesagent"),
            "stage": rows("dimdealstage"),
        },
    )


def stage_resolved(wh: Warehouse, flagged: DataFrame) -> Resolved:
    """Resolved rows written once, for facts, rejects and months that are all taken from them."""
    return Resolved(unpacked(wh.stage("resolved", packed(flagged)), flagged))


def left_out(rows: int) -> str | None:
    """What the log says of pipeline rows that cannot be facts."""
    return f"{rows} rows without a key or date" if rows else None


def initial_load(
    src: Mapping[str, DataFrame],
    wh: Warehouse,
    run_ts: str,
    batch_id: str | None = None,
    options: LoadOptions = LoadOptions(),
) -> None:
    """Replace the whole warehouse from the source.

    Product keys are those of the current (only) version; of repeated opportunities the first
    is kept, of repeated accounts, products, agents and stages the newest row.  The archive is
    emptied.  Readers see the old warehouse until the commit at the end.
    """
    run_ts = utc(run_ts)
    batch = wh.fresh_batch(batch_id or f"full{batch_name(run_ts)}")
    with logged(wh, batch, run_ts):
        def newest(rows: DataFrame, key: str) -> DataFrame:
            return latest_per_key(rows, key, ["updated_at"]).drop("updated_at")

        seen = seen_dates(src["salespipeline"], incomplete()).first()
        span = known_bounds(wh.spark, seen)
        accounts = account_rows(src["accounts"], src["sectors"], "updated_at")
        products = product_rows(src["products"], src["productseries"], "updated_at")
        agents = agent_rows(src["salesagents"], src["salesmanagers"], src["locations"], "updated_at")
        dims = {
            "dimdate": date_dimension(span),
            "dimaccount": newest(accounts, "accountid"),
            "dimproduct": scd2_initialize(newest(products, "productid")),
            "dimsalesagent": newest(agents, "salesagentid"),
            "dimdealstage": stage_rows(src["dealstages"]),
            "factsarchive": wh.read("factsarchive", []),
        }
        done = wh.write_all(dims, batch)
        loaded = dimensions_of(wh, done)

        shaped = shape_pipeline(src["salespipeline"], latest_per_key(src["dealstages"], "dealstageid", ()))
        kept = shaped.select(*[c for c in schema_of("factrejects").fieldNames() if c in shaped.columns])
        flagged = resolve_keys(kept, loaded, product="current", emit=options.emit, **options.sizes).flagged
        # The pipeline is resolved once; facts and rejects are taken from the result.
        resolved = stage_resolved(wh, flagged)
        first = first_per_key(resolved.facts, "opportunityid", first_order())
        facts = with_month(first.select(*STORED_FACT))
        if options.fact_ranges > 1:
            edges = text_edges(resolved.facts, "opportunityid", options.fact_ranges)
            parts = wh.write_in_ranges(FACT, facts, batch, run_ts, "opportunityid", edges)
            done["factrejects"] = wh.write("factrejects", resolved.rejects, batch)
        else:
            done |= wh.write_all({FACT: facts, "factrejects": resolved.rejects}, batch)
            parts = [done.pop(FACT)]
        # The first line carries the counts of the whole load.
        parts[0] = replace(parts[0], rows_read=seen["rows"], rows_rejected=done["factrejects"].rows_written, message=left_out(seen["unusable"]))
        made = summaries.whole(wh, {FACT: parts, **{name: [done[name]] for name in ("factsarchive", "dimsalesagent")}}, batch, options)
        monthly = monthly_sales(summaries.sales(wh, made), loaded.agent, loaded.rows["agent"], options.max_broadcast)
        done[MONTHLY] = wh.write(MONTHLY, monthly, batch)
        mark = run_ts if options.marks_after_full == "run_ts" else NO_MARK
        marks = {t: mark for t in MARKED_TABLES}
        # What was applied from change logs is part of the source now.
        states = [Entry(t, "reset") for t in SIDE_TABLES if wh.live(t)]
        if wh.last_change("salespipeline") != NO_MARK:
            marks["changes:salespipeline"] = NO_MARK
        wh.commit(batch, run_ts, [*done.values(), *parts, *made.values(), *states], marks)
        if options.validate:
            wh.note_checks(batch, run_ts, summaries.checks(wh, options))
