"""Recompute the monthly aggregate from the committed facts."""

from __future__ import annotations

from starmart.operators.aggregates import monthly_sales
from starmart.plans.options import LoadOptions, batch_name, logged, utc
from starmart.sources.warehouse import Warehouse


def refresh_monthly(
    wh: Warehouse, run_ts: str, batch_id: str | None = None, options: LoadOptions = LoadOptions()
) -> None:
    """Full refresh over facts and archive; readers see either the old aggregate or the new one, never an empty table."""
    run_ts = utc(run_ts)
    batch = wh.fresh_batch(batch_id or f"monthly{batch_name(run_ts)}")
    with logged(wh, batch, run_ts):
        monthly = monthly_sales(
            wh.table("factsalesperformance").unionByName(wh.table("factsarchive")),
            wh.table("dimdate"),
            wh.table("dimsalesagent"),
            wh.rows("dimsalesagent"),
            max_broadcast=options.max_broadcast,
        )
        wh.commit(batch, run_ts, [wh.write("factsalesmonthlyaggregate", monthly, batch)], {})
