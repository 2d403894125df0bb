"""Summaries kept by loads against one pass over the facts."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmart.operators.aggregates import monthly_sales
from starmart.operators.summaries import merged_sales, merged_uses, monthly_from_lines, repeat_lines, sales_lines, signed, use_lines
from starmart.plans import LoadOptions, apply_dimension_changes, apply_pipeline_changes, archive_facts, compact, incremental_load, initial_load, summaries
from starmart.schemas import SOURCE_DDL, WAREHOUSE_DDL
from starmart.sources.warehouse import Warehouse

T0 = datetime(2024, 1, 1)
FACTS = WAREHOUSE_DDL["factsalesperformance"] + ", year INT, month INT"


def deal(opp, agent, stage, closed, value, at, product=1, account=0):
    return (opp, agent, product, account, stage, date(2023, 1, 1), closed, value, at, at)


def frame(spark, name, rows):
    return spark.createDataFrame(rows, SOURCE_DDL[name])


@pytest.fixture(scope="module")
def src(spark):
    return {
        "accounts": frame(spark, "accounts", [(0, "a", 1, 2000, Decimal(5), 1, 1, None, T0, T0)]),
        "sectors": frame(spark, "sectors", [(1, "x")]),
        "products": frame(spark, "products", [(1, "p", 1, Decimal(5), T0)]),
        "productseries": frame(spark, "productseries", [(1, "s")]),
        "salesagents": frame(spark, "salesagents", [(5, "a5", 1, 1, T0), (6, "a6", 1, 2, T0)]),
        "salesmanagers": frame(spark, "salesmanagers", [(1, "m")]),
        "locations": frame(spark, "locations", [(1, "East"), (2, "West"), (3, "North")]),
        "dealstages": frame(spark, "dealstages", [(1, "Prospecting"), (4, "Won")]),
        "salespipeline": frame(spark, "salespipeline", [
            deal("A", 5, 1, date(2023, 5, 1), Decimal("0.10"), T0), deal("B", 6, 4, date(2023, 5, 2), None, T0),
            deal("C", 5, 4, date(2023, 6, 1), Decimal("0.20"), T0), deal("D", 6, 1, date(2022, 6, 1), Decimal("7.00"), T0)]),
    }


def agrees(wh):
    """The stored aggregate and the checks are those of a pass over the facts."""
    both = wh.table("factsalesperformance").unionByName(wh.table("factsarchive"))
    full = monthly_sales(both, wh.table("dimdate"), wh.table("dimsalesagent"), wh.rows("dimsalesagent"))
    made = wh.table("factsalesmonthlyaggregate")
    assert sorted(map(tuple, made.select(*full.columns).collect())) == sorted(map(tuple, full.collect()))
    assert summaries.current(wh)
    one, other = [{r.check_name: r.violations for r in summaries.checks(wh, LoadOptions(validate=v)).collect()} for v in (True, "full")]
    assert one == other
    return one


def changed(src, spark, *rows):
    return {**src, "salespipeline": src["salespipeline"].unionByName(frame(spark, "salespipeline", list(rows)))}


def test_loads(spark, src, tmp_path, monkeypatch):
    """Upserts, a change log, an agent who moves, an archive, a fold and a compaction: no step reads all facts, all agree."""
    wh = Warehouse(spark, str(tmp_path / "wh"))
    upsert = LoadOptions(fact_mode="upsert")
    initial_load(src, wh, "2024-02-01T00:00:00", options=LoadOptions(marks_after_full="run_ts"))
    assert not any(agrees(wh).values())

    def not_again(*_):
        raise AssertionError("made anew")

    monkeypatch.setattr(summaries, "whole", not_again)
    at = datetime(2024, 2, 2)
    now = changed(src, spark, deal("A", 6, 4, date(2023, 7, 1), Decimal("3.00"), at), deal("E", 5, 1, date(2023, 6, 3), None, at))
    incremental_load(now, wh, "2024-02-03T00:00:00", options=upsert)
    agrees(wh)
    # No fact comes; agent 5 moves from East to North.
    moved = {**now, "salesagents": frame(spark, "salesagents", [(5, "a5", 1, 3, datetime(2024, 2, 4)), (6, "a6", 1, 2, T0)])}
    incremental_load(moved, wh, "2024-02-05T00:00:00", options=upsert)
    assert {r.region for r in wh.table("factsalesmonthlyaggregate").collect()} == {"West", "North"}
    agrees(wh)
    log = frame(spark, "salespipeline", [deal("C", 5, 4, date(2023, 6, 1), None, at), deal("E", 6, 1, date(2023, 8, 3), Decimal("1.00"), at)])
    log = log.withColumn("op", F.when(F.col("opportunityid") == "C", "D").otherwise("U"))
    apply_pipeline_changes(moved, wh, log, ["updated_at"], "2024-02-06T00:00:00")
    agrees(wh)
    archive_facts(wh, 202301, "2024-02-07T00:00:00")
    assert wh.rows("factsarchive") == 1
    agrees(wh)
    monkeypatch.setattr(summaries, "FOLD_AFTER", 2)
    later = changed(moved, spark, deal("F", 5, 1, date(2023, 9, 1), Decimal("2.00"), datetime(2024, 2, 8)))
    incremental_load(later, wh, "2024-02-09T00:00:00")
    assert len(wh.live(summaries.SALES)) == 1
    agrees(wh)
    compact(wh, "factsalesperformance", "2024-02-10T00:00:00")
    assert not any(agrees(wh).values())


def test_faults_are_counted(spark, src, tmp_path):
    """Repeated opportunities of appending loads, and keys that a dimension loses, are seen without reading the facts."""
    wh = Warehouse(spark, str(tmp_path / "wh"))
    initial_load(src, wh, "2024-02-01T00:00:00", options=LoadOptions(marks_after_full="run_ts"))
    at = datetime(2024, 2, 2)
    more = changed(src, spark, *[deal("A", 5, 1, date(2023, 5, 1), None, at)] * 2, deal("G", 5, 1, date(2023, 5, 1), None, at))
    incremental_load(more, wh, "2024-02-03T00:00:00", options=LoadOptions(fact_mode="insert_only"))
    assert agrees(wh)["fact_key_unique"] == 1
    again = changed(more, spark, deal("G", 5, 1, date(2023, 5, 1), None, datetime(2024, 2, 4)))
    incremental_load(again, wh, "2024-02-05T00:00:00", options=LoadOptions(fact_mode="insert_only"))
    assert agrees(wh)["fact_key_unique"] == 2
    archive_facts(wh, 202306, "2024-02-06T00:00:00")
    assert agrees(wh)["fact_key_unique"] == 0
    gone = src["salesagents"].filter("salesagentid = 5").withColumn("op", F.lit("D"))
    apply_dimension_changes(src, wh, "salesagents", gone, ["updated_at"], "2024-02-07T00:00:00")
    one, other = [{r.check_name: r.violations for r in summaries.checks(wh, LoadOptions(validate=v)).collect()} for v in (True, "full")]
    assert one == other and one["orphan_agent"] == 1


def test_facts_changed_elsewhere(spark, src, tmp_path):
    """A directory of facts that no load summarised is noticed, and the summaries are made anew."""
    wh = Warehouse(spark, str(tmp_path / "wh"))
    initial_load(src, wh, "2024-02-01T00:00:00", options=LoadOptions(marks_after_full="run_ts"))
    kept = wh.table("factsalesperformance").filter("opportunityid <> 'A'")
    wh.commit("by hand", "2024-02-02T00:00:00", [wh.write("factsalesperformance", kept, "byhand")], {})
    assert not summaries.current(wh)
    more = changed(src, spark, deal("H", 5, 1, date(2023, 5, 9), None, datetime(2024, 2, 2)))
    incremental_load(more, wh, "2024-02-03T00:00:00")
    agrees(wh)


def test_lines(spark):
    """Nulls in any column, repeated rows, rows taken out again, no rows at all."""
    t = datetime(2024, 1, 1)
    rows = [("A", 20240105, 1, 1, 5, 4, Decimal("1.10"), 3, 100.0, t, 2024, 1)] * 2 + [
        ("B", 20240105, None, 1, 5, 4, None, None, None, None, 2024, 1), (None, None, None, None, None, None, None, None, None, None, None, None)]
    facts = spark.createDataFrame(rows, FACTS)
    agents = spark.createDataFrame([(5, None)], "salesagentid BIGINT, region STRING")
    out = monthly_from_lines(sales_lines(signed(facts, None, facts)), agents, 1).collect()
    assert [tuple(r) for r in out] == [(2024, 1, "Unknown", 4, 3, 2.2, 1.1, 3.0, 100.0)]
    only_null = facts.filter("opportunityid = 'B'")
    assert monthly_from_lines(sales_lines(signed(only_null, None, facts)), agents, 1).collect()[0].totalclosevalue is None
    uses = {(r.kind, r.key): r.n for r in merged_uses(use_lines(signed(facts, None, facts))).collect()}
    assert uses[("null", None)] == 2 and uses[("account", 1)] == 2 and uses[("month", 202401)] == 3
    assert merged_sales(sales_lines(signed(facts, facts, facts))).isEmpty() and merged_uses(use_lines(signed(facts, facts, facts))).isEmpty()
    assert sales_lines(signed(None, None, facts)).isEmpty() and use_lines(signed(None, None, facts)).isEmpty()
    assert repeat_lines(None, facts, facts).first().n == 1 and repeat_lines(facts, None, facts).first().n == -1
    assert repeat_lines(None, None, facts).first().n == 0
