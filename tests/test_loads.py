"""Whole loads over a small source: scenarios, reruns, failures, modes, streams."""

from __future__ import annotations

import shutil
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmart.functions import scale_price, suffix_once
from starmart.operators.changes import update_by_key
from starmart.operators.quality import validate_warehouse
from starmart.plans import (
    LoadOptions,
    apply_pipeline_changes,
    apply_dimension_changes,
    archive_facts,
    compact,
    incremental_load,
    initial_load,
    refresh_monthly,
)
from starmart.plans import initial as initial_plan
from starmart.schemas import SOURCE_DDL, schema_of
from starmart.sources.readers import read_source
from starmart.sources.warehouse import NO_MARK, Entry, Warehouse
from starmart.streaming.incremental import file_stream, stream_incremental

T0 = datetime(2024, 1, 1)
RUN1, RUN2, RUN3 = "2024-02-01T00:00:00", "2024-03-01T00:00:00", "2024-03-02T00:00:00"
NOW = datetime(2024, 2, 15)


def deal(opp, agent, product, account, stage, closed=date(2024, 1, 20), value="100.00", at=T0):
    return (opp, agent, product, account, stage, closed - timedelta(days=10), closed, Decimal(value), at, at)


def table(spark, name, data):
    return spark.createDataFrame(data, SOURCE_DDL[name])


@pytest.fixture(scope="module")
def src(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("src"))
    data = {
        "accounts": [(i, f"acc{i}", 1, 2000, Decimal("5000000"), 10, 1, None, T0, T0) for i in (0, 83)],
        "sectors": [(1, "tech")],
        "products": [(i, f"prod{i}", 1, Decimal("55.00"), T0) for i in (1, 3)],
        "productseries": [(1, "S")],
        "salesagents": [(5, "a5", 1, 1, T0), (32, "a32", 1, 2, T0)],
        "salesmanagers": [(1, "m1"), (5, "m5")],
        "locations": [(1, "East"), (2, "West")],
        "dealstages": [(1, "Prospecting"), (4, "Won")],
        "salespipeline": [deal("SBCR987L", 32, 1, 83, 1, value="590.00"), deal("OTHER", 5, 3, 0, 4, date(2023, 12, 5)),
                          deal("NOACC", 5, 3, 777, 4)],
    }
    for name, rows in data.items():
        table(spark, name, rows).coalesce(1).write.parquet(f"{root}/{name}")
    return dict(read_source(spark, root))


@pytest.fixture(scope="module")
def loaded(spark, src, tmp_path_factory):
    """Warehouses after a full load, with the marks reset and with the marks at the load."""
    roots = {}
    for marks in ("reset", "run_ts"):
        roots[marks] = tmp_path_factory.mktemp("loaded") / "wh"
        initial_load(src, Warehouse(spark, str(roots[marks])), RUN1, options=LoadOptions(marks_after_full=marks))
    return roots


def copy_of(spark, root, tmp_path):
    shutil.copytree(root, tmp_path / "wh")
    return Warehouse(spark, str(tmp_path / "wh"))


@pytest.fixture
def empty(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "empty"))


@pytest.fixture
def wh(spark, loaded, tmp_path):
    return copy_of(spark, loaded["reset"], tmp_path)


@pytest.fixture
def wh_marked(spark, loaded, tmp_path):
    return copy_of(spark, loaded["run_ts"], tmp_path)


def facts(wh):
    return {r.opportunityid: r for r in wh.table("factsalesperformance").collect()}


def violations(wh):
    return {r.check_name: r.violations for r in validate_warehouse(wh.tables()).collect() if r.violations}


def plus(src, name, spark, *data):
    return {**src, name: src[name].unionByName(table(spark, name, list(data)))}


def scenario1(spark, src):
    """A new account with a new deal, an agent under another manager, a deal won at a higher value."""
    now = plus(src, "accounts", spark, (99999, "Test New Account Inc - ID 99999", 1, 2025, Decimal("50000.00"), 10, 1, None, NOW, NOW))
    now = plus(now, "salespipeline", spark, deal("TEST_S1_manual01", 5, 3, 99999, 1, value="1234.56", at=NOW))
    agent = spark.createDataFrame([(5, 5, NOW)], "salesagentid BIGINT, managerid BIGINT, updated_at TIMESTAMP_NTZ")
    now["salesagents"] = update_by_key(now["salesagents"], agent, "salesagentid")
    won = spark.createDataFrame([("SBCR987L", 4, Decimal("650.00"), NOW)],
                                "opportunityid STRING, dealstageid BIGINT, closevalue DECIMAL(18,2), updated_at TIMESTAMP_NTZ")
    now["salespipeline"] = update_by_key(now["salespipeline"], won, "opportunityid")
    return now


def test_initial_load(src, wh):
    assert set(facts(wh)) == {"SBCR987L", "OTHER"}
    rejected = wh.table("factrejects").collect()
    assert [(r.opportunityid, r.missing_account, r.missing_date) for r in rejected] == [("NOACC", True, False)]
    assert violations(wh) == {}
    assert set(wh.marks().values()) == {NO_MARK + ".000000"}
    months = {(r.year, r.month, r.region): r.totaldealcount for r in wh.table("factsalesmonthlyaggregate").collect()}
    assert months == {(2024, 1, "West"): 1, (2023, 12, "East"): 1}
    assert wh.table("dimproduct").filter("validfrom = DATE '1900-01-01' AND iscurrent").count() == 2


def test_incremental_after_full_load_adds_nothing(src, wh, rows):
    before = {n: rows(t) for n, t in wh.tables().items()}
    incremental_load(src, wh, RUN2)
    assert {n: rows(t) for n, t in wh.tables().items()} == before
    assert set(wh.marks().values()) == {RUN2 + ".000000"}
    incremental_load(src, wh, RUN3)
    assert {n: rows(t) for n, t in wh.tables().items()} == before


@pytest.mark.parametrize("mode", ["insert_only", "upsert"])
def test_scenario_1(spark, src, wh_marked, mode):
    options = LoadOptions(fact_mode=mode, marks_after_full="run_ts")
    incremental_load(scenario1(spark, src), wh_marked, RUN2, options=options)
    assert wh_marked.table("dimaccount").filter("accountid = 99999").first().revenuerange == "Under 1M"
    assert wh_marked.table("dimsalesagent").filter("salesagentid = 5").first().managername == "m5"
    fact = wh_marked.table("factsalesperformance")
    assert fact.filter("accountkey = 99999").count() == 1
    sk = wh_marked.table("dimproduct").filter("productid = 1 AND iscurrent").first().productsk
    won = (F.col("accountkey") == 83) & (F.col("productkey") == sk) & (F.col("salesagentkey") == 32) & (F.col("dealstagekey") == 4)
    assert fact.filter(won & (F.col("closevalue") == Decimal("650.00"))).count() == 1
    assert fact.filter("opportunityid = 'SBCR987L'").count() == (2 if mode == "insert_only" else 1)
    assert set(violations(wh_marked)) <= ({"fact_key_unique"} if mode == "insert_only" else set())
    incremental_load(scenario1(spark, src), wh_marked, RUN2, options=options)
    assert wh_marked.table("factsalesperformance").count() == (4 if mode == "insert_only" else 3)


def test_scenario_2(spark, src, wh):
    changed = src["products"].filter("productid = 3").select(
        "productid", suffix_once(F.col("productname"), " (Updated Scenario 2)").alias("productname"),
        scale_price(F.col("salesprice"), "1.1").alias("salesprice"), F.lit(NOW).alias("updated_at"))
    incremental_load({**src, "products": update_by_key(src["products"], changed, "productid")}, wh, RUN2)
    old, new = wh.table("dimproduct").filter("productid = 3").orderBy("validfrom").collect()
    assert new.iscurrent and new.validto is None and new.productname == "prod3 (Updated Scenario 2)" and new.price == Decimal("60.50")
    assert not old.iscurrent and old.validto == date(2024, 2, 29) and new.validfrom == date(2024, 3, 1)
    assert violations(wh) == {}


def test_a_failed_load_publishes_nothing_and_can_be_repeated(spark, src, wh, monkeypatch):
    before = set(facts(wh))

    def fail(self, *a, **k):
        raise RuntimeError("lost before the commit")

    with monkeypatch.context() as m:
        m.setattr(Warehouse, "commit", fail)
        with pytest.raises(RuntimeError):
            incremental_load(scenario1(spark, src), wh, RUN2)
    fresh = Warehouse(spark, wh.root)
    assert set(facts(fresh)) == before and set(fresh.marks().values()) == {NO_MARK + ".000000"}
    assert [r.message for r in fresh.errors().collect()] == ["RuntimeError: lost before the commit"]
    incremental_load(scenario1(spark, src), fresh, RUN2)
    assert set(facts(fresh)) == before | {"TEST_S1_manual01"}
    assert violations(fresh) == {}


def test_rejects_wait_for_their_dimension_row(spark, src, wh_marked):
    options = LoadOptions(marks_after_full="run_ts")
    late = plus(src, "accounts", spark, (777, "late", 1, 2000, None, 1, 1, None, NOW, NOW))
    incremental_load(late, wh_marked, RUN2, options=options)
    assert set(facts(wh_marked)) == {"SBCR987L", "OTHER", "NOACC"} and wh_marked.table("factrejects").count() == 0
    assert violations(wh_marked) == {}


def test_new_stage_and_new_year_reach_the_dimensions(spark, src, wh):
    now = plus(src, "dealstages", spark, (7, "Paused"))
    now = plus(now, "salespipeline", spark, deal("NEXT", 5, 3, 0, 7, date(2026, 1, 2), at=NOW))
    incremental_load(now, wh, RUN2)
    assert facts(wh)["NEXT"].datekey == 20260102
    assert wh.table("dimdate").count() == 365 + 366 + 365 + 365
    assert violations(wh) == {}


def test_an_agent_moving_region_moves_earlier_months(spark, src, wh):
    move = spark.createDataFrame([(5, 2, NOW)], "salesagentid BIGINT, regionalofficeid BIGINT, updated_at TIMESTAMP_NTZ")
    incremental_load({**src, "salesagents": update_by_key(src["salesagents"], move, "salesagentid")}, wh, RUN2)
    assert {r.region for r in wh.table("factsalesmonthlyaggregate").collect()} == {"West"}


def test_refresh_monthly_agrees_with_the_incremental_aggregate(spark, src, wh, rows):
    incremental_load(scenario1(spark, src), wh, RUN2, options=LoadOptions(fact_mode="upsert"))
    before = rows(wh.table("factsalesmonthlyaggregate"))
    refresh_monthly(wh, RUN3)
    assert rows(wh.table("factsalesmonthlyaggregate")) == before


def test_change_log_deletes_and_replaces(spark, src, wh):
    log = spark.createDataFrame(
        [(*deal("OTHER", 5, 3, 0, 4), "D", 2), (*deal("OTHER", 5, 3, 0, 4), "U", 1), (*deal("SBCR987L", 32, 1, 83, 4, value="650.00"), "U", 1),
         (*deal("ADDED", 5, 3, 0, 4), "I", 1), (*deal("BAD", 5, 3, 555, 4), "I", 1)],
        SOURCE_DDL["salespipeline"] + ", op STRING, seq INT")
    apply_pipeline_changes(src, wh, log, ["seq"], RUN2)
    got = facts(wh)
    assert set(got) == {"SBCR987L", "ADDED"} and got["SBCR987L"].closevalue == Decimal("650.00")
    assert {r.opportunityid for r in wh.table("factrejects").collect()} == {"NOACC", "BAD"}
    assert violations(wh) == {}


def test_archive_moves_old_months(src, wh):
    archive_facts(wh, 202401, RUN2)
    assert set(facts(wh)) == {"SBCR987L"}
    assert [r.opportunityid for r in wh.table("factsarchive").collect()] == ["OTHER"]
    archive_facts(wh, 202401, RUN2)
    assert wh.table("factsarchive").count() == 1


def test_create_all_marks_lineage_and_empty_reads(spark, src, empty):
    assert empty.table("factsalesperformance").columns[-2:] == ["year", "month"]
    empty.create_all()
    assert {n: t.count() for n, t in empty.tables().items()} == {n: 0 for n in empty.tables()}
    initial_load(src, empty, RUN1, batch_id="first")
    assert {r.batch for r in empty.table("factsalesperformance", lineage=True).collect()} == {"first"}
    empty.create_all("emptied", RUN2)
    assert empty.table("factsalesperformance").count() == 0


def test_repeating_a_full_load_does_not_touch_live_directories(spark, src, wh):
    before = {e.path for name in wh.tables() for e in wh.live(name)}
    initial_load(src, wh, RUN1)
    refresh_monthly(wh, RUN1)
    refresh_monthly(wh, RUN1)
    after = {e.path for name in wh.tables() for e in wh.live(name)}
    assert not before & after and violations(wh) == {}
    incremental_load(scenario1(spark, src), wh, RUN1 + ".5")
    incremental_load(scenario1(spark, src), wh, RUN2)
    assert "TEST_S1_manual01" in facts(wh)


def test_unreadable_marks(empty):
    with pytest.raises(ValueError):
        empty.commit("b", RUN1, [], {"accounts": "soon"})
    empty._append("b", RUN1, [Entry("accounts", "mark", mark="soon"), Entry("products", "mark", mark="2024-01-01T02:00:00+02:00")])
    marks = empty.marks()
    assert marks["accounts"].startswith("1970-01-01T00:00:00") and marks["products"] == "2024-01-01T00:00:00.000000"


def test_overlap_reads_late_rows(spark, src, wh_marked):
    at = datetime(2024, 2, 1) - timedelta(seconds=30)
    now = plus(src, "salespipeline", spark, deal("LATE", 5, 3, 0, 4, at=at))
    incremental_load(now, wh_marked, RUN2)
    assert "LATE" not in facts(wh_marked)
    later = plus(now, "salespipeline", spark, deal("LATE2", 5, 3, 0, 4, at=datetime(2024, 3, 1) - timedelta(seconds=30)))
    incremental_load(later, wh_marked, RUN3, options=LoadOptions(overlap_seconds=60))
    assert "LATE2" in facts(wh_marked) and violations(wh_marked) == {}


def test_ranged_load_resumes(spark, empty, monkeypatch):
    df = spark.range(100).select(F.col("id").alias("stageid"), F.lit("s").alias("stagename"))
    ranges = [(None, 24), (24, 74), (74, None)]
    empty.write_in_ranges("dimdealstage", df, "r", RUN1, "stageid", ranges[:2])
    written, write = [], Warehouse.write
    monkeypatch.setattr(Warehouse, "write", lambda self, name, d, batch, *a, **k: written.append(batch) or write(self, name, d, batch, *a, **k))
    entries = empty.write_in_ranges("dimdealstage", df, "r", RUN1, "stageid", ranges)
    assert [w.split("x")[0] for w in written] == ["rpart00002"] and empty.table("dimdealstage").count() == 0
    empty.commit("r", RUN1, entries, {})
    assert empty.table("dimdealstage").count() == 100 and empty.rows("dimdealstage") == 100


def test_ranges_with_other_edges_are_not_taken_for_done(spark, empty):
    df = spark.range(100).select(F.col("id").alias("stageid"), F.lit("s").alias("stagename"))
    first, other = [(None, 24), (24, 74), (74, None)], [(None, 10), (10, 60)]
    empty.write_in_ranges("dimdealstage", df, "r", RUN1, "stageid", first)
    empty.write_in_ranges("dimdealstage", df, "r", RUN1, "stageid", other)
    empty.commit("r", RUN1, empty.write_in_ranges("dimdealstage", df, "r", RUN1, "stageid", first), {})
    assert empty.table("dimdealstage").count() == 100 == empty.rows("dimdealstage")


def test_an_archive_stays_after_the_next_run(src, wh):
    archive_facts(wh, 202401, RUN2)
    for mode, run in (("insert_if_absent", RUN3), ("upsert", "2024-03-03T00:00:00"), ("insert_only", "2024-03-04T00:00:00")):
        incremental_load(src, Warehouse(wh.spark, wh.root), run, options=LoadOptions(fact_mode=mode, overlap_seconds=10**8))
        fresh = Warehouse(wh.spark, wh.root)
        assert set(facts(fresh)) == {"SBCR987L"} and [r.opportunityid for r in fresh.table("factsarchive").collect()] == ["OTHER"]
    refresh_monthly(wh, "2024-03-05T00:00:00")
    months = {(r.year, r.month) for r in wh.table("factsalesmonthlyaggregate").collect()}
    assert months == {(2024, 1), (2023, 12)}
    initial_load(src, wh, "2024-03-06T00:00:00")
    assert set(facts(wh)) == {"SBCR987L", "OTHER"} and wh.table("factsarchive").count() == 0


def test_a_stale_reject_does_not_overwrite_a_newer_fact(spark, src, wh_marked):
    upsert = LoadOptions(fact_mode="upsert")
    old = plus(src, "salespipeline", spark, deal("BACK", 5, 3, 555, 4, value="100.00", at=datetime(2024, 2, 10)))
    incremental_load(old, wh_marked, "2024-02-11T00:00:00", options=upsert)
    new = plus(old, "salespipeline", spark, deal("BACK", 5, 3, 0, 4, value="999.00", at=datetime(2024, 2, 12)))
    incremental_load(new, wh_marked, "2024-02-13T00:00:00", options=upsert)
    assert facts(wh_marked)["BACK"].closevalue == Decimal("999.00")
    late = plus(new, "accounts", spark, (555, "late", 1, 2000, None, 1, 1, None, NOW, NOW))
    incremental_load(late, wh_marked, RUN2, options=upsert)
    assert facts(wh_marked)["BACK"].closevalue == Decimal("999.00")
    assert "BACK" not in {r.opportunityid for r in wh_marked.table("factrejects").collect()}


def test_a_run_with_an_offset_loses_nothing(spark, src, wh_marked):
    now = plus(src, "salespipeline", spark, deal("OFF", 5, 3, 0, 4, at=datetime(2024, 3, 1, 1)))
    incremental_load(now, wh_marked, "2024-03-01T00:00:00-02:00")
    assert "OFF" in facts(wh_marked) and set(wh_marked.marks().values()) == {"2024-03-01T02:00:00.000000"}
    incremental_load(now, wh_marked, "2024-03-01T00:00:00+02:00")  # another batch, though the digits are the same
    assert wh_marked.committed("20240229T220000")


def test_changes_with_an_unknown_op_change_nothing(spark, src, wh):
    log = spark.createDataFrame([(*deal("OTHER", 5, 3, 0, 4), None, 1), (*deal("SBCR987L", 32, 1, 83, 4), "d", 1), (*deal("NEW", 5, 3, 0, 4), "I", 1)],
                                SOURCE_DDL["salespipeline"] + ", op STRING, seq INT")
    apply_pipeline_changes(src, wh, log, ["seq"], RUN2)
    got = facts(wh)
    assert set(got) == {"OTHER", "SBCR987L", "NEW"} and got["SBCR987L"].dealstagekey == 1
    assert wh.log().filter("message like '2 changes%'").count() == 1


def test_only_newer_changes_are_applied(spark, src, wh):
    ddl = SOURCE_DDL["salespipeline"] + ", op STRING"
    day = lambda d: datetime(2024, 2, d)
    new = spark.createDataFrame([(*deal("OTHER", 5, 3, 0, 4, value="2.00", at=day(9)), "U")], ddl)
    old = spark.createDataFrame([(*deal("OTHER", 5, 3, 0, 4, value="1.00", at=day(3)), "U")], ddl)
    apply_pipeline_changes(src, wh, new, ["updated_at"], RUN2, at="updated_at")
    assert wh.last_change("salespipeline").startswith("2024-02-09")
    apply_pipeline_changes(src, wh, old, ["updated_at"], RUN3, at="updated_at")
    assert facts(wh)["OTHER"].closevalue == Decimal("2.00")


def test_changes_at_the_mark_are_neither_lost_nor_undone(spark, src, wh):
    day, ddl = datetime(2024, 2, 9), SOURCE_DDL["salespipeline"] + ", op STRING, seq INT"
    row = lambda opp, value, op, seq, at=day: (*deal(opp, 5, 3, 0, 4, value=value, at=at), op, seq)
    first = [row("OTHER", "2.00", "U", 2), row("SBCR987L", "1.00", "D", 2)]
    order = ["updated_at", "seq"]
    apply_pipeline_changes(src, wh, spark.createDataFrame(first, ddl), order, RUN2, at="updated_at")
    late = [row("TIED", "3.00", "I", 1), row("OTHER", "9.00", "U", 1), row("SBCR987L", "9.00", "U", 1), row("NULL", "1.00", "I", 1, None), row("OLD", "1.00", "I", 1, datetime(2024, 2, 1))]
    apply_pipeline_changes(src, wh, spark.createDataFrame(first + late, ddl), order, RUN3, at="updated_at")
    assert {k: str(r.closevalue) for k, r in facts(wh).items()} == {"OTHER": "2.00", "TIED": "3.00"}
    [noted] = wh.log().filter("message like '%instant%'").collect()
    assert (noted.rows_read, noted.rows_rejected, noted.message) == (6, 1, "1 changes without an instant, 1 changes older than the mark")
    apply_pipeline_changes(src, wh, spark.createDataFrame([row("OTHER", "4.00", "U", 3)], ddl), order, "2024-03-03T00:00:00", at="updated_at")
    assert str(facts(wh)["OTHER"].closevalue) == "4.00"


def test_dimension_changes(spark, src, wh):
    ddl = lambda t: SOURCE_DDL[t] + ", op STRING"
    agents = spark.createDataFrame([(5, "x", 1, 1, NOW, "D"), (32, "renamed", 1, 2, NOW, "U"), (33, "added", 1, 2, NOW, "I"), (34, "odd", 1, 2, NOW, "?")], ddl("salesagents"))
    apply_dimension_changes(src, wh, "salesagents", agents, ["updated_at"], RUN2)
    assert {r.salesagentid: r.salesagentname for r in wh.table("dimsalesagent").collect()} == {32: "renamed", 33: "added"}
    products = spark.createDataFrame([(1, "x", 1, Decimal("1.00"), NOW, "D"), (3, "prod3b", 1, Decimal("55.00"), NOW, "U")], ddl("products"))
    apply_dimension_changes(src, wh, "products", products, ["updated_at"], RUN2)
    got = sorted((r.productid, r.productname, r.iscurrent, r.validto) for r in wh.table("dimproduct").collect())
    assert got == [(1, "prod1", False, date(2024, 2, 29)), (3, "prod3", False, date(2024, 2, 29)), (3, "prod3b", True, None)]


def test_a_full_load_counts_checks_and_takes_repeated_ids_once(spark, src, empty):
    now = plus(src, "salesagents", spark, (5, "a5 later", 5, 1, NOW))
    now = plus(now, "accounts", spark, (83, "acc83 later", 1, 2000, None, 1, 1, None, NOW, NOW))
    now = plus(now, "dealstages", spark, (4, "Won"))
    now = plus(now, "salespipeline", spark, deal("FAR", 5, 3, 0, 4, date(9999, 1, 1)), deal("NOACC", 5, 3, 777, 4))
    initial_load(now, empty, RUN1)
    assert set(facts(empty)) == {"SBCR987L", "OTHER"}
    line = empty.log().filter("table_name = 'factsalesperformance' and action = 'replace'").first()
    assert (line.rows_read, line.rows_written, line.rows_rejected) == (5, 2, 3)
    assert sorted((r.opportunityid, r.missing_date) for r in empty.table("factrejects").collect()) == [("FAR", True), ("NOACC", False), ("NOACC", False)]
    assert empty.table("dimsalesagent").filter("salesagentid = 5").first().salesagentname == "a5 later"
    assert sum(r.totaldealcount for r in empty.table("factsalesmonthlyaggregate").collect()) == 2
    assert empty.checks().count() > 10 and empty.checks().filter("violations > 0").count() == 0
    incremental_load(now, empty, RUN2)
    assert empty.table("factrejects").count() == 3 and set(facts(empty)) == {"SBCR987L", "OTHER"}


def test_compaction_keeps_the_rows(spark, src, wh, rows):
    incremental_load(scenario1(spark, src), wh, RUN2, options=LoadOptions(fact_mode="upsert"))
    before = rows(wh.table("factsalesperformance"))
    compact(wh, "factsalesperformance", RUN3)
    assert rows(wh.table("factsalesperformance")) == before and len(wh.live("factsalesperformance")) == 1


def test_a_stream_with_a_new_checkpoint_is_not_skipped(spark, src, empty, tmp_path):
    lazy = {k: v for k, v in src.items() if k != "salespipeline"}
    for n, opportunity in enumerate(("ONE", "TWO")):
        files = str(tmp_path / f"in{n}")
        table(spark, "salespipeline", [deal(opportunity, 5, 3, 0, 4)]).coalesce(1).write.parquet(files)
        stream = file_stream(spark, files, schema_of("salespipeline"))
        stream_incremental(stream, lazy, empty, RUN1, str(tmp_path / f"cp{n}")).awaitTermination()
    assert set(facts(Warehouse(spark, empty.root))) == {"ONE", "TWO"}


def test_stream_loads_files_once(spark, src, empty, tmp_path):
    files, checkpoint = tmp_path / "in", str(tmp_path / "cp")
    src["salespipeline"].coalesce(1).write.parquet(str(files))
    lazy = {k: v for k, v in src.items() if k != "salespipeline"}

    def go():
        stream = file_stream(spark, str(files), schema_of("salespipeline"), max_files=1)
        stream_incremental(stream, lazy, empty, RUN1, checkpoint).awaitTermination()
        return set(facts(Warehouse(spark, empty.root)))

    assert go() == {"SBCR987L", "OTHER"}
    assert go() == {"SBCR987L", "OTHER"}
    table(spark, "salespipeline", [deal("STREAMED", 5, 3, 0, 4), deal("OTHER", 5, 3, 0, 1)]).coalesce(1).write.mode("append").parquet(str(files))
    assert go() == {"SBCR987L", "OTHER", "STREAMED"}
    assert violations(Warehouse(spark, empty.root)) == {}


def test_initial_load_failure_keeps_the_old_warehouse(spark, src, wh, monkeypatch):
    monkeypatch.setattr(initial_plan, "monthly_sales", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        initial_load(src, wh, RUN2)
    assert set(facts(wh)) == {"SBCR987L", "OTHER"} and violations(wh) == {}
