"""Change logs over several batches, rejects that wait for keys, returning products, streams with state."""

from __future__ import annotations

import itertools
import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmart.operators.quality import validate_warehouse
from starmart.operators.resolve import as_of_join, as_of_merge, mark_retries
from starmart.operators.scd import scd2_apply, scd2_changes
from starmart.plans import LoadOptions, apply_dimension_changes, apply_pipeline_changes, archive_facts, fold_changes, incremental_load, initial_load
from starmart.plans import incremental as incremental_plan
from starmart.schemas import SOURCE_DDL, schema_of
from starmart.sources.readers import key_range, read_source, text_edges
from starmart.sources.warehouse import Warehouse
from starmart.streaming.incremental import Dedup, file_stream, stream_changes

T0 = datetime(2024, 1, 1)
RUN1, RUN2, RUN3, RUN4 = "2024-02-01T00:00:00", "2024-03-01T00:00:00", "2024-03-02T00:00:00", "2024-03-03T00:00:00"
LOG_DDL = SOURCE_DDL["salespipeline"] + ", op STRING, seq INT"


def deal(opp, account, value="100.00", agent=5, product=3, stage=4, closed=date(2024, 1, 20), at=T0):
    return (opp, agent, product, account, stage, closed and closed - timedelta(days=10), closed, Decimal(value), at, at)


@pytest.fixture(scope="module")
def src(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("src"))
    data = {
        "accounts": [(i, f"acc{i}", 1, 2000, None, 10, 1, None, T0, T0) for i in (0, 83)],
        "sectors": [(1, "tech")],
        "products": [(i, f"prod{i}", 1, Decimal("55.00"), T0) for i in (1, 3)],
        "productseries": [(1, "S")],
        "salesagents": [(5, "a5", 1, 1, T0)],
        "salesmanagers": [(1, "m1")],
        "locations": [(1, "East")],
        "dealstages": [(4, "Won")],
        "salespipeline": [deal("A", 83, "1.00"), deal("B", 0, "2.00"), deal("WAITS", 777, "3.00"), deal("NODATE", 83, closed=None)],
    }
    for name, rows in data.items():
        spark.createDataFrame(rows, SOURCE_DDL[name]).coalesce(1).write.parquet(f"{root}/{name}")
    return dict(read_source(spark, root))


@pytest.fixture
def wh(spark, src, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    initial_load(src, wh, RUN1, options=LoadOptions(marks_after_full="run_ts"))
    return wh


def values(wh):
    return {r.opportunityid: str(r.closevalue) for r in wh.table("factsalesperformance").collect()}


def rejects(wh):
    flags = ("missing_date", "missing_account", "missing_product", "missing_agent", "missing_stage")
    return {r.opportunityid: [f[8:] for f in flags if r[f]] for r in wh.table("factrejects").collect()}


def log(spark, *rows):
    return spark.createDataFrame([(*d, op, seq) for d, op, seq in rows], LOG_DDL)


CHANGES = [
    (deal("A", 83, "10.00"), "U", 1), (deal("A", 999, "11.00"), "U", 2),  # newest does not resolve
    (deal("B", 0, "20.00"), "U", 1), (deal("B", 0, "21.00"), "D", 2), (deal("B", 0, "22.00"), "I", 3),  # deleted, then back
    (deal("C", None, "30.00"), "I", 1),  # no account
    (deal("D", 83, "40.00", closed=None), "I", 2), (deal("D", 83, "41.00"), "I", 1),  # newest has no date
    (deal("E", 83, "50.00"), "I", 1), (deal("E", 83, "51.00"), "D", 2),
]
AFTER = {"B": "22.00"}
REJECTED = {"WAITS": ["account"], "A": ["account"], "C": ["account"], "D": ["date", "product"]}


@pytest.mark.parametrize("cut", [lambda k: 0, lambda k: k % 2, lambda k: -(k // 4)], ids=["whole", "every other", "newest first"])
def test_every_cut_of_a_log_gives_the_same_facts(spark, src, wh, cut):
    batches = sorted({cut(k) for k in range(len(CHANGES))})
    for n, b in enumerate(batches):
        part = [c for k, c in enumerate(CHANGES) if cut(k) == b]
        apply_pipeline_changes(src, wh, log(spark, *part), ["seq"], f"2024-03-{n + 1:02d}T00:00:00")
    assert values(wh) == AFTER and rejects(wh) == REJECTED
    monthly = wh.table("factsalesmonthlyaggregate").collect()
    assert [(r.year, r.month, r.totaldealcount, r.totalclosevalue) for r in monthly] == [(2024, 1, 1, 22.0)]


def test_folding_keeps_the_state(spark, src, wh):
    apply_pipeline_changes(src, wh, log(spark, *CHANGES[:5]), ["seq"], RUN2)
    apply_pipeline_changes(src, wh, log(spark, *CHANGES[5:]), ["seq"], RUN3)
    fold_changes(wh, RUN3)
    [one] = wh.live("changestate")
    assert one.rows_written == 5
    apply_pipeline_changes(src, wh, log(spark, *CHANGES), ["seq"], RUN4)
    assert values(wh) == AFTER and rejects(wh) == REJECTED
    with pytest.raises(ValueError, match="ordered by"):
        apply_pipeline_changes(src, wh, log(spark, *CHANGES), ["updated_at"], "2024-03-05T00:00:00")
    initial_load(src, wh, "2024-03-06T00:00:00")
    assert wh.live("changestate") == [] and values(wh) == {"A": "1.00", "B": "2.00"}


def test_archived_deals_and_nameless_changes(spark, src, wh):
    archive_facts(wh, 202402, RUN2)
    apply_pipeline_changes(src, wh, log(spark, (deal("A", 83, "9.00"), "U", 1), (deal(None, 83), "I", 1), (deal("N", 83), "I", 1)), ["seq"], RUN3)
    assert values(wh) == {"N": "100.00"} and {r.opportunityid for r in wh.table("factsarchive").collect()} == {"A", "B"}
    assert wh.log().filter("message = '1 changes without an opportunity'").count() == 1


def test_an_empty_log(spark, src, wh):
    apply_pipeline_changes(src, wh, log(spark), ["seq"], RUN2)
    assert values(wh) == {"A": "1.00", "B": "2.00"} and rejects(wh) == {"WAITS": ["account"]}


def test_a_stream_of_changes_is_applied_once(spark, src, wh, tmp_path):
    files, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")

    def go():
        stream = file_stream(spark, files, schema_of_log(spark), max_files=1)
        stream_changes(stream, src, wh, ["seq"], RUN2, checkpoint).awaitTermination()

    log(spark, *CHANGES[5:]).coalesce(1).write.mode("append").parquet(files)
    go()
    log(spark, *CHANGES[:5]).coalesce(1).write.mode("append").parquet(files)
    go()
    go()
    again = Warehouse(spark, wh.root)
    assert values(again) == AFTER and rejects(again) == REJECTED
    assert again.log().filter("action = 'commit' and batch_id like 'changes%'").count() == 2


def schema_of_log(spark):
    return spark.createDataFrame([], LOG_DDL).schema


def account(i):
    return (i, f"acc{i}", 1, 2000, None, 10, 1, None, datetime(2024, 2, 15), datetime(2024, 2, 15))


def with_rows(spark, src, name, *rows):
    return {**src, name: src[name].unionByName(spark.createDataFrame(list(rows), SOURCE_DDL[name]))}


def test_only_rejects_whose_key_arrived_are_resolved(spark, src, wh, monkeypatch):
    tried = []
    real = incremental_plan.resolve_keys
    monkeypatch.setattr(incremental_plan, "resolve_keys", lambda rows, *a, **k: tried.append(sorted(r.opportunityid for r in rows.collect())) or real(rows, *a, **k))
    more = [deal("TWO", 888, agent=9, at=datetime(2024, 2, 10)), deal("OTHER", 555, at=datetime(2024, 2, 10))]
    incremental_load(with_rows(spark, src, "salespipeline", *more), wh, RUN2)
    late = [(i, "acc", 1, 2000, None, 1, 1, None, T0, datetime(2024, 3, 1, 1)) for i in (777, 888)]
    incremental_load(with_rows(spark, src, "accounts", *late), wh, RUN3)
    assert tried == [["OTHER", "TWO"], ["TWO", "WAITS"]]
    assert values(wh) == {"A": "1.00", "B": "2.00", "WAITS": "3.00"} and rejects(wh) == {"TWO": ["agent"], "OTHER": ["account"]}
    assert {r.check_name: r.violations for r in validate_warehouse(wh.tables()).collect() if r.violations} == {}


def test_keys_from_a_dimension_log_are_remembered(spark, src, wh):
    accounts = spark.createDataFrame([(*account(777), "I")], SOURCE_DDL["accounts"] + ", op STRING")
    apply_dimension_changes(src, wh, "accounts", accounts, ["updated_at"], RUN2)
    assert rejects(wh) == {"WAITS": ["account"]}
    incremental_load(src, wh, RUN3)
    assert values(wh)["WAITS"] == "3.00" and rejects(wh) == {} and wh.live("arrivals") == []


def test_replaying_all_finds_what_arrived_unnoticed(spark, src, wh):
    with pytest.raises(ValueError, match="replay"):
        incremental_load(src, wh, RUN2, options=LoadOptions(replay="some"))
    entry = wh.write("dimaccount", wh.table("dimaccount").unionByName(wh.table("dimaccount").limit(1).withColumn("accountid", F.lit(777).cast("bigint"))), "byhand")
    wh.commit("byhand", RUN2, [entry], {})
    incremental_load(src, wh, RUN3)
    assert "WAITS" in rejects(wh)
    incremental_load(src, wh, RUN4, options=LoadOptions(replay="all"))
    assert values(wh)["WAITS"] == "3.00"


def test_mark_retries(spark):
    flags = ["missing_date", "missing_account", "missing_product", "missing_agent", "missing_stage"]
    held = spark.createDataFrame(
        [("a", 1, None, False, True, False, False, False), ("b", 1, 7, False, False, True, False, False), ("c", 2, 8, False, True, True, False, False), ("d", None, 7, False, True, True, False, False)],
        "opportunityid STRING, accountid BIGINT, productid BIGINT, " + ", ".join(f"{f} BOOLEAN" for f in flags))
    ids = spark.createDataFrame([(1,), (1,)], "id BIGINT")
    for size in (100_000_000, 0):
        got = mark_retries(held, {"missing_account": (ids, 2), "missing_product": (spark.createDataFrame([(8,)], "k BIGINT"), 1)}, max_broadcast=size)
        assert {r.opportunityid: r._retry for r in got.collect()} == {"a": True, "b": False, "c": True, "d": False}
        assert got.columns == [*held.columns, "_retry"]
    assert [r._retry for r in mark_retries(held, {}).collect()] == [False] * 4


def test_rows_without_keys_are_counted(spark, src, wh):
    line = wh.log().filter("table_name = 'factsalesperformance' and action = 'replace'").first()
    assert (line.rows_read, line.rows_written, line.rows_rejected, line.message) == (4, 2, 1, "1 rows without a key or date")


@pytest.mark.parametrize("end, back, start", [("2024-01-31", "2024-03-01", date(2024, 3, 1)), ("2024-03-01", "2024-03-01", date(2024, 3, 2)), (None, "2024-03-01", None)])
def test_a_returning_product_is_valid_from_its_return(spark, end, back, start):
    ddl = "productsk BIGINT, productid BIGINT, productname STRING, seriesname STRING, price DECIMAL(18,2), pricerange STRING, validfrom DATE, validto DATE, iscurrent BOOLEAN"
    day = lambda x: x and date.fromisoformat(x)
    dim = spark.createDataFrame([(1, 7, "p", "s", None, "Unknown", date(1900, 1, 1), day(end), end is None), (2, 7, "q", "s", None, "Unknown", date(1900, 1, 1), date(1900, 1, 1), False)], ddl)
    new = spark.createDataFrame([(7, "p", "s", None, "Unknown"), (8, "n", "s", None, "Unknown")], "productid BIGINT, productname STRING, seriesname STRING, price DECIMAL(18,2), pricerange STRING")
    got = scd2_apply(dim, scd2_changes(dim, new), back).filter("productsk > 2").collect()
    assert sorted((r.productid, r.validfrom) for r in got) == sorted(itertools.chain([(7, start)] if start else [], [(8, date(1900, 1, 1))]))


def test_a_deleted_product_comes_back_by_the_log(spark, src, wh):
    rows = spark.createDataFrame([(3, "prod3", 1, Decimal("55.00"), T0, "D")], SOURCE_DDL["products"] + ", op STRING")
    apply_dimension_changes(src, wh, "products", rows, ["updated_at"], "2024-02-10T00:00:00")
    apply_dimension_changes(src, wh, "products", rows.withColumn("op", F.lit("I")), ["updated_at"], "2024-02-20T00:00:00")
    got = sorted((r.validfrom, r.validto, r.iscurrent) for r in wh.table("dimproduct").filter("productid = 3").collect())
    assert got == [(date(1900, 1, 1), date(2024, 2, 9), False), (date(2024, 2, 20), None, True)]


def test_dedup_leaves_columns_and_types(spark, tmp_path):
    spark.createDataFrame([deal("A", 83), deal("A", 83)], SOURCE_DDL["salespipeline"]).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = Dedup(("opportunityid",), delay="1 day").over(file_stream(spark, str(tmp_path / "in"), schema_of("salespipeline")))
    assert stream.schema == schema_of("salespipeline")
    found = []
    stream.writeStream.foreachBatch(lambda df, _: found.append(df.count())).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert sum(found) == 1


def test_a_full_load_in_ranges_goes_on_where_it_was_cut_short(spark, src, tmp_path, monkeypatch):
    options = LoadOptions(fact_ranges=3, validate=False)
    wh, wrote = Warehouse(spark, str(tmp_path / "ranged")), []
    real = Warehouse.write

    def write(self, name, df, batch, *a, **k):
        if name == "factsalesperformance":
            wrote.append(batch)
            if len(wrote) == 2:
                raise RuntimeError("cut short")
        return real(self, name, df, batch, *a, **k)

    monkeypatch.setattr(Warehouse, "write", write)
    with pytest.raises(RuntimeError):
        initial_load(src, wh, RUN1, options=options)
    assert wh.table("factsalesperformance").count() == 0
    initial_load(src, wh, RUN1, options=options)
    assert values(wh) == {"A": "1.00", "B": "2.00"} and len(wrote) == len(set(wrote)) + 1 and wrote.count(wrote[0]) == 1


def test_text_edges(spark):
    keys = spark.createDataFrame([(f"{i % 50:03d}",) for i in range(200)] + [("é",), (None,)], "k STRING")
    edges = text_edges(keys, "k", 4)
    assert edges[0][0] is None and edges[-1][1] is None and [a[1] for a in edges[:-1]] == [b[0] for b in edges[1:]]
    sizes = [key_range(keys, "k", low, high).count() for low, high in edges]
    assert sum(sizes) == 202 and min(sizes) > 30
    assert text_edges(keys.limit(0), "k", 4) == [(None, None)] == text_edges(keys, "k", 1)
    assert len(text_edges(keys, "k", 4, sample=5)) == 4


@pytest.mark.parametrize("bounds", ["closed", "half_open"])
@pytest.mark.parametrize("slice_rows", [3, 10**6])
def test_the_merge_finds_what_the_join_finds(spark, bounds, slice_rows):
    rng = random.Random(7)
    start = date(2020, 1, 1)
    versions, sk = [], 0
    for product in range(4):
        for day in sorted(rng.sample(range(600), 200)):
            sk += 1
            end = start + timedelta(day + rng.randrange(4)) if rng.random() < 0.7 else None
            versions.append((sk, product, start + timedelta(day), end))
    dim = spark.createDataFrame(versions, "productsk BIGINT, productid BIGINT, validfrom DATE, validto DATE")
    facts = [(str(i), rng.choice([0, 0, 0, 1, 2, 3, 9, None]), start + timedelta(rng.randrange(-5, 610)) if rng.random() < 0.95 else None) for i in range(400)]
    deals = spark.createDataFrame(facts, "opportunityid STRING, productid BIGINT, eventdate DATE")
    for emit in ("sk", "natural"):
        for how in ("left", "inner"):
            joined = as_of_join(deals, dim, len(versions), bounds, emit, how)
            merged = as_of_merge(deals, dim, bounds, emit, how, slice_rows)
            assert merged.columns == joined.columns and sorted(map(str, merged.collect())) == sorted(map(str, joined.collect()))
