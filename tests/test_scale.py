"""What loads and their queries shuffle and write: shapes that keep in proportion to the input."""

from __future__ import annotations

import os
import re
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from checks import queries
from checks.sample_source import Sample
from starmart.operators.lookup import has_bit, key_bits, key_block
from starmart.operators.resolve import KEY_FLAGS, packed, resolve_keys, unpacked
from starmart.operators.summaries import FACT_KEYS, merged_sales, monthly_from_lines, moved_agents, region_lines, regions, sales_lines, signed, use_lines
from starmart.plans import LoadOptions, incremental_load
from starmart.plans.incremental import _kept_back, rewrite_months, row_digest
from starmart.schemas import STORED_FACT, empty_table, schema_of
from starmart.sources.warehouse import Warehouse

SF = "/root/testdata/sf0.01"


class Stop(Exception):
    pass


def stopped(*args, **kwargs):
    raise Stop


def files(folder):
    return [f for f in os.listdir(folder) if f.endswith(".parquet")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name, least", [("stream_batches", 2 * queries.PART_FILES if hasattr(queries, "PART_FILES") else 16), ("stream_dedup", 2)])
def test_no_task_writes_a_whole_part_of_a_stream(spark, tmp_path, monkeypatch, name, least):
    monkeypatch.setattr(queries, "shared_folder", lambda spark: str(tmp_path))
    monkeypatch.setattr(queries, "stream_incremental", stopped)
    with pytest.raises(Stop):
        queries.REGISTERED[name](spark, SF)
    assert len(files(tmp_path / "in")) >= least


def test_small_parts_of_a_stream_are_one_file_each(spark, tmp_path):
    small, large = spark.range(20, numPartitions=7), spark.range(8000, numPartitions=7)
    assert queries._part_files([small, large]) == 1 and queries._part_files([large, large]) == 8
    large.repartition(8).write.parquet(str(tmp_path / "x"))
    assert len(files(tmp_path / "x")) == 8


def test_loads_read_a_stored_pipeline(spark):
    s = Sample(spark, "/root/testdata/sf0.001")
    held = s.tables()["salespipeline"]
    assert "Join" not in plan(held) and held.dtypes == s.salespipeline.dtypes
    assert held.exceptAll(s.salespipeline).isEmpty() and s.salespipeline.exceptAll(held).isEmpty()


def reject(opportunity, account, value="1.00"):
    row = dict.fromkeys(schema_of("factrejects").fieldNames()) | dict.fromkeys(KEY_FLAGS.values(), False)
    return row | {"opportunityid": opportunity, "accountid": account, "closevalue": value and Decimal(value), "missing_account": True}


class Rejects:
    def __init__(self, df, n):
        self.df, self.n = df, n

    def table(self, name):
        return self.df

    def rows(self, name):
        return self.n


def test_rejects_meet_the_window_in_one_shuffle(spark):
    schema = schema_of("factrejects")
    kept = [reject("A", 1), reject("A", 1), reject("A", 2), reject("B", 1, None), reject("C", None), reject(None, 1)]
    rejects = spark.createDataFrame([tuple(r[c] for c in schema.fieldNames()) for r in kept], schema)
    window = rejects.drop(*KEY_FLAGS.values()).filter("opportunityid is null or accountid = 1 or opportunityid = 'C'")
    for limit in (0, 100_000_000):
        out = _kept_back(Rejects(rejects, len(kept)), window, {}, LoadOptions(replay="all", max_broadcast=limit))
        assert sorted((str(r.opportunityid), r.accountid) for r in out.collect()) == [("A", 2), ("None", 1)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = _kept_back(Rejects(rejects, 9), window, {}, LoadOptions(replay="all", max_broadcast=0))
        assert plan(out).count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_facts_meet_many_keys_once(spark, tmp_path):
    schema = empty_table(spark, "factsalesperformance").select(*STORED_FACT).schema

    def facts(rows):
        made = [dict.fromkeys(schema.fieldNames()) | {"opportunityid": o, "datekey": day, "updated_at": datetime(2024, 1, 1)} for o, day in rows]
        df = spark.createDataFrame([tuple(r[c] for c in schema.fieldNames()) for r in made], schema)
        return df.selectExpr("*", "int(datekey / 10000) as year", "int(datekey / 100) % 100 as month")

    got = []
    for limit in (0, 100_000_000):
        wh = Warehouse(spark, str(tmp_path / str(limit)))
        entry = wh.write("factsalesperformance", facts([("A", 20230101), ("A", 20230201), ("B", 20230101), ("C", 20230301), (None, 20230201)]), "one")
        wh.commit("one", "2024-01-01T00:00:00", [entry], {})
        staged, stage = [], wh.stage
        wh.stage = lambda name, df: staged.append(name) or stage(name, df)
        keys = facts([("A", 1), ("A", 1), (None, 1)]).select("opportunityid")
        entry, change = rewrite_months(wh, wh.table("factsalesperformance"), keys, 3, facts([("D", 20230401)]), "two", LoadOptions(max_broadcast=limit))
        assert staged == (["met"] if not limit else ["losing"])
        rows = wh.read("factsalesperformance", [entry]).select("opportunityid", "datekey").collect()
        got.append((entry.months, sorted(map(str, rows)), sorted(str(r.datekey) for r in change.removed.collect())))
    assert got[0] == got[1] and got[0][2] == ["20230101", "20230201"] and len(got[0][1]) == 3


def test_the_window_is_shuffled_as_digests(spark):
    schema = schema_of("factrejects")
    source = [c for c in schema.fieldNames() if c not in KEY_FLAGS.values()]
    kept = [reject("A", 1) | {"updated_at": datetime(2024, 1, 1, 0, 0, 0, us)} for us in (1, 2)] + [
        reject("A", None) | {"productid": 1}, reject("A", 1, None), reject("A?", 1, None), reject("A", 1, "0.00"), reject("A", 1, "-0.00"), reject(None, 1)]
    rows = spark.createDataFrame([tuple(r[c] for c in schema.fieldNames()) for r in kept], schema)
    found = [r[0] and bytes(r[0]) for r in rows.select(row_digest(source)).collect()]
    assert found[-1] is None and found[5] == found[6] and {len(x) for x in found[:-1]} == {16}
    assert len(set(found[:6])) == 6
    # A source with another scale of the same value.
    finer = rows.withColumn("closevalue", rows["closevalue"].cast("decimal(20,4)"))
    assert [r[0] and bytes(r[0]) for r in finer.select(row_digest(source)).collect()] == found
    window = rows.drop(*KEY_FLAGS.values())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = _kept_back(Rejects(rows, 9), window, {}, LoadOptions(replay="all", max_broadcast=0))
        moves = re.findall(r"Exchange hashpartitioning\((\w+)#", plan(out))
        assert sorted(moves) == ["_again", "_mine"]
        assert [r.opportunityid for r in out.collect()] == [None]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stored_rows_hold_a_key_once(spark):
    ddl = "opportunityid STRING, accountid BIGINT, salesagentid BIGINT, dealstageid BIGINT, datekey INT, accountkey BIGINT, productkey BIGINT, salesagentkey BIGINT, dealstagekey BIGINT"
    rows = [("A", 1, 2, 3, 4, 1, 5, 2, 3), ("B", 0, 2, 3, None, 0, None, None, None), ("C", None, None, None, None, None, None, None, None)]
    flagged = spark.createDataFrame(rows, ddl)
    stored = packed(flagged)
    assert dict(stored.dtypes)["accountkey"] == "boolean"
    back = unpacked(stored, flagged)
    assert back.schema == flagged.schema and sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)


def test_sales_lines_are_by_region(spark):
    """Agents by the hundred make no line each, and only lines by region are shuffled."""
    facts = spark.range(1000).selectExpr("concat('o', id) AS opportunityid", "20240105 AS datekey", "id AS salesagentkey", "4L AS dealstagekey", "1.50BD AS closevalue", "3 AS durationdays", "100.0D AS expectedsuccessrate", "2024 AS year", "1 AS month")
    agents = spark.range(900).selectExpr("id AS salesagentid", "CASE WHEN id % 3 > 0 THEN concat('r', id % 3) END AS region")
    rows = signed(facts, None, facts)
    for limit in (0, 100_000_000):
        lines = region_lines(rows, regions(agents), 900, limit)
        assert sorted((r.region, r.deals) for r in lines.collect()) == [("Unknown", 300), ("r1", 300), ("r2", 300)]
        assert sorted(map(str, monthly_from_lines(lines, agents, 900).collect())) == sorted(map(str, monthly_from_lines(sales_lines(rows), agents, 900, limit).collect()))
    text = plan(lines)
    assert re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text) and "hashpartitioning(salesagentkey" not in text
    now = agents.withColumn("region", F.when(F.col("salesagentid") == 1, "r9").otherwise(F.col("region"))).filter("salesagentid <> 2")
    moved = moved_agents(regions(agents), regions(now))
    assert sorted(map(tuple, moved.collect())) == [(1, "r1", -1), (1, "r9", 1), (2, "r2", -1)]
    for limit in (0, 100_000_000):
        both = merged_sales(lines.unionByName(region_lines(facts, moved, 3, limit)))
        assert sorted((r.region, r.deals) for r in both.collect()) == [("Unknown", 300), ("r1", 299), ("r2", 299), ("r9", 1)]


def test_versions_are_counted(spark):
    """The bound that decides a broadcast is that of the versions there are, not three times the products."""
    s = Sample(spark, SF)
    versions = queries._versions(s).count()
    assert versions <= queries._version_rows(s) < 1.3 * s.rows["product"]


def test_a_large_dimension_of_close_keys_is_looked_up_by_bits(spark):
    own = [-65, -64, -1, 0, 1, 63, 64, 127, 128, None, 7, 7]
    table = spark.createDataFrame([(k,) for k in own], "id long")
    probe = spark.createDataFrame([(k,) for k in [*own, 2, 62, 65, -2, -63, 10**12]], "k long")
    found = probe.join(F.broadcast(key_bits(table, "id")), key_block("k") == F.col("_block"), "left").withColumn("hit", has_bit("k"))
    assert all(bool(r.hit) == (r.k in own and r.k is not None) for r in found.collect())
    assert key_bits(table, "id").count() == 5
    far = spark.range(0, 64 * 1000, 64)
    assert key_bits(far, "id", 10_000) is None and key_bits(spark.range(6400), "id", 10_000) is not None
    assert key_bits(spark.createDataFrame([("a",)], "id string"), "id") is None


def test_keys_by_bits_resolve_as_keys_by_rows(spark):
    s = Sample(spark, "/root/testdata/sf0.001")
    small = resolve_keys(s.factsource, s.dimensions(), max_broadcast=200).flagged
    bits = resolve_keys(s.factsource, s.dimensions(), max_broadcast=400).flagged
    plain = resolve_keys(s.factsource, s.dimensions()).flagged
    assert "_bits" in plan(bits) and "_bits" not in plan(plain)
    assert bits.dtypes == plain.dtypes and bits.columns == plain.columns
    want = sorted(map(str, plain.collect()))
    assert sorted(map(str, bits.collect())) == want and sorted(map(str, small.collect())) == want


def test_validate_joins_and_resolves_the_pipeline_once(spark):
    found = queries.REGISTERED["validate"](spark, "/root/testdata/sf0.001")
    assert "lineitem" not in plan(found) and found.count() == 6


def test_appending_loads_look_a_small_archive_up(spark, tmp_path, monkeypatch):
    """The facts of an appending load are not shuffled to meet an archive that may be broadcast."""
    seen = {}
    write = Warehouse.write_all

    def kept(self, frames, *args):
        seen.update({k: plan(v) for k, v in frames.items()})
        return write(self, frames, *args)

    monkeypatch.setattr(Warehouse, "write_all", kept)
    s, wh = Sample(spark, "/root/testdata/sf0.001"), Warehouse(spark, str(tmp_path / "w"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        incremental_load(s.source(), wh, "2024-02-01T00:00:00", options=LoadOptions(fact_mode="insert_only", validate=False))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "LeftAnti" in seen["factsalesperformance"] and "SortMergeJoin" not in seen["factsalesperformance"]


def test_uses_are_summed_without_a_line_for_each_key(spark):
    like = empty_table(spark, "factsalesperformance").select(*STORED_FACT).withColumns({"year": F.lit(1), "month": F.lit(1)})
    lines = use_lines(signed(like, None, like))
    # Lines are made of sums: the rows themselves are not multiplied.
    made = plan(lines)
    assert made.count("Generate") == 1 and re.search(r"Generate(?s:.)*HashAggregate", made) and lines.dtypes == [("kind", "string"), ("key", "bigint"), ("n", "bigint")]


def test_uses_are_those_of_every_row_and_key(spark):
    columns = ["opportunityid", "datekey", "accountkey", "productkey", "salesagentkey", "dealstagekey", "year", "month", "_sign"]
    rows = [("a", 19980101, 1, 2, 3, 4, 1998, 1, 1), ("b", 19980101, 1, None, 3, 4, 1998, 1, 1), (None, 19980203, 5, 2, 3, 1, 1998, 2, 1),
            ("a", 19980101, 1, 2, 3, 4, 1998, 1, -1), ("c", None, None, None, None, None, None, None, 1), ("d", 19980203, 5, 2, 3, 4, 1998, 2, -1)]
    frame = spark.createDataFrame(rows, "opportunityid string, datekey int, accountkey long, productkey long, salesagentkey long, dealstagekey long, year int, month int, _sign int")
    want = {}
    for r in (dict(zip(columns, x, strict=True)) for x in rows):
        keys = {label: r[key] for label, (key, _, _) in FACT_KEYS.items()} | {"month": None if r["year"] is None else r["year"] * 100 + r["month"]}
        for kind in keys:
            want[kind, keys[kind]] = want.get((kind, keys[kind]), 0) + r["_sign"]
        if any(r[c] is None for c in columns[:6]):
            want["null", None] = want.get(("null", None), 0) + r["_sign"]
    assert {(r.kind, r.key): r.n for r in use_lines(frame).collect()} == want
