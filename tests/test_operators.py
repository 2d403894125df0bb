from __future__ import annotations

import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmart.operators.aggregates import (
    SALES_MEASURES,
    Join,
    calendar,
    in_months,
    monthly_sales,
    refresh_months,
    star_aggregate,
)
from starmart.operators.changes import apply_changes, delete_by_key, last_processed, update_by_key
from starmart.operators.dates import date_bounds, date_dimension, extended_dates, seen_dates
from starmart.operators.dedup import first_per_key, latest_per_key
from starmart.operators.dims import stage_rows
from starmart.operators.facts import archive_split, fact_load, new_facts, shape_pipeline
from starmart.operators.keys import surrogate_keys
from starmart.operators.lookup import lookup, table_rows
from starmart.schemas import SOURCE_DDL, WAREHOUSE_DDL, empty_table
from starmart.sources.readers import key_range, page, range_edges, read_files, read_jdbc


# --- dates ----------------------------------------------------------------------
def _pipeline(spark, rows):
    return spark.createDataFrame(rows, "engagedate DATE, closedate DATE")


def test_date_dimension_covers_whole_years(spark):
    p = _pipeline(spark, [(date(2023, 5, 1), date(2024, 2, 2)), (date(2023, 6, 1), None)])
    days = date_dimension(date_bounds(p))
    assert days.count() == 365 + 366
    first, last = days.orderBy("datekey").first(), days.orderBy(F.desc("datekey")).first()
    assert (first.datekey, first.quarter, last.datekey, last.quarter) == (20230101, 1, 20241231, 4)


@pytest.mark.parametrize("data", [[], [(None, None)], [(None, date(2024, 1, 1))]])
def test_default_range_when_an_end_is_missing(spark, data):
    got = date_bounds(_pipeline(spark, data)).first()
    assert tuple(got) == (date(2015, 1, 1), date(2030, 12, 31))


def test_dates_out_of_all_years_do_not_count(spark):
    got = date_bounds(_pipeline(spark, [(date(2023, 5, 1), date(9999, 2, 2)), (date(2024, 6, 1), date(2022, 1, 1)), (date(1, 1, 1), None)])).first()
    assert tuple(got) == (date(2022, 1, 1), date(2022, 1, 1))


def test_extended_dates_only_grow(spark):
    have = date_dimension(date_bounds(_pipeline(spark, [(date(2023, 5, 1), date(2023, 6, 1))])))
    grown = extended_dates(have, seen_dates(_pipeline(spark, [(date(2025, 1, 1), None)])))
    assert grown.count() == 365 + 366 + 365
    assert extended_dates(have, seen_dates(_pipeline(spark, []))).count() == 365


# --- keys -----------------------------------------------------------------------
def test_surrogate_keys_are_the_rank(spark):
    rng = random.Random(7)
    ids = {rng.choice([1, 2**20, 2**21, 2**41, 2**45]) * rng.randrange(1, 50) + rng.randrange(3) for _ in range(300)}
    ids |= {-5, -(2**21), 0, 1, 2}
    df = spark.createDataFrame([(i,) for i in ids], "productid BIGINT").repartition(5)
    got = dict((r.productid, r.productsk) for r in surrogate_keys(df, "productid", after=100).collect())
    assert got == {k: 101 + n for n, k in enumerate(sorted(ids))}


def test_surrogate_keys_of_nothing(spark):
    assert surrogate_keys(spark.createDataFrame([], "productid BIGINT"), "productid").count() == 0


# --- dedup ----------------------------------------------------------------------
def test_first_and_latest_per_key(spark, rows):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "y"), ("a", None, "z"), ("b", None, "q"), ("b", None, "p")], "k STRING, t INT, v STRING"
    )
    first = first_per_key(df, "k", [F.col("t").asc_nulls_last(), F.col("v")])
    assert rows(first) == [("a", 1, "y"), ("b", None, "p")]
    assert rows(latest_per_key(df, "k", ["t"])) == [("a", 2, "x"), ("b", None, "p")]


def test_one_row_per_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    plan = latest_per_key(df, "k", ["t"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_stage_rows_last_wins(spark, rows):
    df = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "only", 1)], "dealstageid BIGINT, stagename STRING, t INT")
    assert rows(stage_rows(df, ("t",))) == [(1, "new"), (2, "only")]


# --- lookups ---------------------------------------------------------------------
def _skewed(spark):
    rng = random.Random(3)
    data = [(i, 7 if i % 3 == 0 else rng.choice([None, 1, 2, 3, 99]), i % 10) for i in range(3000)]
    probe = spark.createDataFrame(data, "i INT, k BIGINT, d INT")
    table = spark.createDataFrame([(k, lo, f"{k}:{lo}") for k in (1, 2, 3, 7) for lo in (0, 5)], "tk BIGINT, lo INT, v STRING")
    return probe, table


@pytest.mark.parametrize("how", ["left", "inner"])
def test_sliced_join_equals_broadcast_join(spark, rows, how):
    probe, table = _skewed(spark)
    cond = lambda: (F.col("d") >= F.col("lo")) & (F.col("d") < F.col("lo") + 5)
    plain = lookup(probe, table, "k", "tk", 8, cond, how)
    sliced = lookup(probe, table, "k", "tk", 8, cond, how, max_broadcast=0, slice_rows=50)
    assert sliced.columns == plain.columns
    assert rows(sliced) == rows(plain)
    assert sliced.filter("k = 7").count() == 1000


def test_hot_key_is_spread_over_slices(spark):
    probe, table = _skewed(spark)
    from starmart.operators.lookup import _sliced_join, hot_keys

    hot = hot_keys(probe, "k", 50)
    slices = {r["_hot_key"]: r["_slices"] for r in hot.collect()}
    assert slices[7] == 20
    plan = _sliced_join(probe, table, "k", "tk", None, "left", hot)._jdf.queryExecution().analyzed().toString()
    assert "_slice" in plan


def test_table_rows_counts_in_one_go(spark):
    assert table_rows({"a": spark.range(3), "b": spark.range(0)}) == {"a": 3, "b": 0}
    assert table_rows({}) == {}


# --- facts -----------------------------------------------------------------------
FACT = WAREHOUSE_DDL["factsalesperformance"].removesuffix(", updated_at TIMESTAMP_NTZ")


def _fact(spark, *items):
    """Items (opportunity, updated day, value)."""
    return spark.createDataFrame(
        [(o, 20240101, 1, 1, 1, 1, Decimal(v), 1, 10.0, datetime(2024, 1, d)) for o, d, v in items],
        FACT + ", updated_at TIMESTAMP_NTZ",
    )


def test_fact_load_modes(spark, rows):
    have = _fact(spark, ("a", 1, 1), ("b", 1, 1)).drop("updated_at")
    batch = _fact(spark, ("b", 2, 2), ("b", 3, 3), ("c", 2, 5), ("c", 3, 4))
    got = {m: rows(fact_load(have, batch, m), "opportunityid", F.col("closevalue").cast("int"))
           for m in ("insert_only", "insert_if_absent", "upsert")}
    assert got["insert_only"] == [("a", 1), ("b", 1), ("b", 2), ("b", 3), ("c", 4), ("c", 5)]
    assert got["insert_if_absent"] == [("a", 1), ("b", 1), ("c", 5)]
    assert got["upsert"] == [("a", 1), ("b", 3), ("c", 4)]
    with pytest.raises(ValueError):
        fact_load(have, batch, "merge")


def test_new_facts_same_with_and_without_key_broadcast(spark, rows):
    have = _fact(spark, *[(f"o{i}", 1, 1) for i in range(50)]).drop("updated_at")
    batch = _fact(spark, *[(f"o{i}", 2, i) for i in range(40, 60)])
    assert rows(new_facts(have, batch)) == rows(new_facts(have, batch, batch_rows=20))
    assert new_facts(have, batch, batch_rows=20).count() == 10


def test_shape_requires_keys_and_event_date(spark):
    stages = spark.createDataFrame([(4, "Won")], "dealstageid BIGINT, stagename STRING")
    d = date(2024, 1, 5)
    base = ("o", 1, 1, 1, 4, d, d, None, None, None)
    data = [base]
    for gap in (1, 2, 3, 4):
        data.append(tuple(None if i == gap else v for i, v in enumerate(base)))
    data += [("p", 1, 1, 1, 9, d, None, None, None, None), ("q", 1, 1, 1, 4, None, None, None, None, None)]
    out = shape_pipeline(spark.createDataFrame(data, SOURCE_DDL["salespipeline"]), stages)
    got = {r.opportunityid: (r.durationdays, r.expectedsuccessrate, r.eventdate) for r in out.collect()}
    assert got == {"o": (0, 100.0, d), "p": (None, 10.0, d)}


def test_archive_split_is_a_partition(spark):
    facts = _fact(spark, ("a", 1, 1), ("b", 1, 1)).withColumn("datekey", F.when(F.col("opportunityid") == "a", 20231231).otherwise(20240101))
    kept, archived = archive_split(facts, 20240101)
    assert [r.opportunityid for r in kept.collect()] == ["b"] and [r.opportunityid for r in archived.collect()] == ["a"]


# --- aggregates -------------------------------------------------------------------
def _star(spark):
    rng = random.Random(1)
    facts = spark.createDataFrame(
        [(f"o{i}", 20240100 + rng.randrange(1, 32), 1, 1, 0 if i % 3 else rng.randrange(5), rng.randrange(3),
          None if i % 7 == 0 else Decimal(rng.randrange(10000)) / 100, None if i % 5 == 0 else i % 9, 25.0)
         for i in range(600)], FACT)
    dates = date_dimension(spark.sql("SELECT DATE '2024-01-01' lo, DATE '2024-01-02' hi"))
    agents = spark.createDataFrame([(i, None if i == 2 else f"r{i % 2}") for i in range(4)], "salesagentid BIGINT, region STRING")
    return facts, dates, agents


def test_large_dimension_path_gives_the_same_aggregate(spark, rows):
    facts, dates, agents = _star(spark)
    small = monthly_sales(facts, dates, agents, 4)
    large = monthly_sales(facts, dates, agents, 4, max_broadcast=3)
    unknown = monthly_sales(facts, dates, agents, None)
    assert rows(small) == rows(large) == rows(unknown)
    assert {r.region for r in small.collect()} == {"r0", "r1", "Unknown"}
    assert small.agg(F.sum("totaldealcount")).first()[0] == facts.filter("salesagentkey < 4").count()


def test_all_null_measures_are_null(spark):
    facts = _fact(spark, ("a", 1, 1)).withColumn("closevalue", F.lit(None).cast("decimal(18,2)"))
    got = star_aggregate(facts, [], {"dealstagekey": F.col("dealstagekey")}, SALES_MEASURES).first()
    assert (got.totaldealcount, got.totalclosevalue, got.avgdealvalue) == (1, None, None)


def test_star_ignores_partition_columns_of_facts(spark):
    facts, dates, _ = _star(spark)
    facts = facts.withColumn("year", F.lit(1)).withColumn("month", F.lit(1))
    got = star_aggregate(facts, [calendar(dates, "year")], {"year": F.col("year")}, {"n": ("count", "*")}).collect()
    assert [(r.year, r.n) for r in got] == [(2024, 600)]


def test_refresh_months_replaces_only_those(spark, rows):
    old = spark.createDataFrame([(2023, 12, 1), (2024, 1, 1), (2024, 2, 1)], "year INT, month INT, n INT")
    new = spark.createDataFrame([(2024, 1, 9)], "year INT, month INT, n INT")
    assert rows(refresh_months(old, new, [202401])) == [(2023, 12, 1), (2024, 1, 9), (2024, 2, 1)]
    assert old.filter(in_months(F.col("year"), F.col("month"), [])).count() == 0


def test_unjoined_dimension_rows_do_not_count(spark):
    facts, _, agents = _star(spark)
    join = Join(agents, "salesagentkey", "salesagentid", ("region",), 4)
    got = star_aggregate(facts, [join], {"region": F.col("region")}, {"n": ("count", "*")})
    assert got.agg(F.sum("n")).first()[0] == facts.filter("salesagentkey < 4").count()


# --- change logs -------------------------------------------------------------------
def test_apply_changes(spark, rows):
    target = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "id INT, v INT")
    log = spark.createDataFrame(
        [(1, "U", 11, 1, 1), (1, "U", 12, 1, 2), (2, "U", 21, 1, 1), (2, "D", None, 2, 1), (4, "I", 40, 1, 1),
         (5, "I", 50, 1, 1), (5, "D", None, 1, 2), (6, "D", None, 1, 1), (6, "I", 60, 2, 0)],
        "id INT, op STRING, v INT, at INT, seq INT")
    assert rows(apply_changes(target, log, "id", ["at", "seq"])) == [(1, 12), (3, 30), (4, 40), (6, 60)]
    assert tuple(last_processed(log, "at", "seq").first()) == (2, 1)


def test_update_and_delete_by_key(spark, rows):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id INT, n STRING, v INT")
    updates = spark.createDataFrame([(2, None), (3, "c")], "id INT, n STRING")
    assert rows(update_by_key(target, updates, "id")) == [(1, "a", 1), (2, None, 2)]
    assert rows(delete_by_key(target, updates, "id")) == [(1, "a", 1)]


# --- schemas and readers -------------------------------------------------------------
def test_empty_tables_are_typed(spark):
    for name in [*SOURCE_DDL, *WAREHOUSE_DDL]:
        df = empty_table(spark, name)
        assert df.count() == 0 and df.columns


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_read_files_with_declared_schema(spark, tmp_path, fmt):
    df = spark.createDataFrame([(1, "Won"), (2, None)], SOURCE_DDL["dealstages"])
    df.write.format(fmt).save(str(tmp_path / "t"))
    got = read_files(spark, str(tmp_path / "t"), "dealstages", fmt)
    assert got.dtypes == df.dtypes and sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_jdbc_reader_checks_its_arguments(spark):
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:x:y")
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:x:y", table="t", query="SELECT 1")
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:x:y", table="t", split_on="id")


def test_pages_and_ranges(spark):
    df = spark.range(1000).withColumn("accountid", F.col("id") * F.col("id"))
    seen = []
    while True:
        part = [r.id for r in page(df, [F.col("accountid")], 300, len(seen)).collect()]
        seen += part
        if len(part) < 300:
            break
    assert seen == list(range(1000))
    ranges = range_edges(df, "accountid", 4)
    counts = [key_range(df, "accountid", lo, hi).count() for lo, hi in ranges]
    assert sum(counts) == 1000 and len(counts) == 4 and max(counts) < 350
    assert range_edges(df, "accountid", 1) == [(None, None)]
    keyless = spark.createDataFrame([(None,), (1,), (9,)], "accountid BIGINT")
    assert [key_range(keyless, "accountid", lo, hi).count() for lo, hi in ((None, 5), (5, None))] == [2, 1]
