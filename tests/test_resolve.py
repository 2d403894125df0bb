from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmart.operators.dates import date_dimension
from starmart.operators.resolve import (
    Dimensions,
    as_of_join,
    fact_columns,
    replay_rejects,
    resolve_keys,
    version_ranges,
)
from starmart.schemas import FACT_COLUMNS, WAREHOUSE_DDL

SHAPED = ("opportunityid STRING, salesagentid BIGINT, productid BIGINT, accountid BIGINT, dealstageid BIGINT, "
          "closevalue DECIMAL(18,2), durationdays INT, expectedsuccessrate DOUBLE, eventdate DATE, updated_at TIMESTAMP_NTZ")


def shaped(spark, *items):
    """Items (opportunity, agent, product, account, stage, event date)."""
    return spark.createDataFrame(
        [(o, g, p, a, s, Decimal("1.00"), 1, 10.0, d, datetime(2024, 1, 1)) for o, g, p, a, s, d in items], SHAPED)


def products(spark, *items):
    """Items (sk, id, from, to, current)."""
    return spark.createDataFrame(
        [(sk, i, "n", None, None, "Unknown", f, t, c) for sk, i, f, t, c in items], WAREHOUSE_DDL["dimproduct"])


def dimensions(spark, product, accounts=(0, 1), rows=None):
    ids = spark.createDataFrame([(i,) for i in accounts], "accountid BIGINT")
    return Dimensions(
        date_dimension(spark.sql("SELECT DATE '2024-01-01' lo, DATE '2024-12-31' hi")),
        ids, product,
        spark.createDataFrame([(0,), (1,)], "salesagentid BIGINT"),
        spark.createDataFrame([(4,)], "stageid BIGINT"), rows)


BEGIN, D = date(1900, 1, 1), date(2024, 3, 1)


def test_key_zero_is_a_key_and_missing_keys_are_flagged(spark):
    dim = dimensions(spark, products(spark, (10, 0, BEGIN, None, True)))
    got = resolve_keys(shaped(spark, ("ok", 0, 0, 0, 4, D), ("date", 0, 0, 0, 4, date(2025, 1, 1)), ("account", 0, 0, 5, 4, D),
                              ("product", 0, 9, 0, 4, D), ("agent", 7, 0, 0, 4, D), ("both", 7, 0, 0, 9, D)), dim)
    facts = fact_columns(got.facts).collect()
    assert [(f.opportunityid, f.datekey, f.accountkey, f.productkey) for f in facts] == [("ok", 20240301, 0, 10)]
    assert got.facts.select(*FACT_COLUMNS).columns == FACT_COLUMNS
    flags = {r.opportunityid: [c for c in r.asDict() if c.startswith("missing_") and r[c]] for r in got.rejects.collect()}
    assert flags == {"date": ["missing_date"], "account": ["missing_account"], "product": ["missing_product"],
                     "agent": ["missing_agent"], "both": ["missing_agent", "missing_stage"]}


@pytest.mark.parametrize("mode", ["current", "as_of"])
def test_repeated_dimension_rows_do_not_multiply_facts(spark, mode):
    prod = products(spark, (1, 1, BEGIN, None, True), (2, 1, BEGIN, None, True))
    got = resolve_keys(shaped(spark, ("a", 1, 1, 1, 4, D)), dimensions(spark, prod, accounts=(1, 1, 1)), mode)
    assert got.facts.count() == 1


def two_versions(spark):
    return products(spark, (1, 1, BEGIN, date(2024, 2, 29), False), (2, 1, D, None, True))


def test_one_day_hole_depends_on_bounds(spark):
    facts = shaped(spark, ("before", 1, 1, 1, 4, date(2024, 2, 28)), ("last", 1, 1, 1, 4, date(2024, 2, 29)), ("first", 1, 1, 1, 4, D))
    dim = dimensions(spark, two_versions(spark))
    sk = {b: {r.opportunityid: r.productkey for r in resolve_keys(facts, dim, "as_of", b).flagged.collect()}
          for b in ("closed", "half_open")}
    assert sk["closed"] == {"before": 1, "last": 1, "first": 2}
    assert sk["half_open"] == {"before": 1, "last": None, "first": 2}
    natural = resolve_keys(facts, dim, "as_of", emit="natural").flagged.select("productkey").distinct().collect()
    assert [r[0] for r in natural] == [1]
    current = resolve_keys(facts, dim, "current").flagged.select("productkey").distinct().collect()
    assert [r[0] for r in current] == [2]


def test_ranges_are_cut_where_versions_overlap(spark):
    prod = products(spark, (1, 1, BEGIN, None, False), (2, 1, D, None, True), (3, 1, D, date(2024, 2, 1), False))
    got = sorted((r["_p_sk"], r["_p_from"], r["_p_until"]) for r in version_ranges(prod).collect())
    assert got == [(1, BEGIN, D), (2, D, None)]


def test_bad_choices_are_refused(spark):
    dim = dimensions(spark, two_versions(spark))
    for bad in ({"product": "newest"}, {"product": "as_of", "bounds": "open"}):
        with pytest.raises(ValueError):
            resolve_keys(shaped(spark, ("a", 1, 1, 1, 4, D)), dim, **bad)


@pytest.mark.parametrize("mode", ["current", "as_of"])
def test_large_dimensions_and_hot_keys_give_the_same_result(spark, rows, mode):
    items = [(f"o{i}", i % 3, 1 if i % 3 == 0 else i % 5, 1 if i % 2 else i % 4, 4, date(2024, 1 + i % 12, 1 + i % 28))
             for i in range(600)]
    facts, prod = shaped(spark, *items), two_versions(spark)
    broadcast = resolve_keys(facts, dimensions(spark, prod), mode)
    sliced = resolve_keys(facts, dimensions(spark, prod), mode, max_broadcast=0, slice_rows=20)
    assert rows(sliced.flagged, *broadcast.flagged.columns) == rows(broadcast.flagged)
    assert rows(sliced.rejects) == rows(broadcast.rejects)


def test_known_row_counts_are_not_counted_again(spark):
    dim = dimensions(spark, two_versions(spark), rows={"account": 2, "product": 2, "agent": 2, "stage": 1})
    assert dim.counted() == {"account": 2, "product": 2, "agent": 2, "stage": 1}


def test_replay_after_a_late_dimension_row(spark):
    prod = products(spark, (10, 0, BEGIN, None, True))
    first = resolve_keys(shaped(spark, ("late", 0, 0, 5, 4, D), ("never", 0, 8, 0, 4, D)), dimensions(spark, prod))
    again = replay_rejects(first.rejects, dimensions(spark, prod, accounts=(0, 5)))
    assert [r.opportunityid for r in again.facts.collect()] == ["late"]
    assert [r.opportunityid for r in again.rejects.collect()] == ["never"]


def test_as_of_join_is_a_hash_join_on_the_product(spark):
    facts = spark.range(10).select(F.lit("o").alias("opportunityid"), F.col("id").alias("productid"), F.lit(D).alias("eventdate"))
    plan = as_of_join(facts, two_versions(spark), 2)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    plan = as_of_join(facts, two_versions(spark), 2, max_broadcast=0)._jdf.queryExecution().optimizedPlan().toString()
    assert "_slice" in plan
