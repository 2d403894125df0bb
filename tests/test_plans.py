"""Physical plans: what must and must not be in them."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from checks.queries import REGISTERED
from checks.sample_source import Sample
from starmart.functions import change_window
from starmart.operators.aggregates import in_months
from starmart.sources.warehouse import Warehouse

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="given tables not present")

LAZY = ["monthly_aggregate", "fact_resolved_as_of", "scd2_apply", "fact_upsert", "apply_changes", "validate", "version_checks"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(REGISTERED[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "Pandas" not in text


def test_window_reaches_the_scan(spark):
    lines = Sample(spark, SF_DIR).raw("lineitem")
    text = plan(lines.filter(change_window(F.col("l_shipdate"), "1999-01-01T00:00:00", "2000-01-01T00:00:00")).select("l_orderkey"))
    assert "GreaterThan(l_shipdate" in text and "LessThanOrEqual(l_shipdate" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in text


def test_window_passes_the_pipeline_join(spark):
    text = plan(REGISTERED["change_window"](spark, SF_DIR))
    assert "GreaterThan(l_shipdate" in text


def test_aggregate_reduces_before_its_shuffle(spark):
    s = Sample(spark, SF_DIR)
    text = plan(REGISTERED["monthly_aggregate"](spark, SF_DIR))
    assert re.search(r"HashAggregate\(keys=\[.*region.*\], functions=\[partial_count", text) or "partial_count" in text
    # Per opportunity one row is kept before its exchange.
    assert text.count("WindowGroupLimit") == 2
    assert s.rows["agent"] > 0


def test_months_prune_partitions(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    fact = wh.read("factsalesperformance", [])
    one = fact.unionByName(spark.range(1).select(*[F.lit(None if f.name == "updated_at" else 1).cast(f.dataType).alias(f.name) for f in fact.schema.fields]))
    wh.commit("b", "2024-01-01T00:00:00", [wh.write("factsalesperformance", one, "b")], {})
    text = plan(wh.table("factsalesperformance").filter(in_months(F.col("year"), F.col("month"), [202401, 202402])))
    assert re.search(r"PartitionFilters: \[.*year.*month", text)
