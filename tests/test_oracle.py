"""Every registered query against its SQL on the smallest given tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as contract
from checks.compare import TABLES, compare
from checks.oracle import QUERIES
from checks.queries import REGISTERED

SF_DIR = "/root/testdata/sf0.001"
WHOLE_LOADS = ["initial_load", "load_metadata", "refresh_monthly", "incremental_load", "incremental_products", "monthly_touched",
               "stream_incremental", "changelog_load", "archive_load", "ranged_load", "offset_run_ts", "compacted_facts", "load_checks",
               "archive_then_incremental", "stream_second_checkpoint", "lineage", "ranged_facts", "changelog_monthly", "changelog_rejects",
               "rejects_replayed_all", "stream_batches", "incremental_checks"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="given tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return c


def test_contract():
    assert set(REGISTERED) == set(QUERIES)
    assert set(REGISTERED) <= set(contract.queries()) and set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 1320


@pytest.mark.parametrize("name", [n for n in REGISTERED if n not in WHOLE_LOADS])
def test_query(spark, con, name):
    assert compare(spark, con, name, SF_DIR) is None


@pytest.mark.parametrize("name", ["incremental_load", "changelog_load", "archive_then_incremental", "load_checks", "ranged_load"])
def test_whole_load(spark, con, name):
    assert compare(spark, con, name, SF_DIR) is None
