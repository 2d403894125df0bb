from __future__ import annotations

from datetime import date

from starmart.operators import quality
from starmart.operators.history import version_json


def checks(df):
    return {r.check_name: r.violations for r in df.collect()}


def versions(spark, *items):
    return spark.createDataFrame(list(items), "productid BIGINT, validfrom DATE, validto DATE, iscurrent BOOLEAN")


def test_good_history_passes(spark):
    good = versions(spark, (1, date(1900, 1, 1), date(2024, 2, 29), False), (1, date(2024, 3, 1), None, True),
                    (2, date(1900, 1, 1), None, True))
    assert set(checks(quality.version_checks(good)).values()) == {0}
    assert checks(quality.one_current_version(good)) == {"one_current_version": 0}


def test_each_version_rule_fires(spark):
    d = date
    bad = {
        "newest_is_current": [(1, d(2024, 1, 1), d(2024, 2, 1), False)],
        "older_is_closed": [(1, d(2024, 1, 1), d(2024, 1, 31), True), (1, d(2024, 2, 1), None, True)],
        "older_has_end": [(1, d(2024, 1, 1), None, False), (1, d(2024, 2, 1), None, True)],
        "versions_overlap": [(1, d(2024, 1, 1), d(2024, 2, 1), False), (1, d(2024, 2, 1), None, True)],
        "versions_gap": [(1, d(2024, 1, 1), d(2024, 1, 30), False), (1, d(2024, 2, 1), None, True)],
        "ends_before_start": [(1, d(2024, 1, 1), d(2023, 1, 1), True)],
    }
    for check, items in bad.items():
        assert checks(quality.version_checks(versions(spark, *items)))[check] == 1, check


def test_key_checks(spark):
    df = spark.createDataFrame([(1, 5), (1, 6), (2, None), (3, 5)], "k INT, p INT")
    parent = spark.createDataFrame([(6,)], "id INT")
    assert checks(quality.repeated_keys(df, "k", "dup", "t")) == {"dup": 1}
    assert checks(quality.null_keys(df, ["k", "p"], "null", "t")) == {"null": 1}
    assert checks(quality.orphans(df, "p", parent, "id", "orphan", "t")) == {"orphan": 2}
    two = versions(spark, (1, date(2024, 1, 1), None, True), (1, date(2024, 2, 1), None, True))
    assert checks(quality.one_current_version(two)) == {"one_current_version": 1}


def test_aggregate_total(spark):
    monthly = spark.createDataFrame([(3,), (4,)], "totaldealcount BIGINT")
    assert checks(quality.aggregate_total(monthly, spark.range(9))) == {"aggregate_total": 2}
    assert checks(quality.aggregate_total(monthly.limit(0), spark.range(0))) == {"aggregate_total": 0}


def test_history_listing_is_newest_first(spark):
    df = spark.createDataFrame(
        [(1, "a", None, date(1900, 1, 1), date(2024, 2, 29), False), (1, "b", None, date(2024, 3, 1), None, True)],
        "productid BIGINT, productname STRING, price DECIMAL(18,2), validfrom DATE, validto DATE, iscurrent BOOLEAN")
    got = {r.version_rank: r.version_json for r in version_json(df).collect()}
    assert got[1] == '{"productid":1,"productname":"b","price":null,"validfrom":"2024-03-01","validto":null,"iscurrent":true}'
    assert '"validto":"2024-02-29"' in got[2]
