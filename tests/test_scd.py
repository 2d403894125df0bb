from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from starmart.operators.scd import insert_if_absent, scd1_upsert, scd2_apply, scd2_changes, scd2_initialize

ROW = "productid BIGINT, productname STRING, seriesname STRING, price DECIMAL(18,2), pricerange STRING"


def source(spark, *items):
    return spark.createDataFrame([(i, n, s, None, "Unknown") for i, n, s in items], ROW)


def run(dim, src, day, **how):
    return scd2_apply(dim, scd2_changes(dim, src), day, **how)


def versions(dim):
    got = dim.orderBy("productsk").collect()
    return [(r.productsk, r.productid, r.productname, r.seriesname, r.validfrom, r.validto, r.iscurrent) for r in got]


def test_upsert_overwrites_whole_rows_and_counts_repeats_once(spark, rows):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id INT, n STRING, r STRING")
    src = spark.createDataFrame([(2, "old", "q", 1), (2, "new", None, 2), (3, "c", "z", 1)], "id INT, n STRING, r STRING, t INT")
    assert rows(scd1_upsert(target, src, "id", ["t"])) == [(1, "a", "x"), (2, "new", None), (3, "c", "z")]
    assert rows(scd1_upsert(target, src.limit(0), "id", ["t"])) == [(1, "a", "x"), (2, "b", "y")]
    assert rows(scd1_upsert(target.limit(0), src, "id", ["t"])) == [(2, "new", None), (3, "c", "z")]


def test_upsert_twice_changes_nothing(spark, rows):
    target = spark.createDataFrame([(1, "a")], "id INT, n STRING")
    src = spark.createDataFrame([(1, "b"), (2, "c")], "id INT, n STRING")
    once = scd1_upsert(target, src, "id")
    assert rows(scd1_upsert(once, src, "id")) == rows(once)


def test_insert_if_absent(spark, rows):
    target = spark.createDataFrame([(1, "a")], "id INT, n STRING")
    src = spark.createDataFrame([(1, "b"), (2, "d"), (2, "c")], "id INT, n STRING")
    assert rows(insert_if_absent(target, src, "id", [F.col("n")])) == [(2, "c")]


def test_first_load(spark):
    dim = scd2_initialize(source(spark, (5, "p5", None), (0, "p0", "s")))
    begin = date(1900, 1, 1)
    assert versions(dim) == [(1, 0, "p0", "s", begin, None, True), (2, 5, "p5", None, begin, None, True)]


def test_changes_are_null_safe(spark):
    dim = scd2_initialize(source(spark, (1, "a", None), (2, "b", "s"), (3, "c", None)))
    found = scd2_changes(dim, source(spark, (1, "a", None), (2, "b", None), (3, "c", "s"), (4, "d", None)))
    assert sorted((r.productid, r.had_current) for r in found.collect()) == [(2, True), (3, True), (4, False)]


def test_change_closes_the_day_before_and_opens_on_the_day(spark):
    dim = scd2_initialize(source(spark, (1, "a", None), (2, "b", None)))
    out = run(dim, source(spark, (1, "A", None), (2, "b", None), (9, "n", None)), "2024-03-01")
    begin, day = date(1900, 1, 1), date(2024, 3, 1)
    assert versions(out) == [
        (1, 1, "a", None, begin, date(2024, 2, 29), False),
        (2, 2, "b", None, begin, None, True),
        (3, 1, "A", None, day, None, True),
        (4, 9, "n", None, begin, None, True),
    ]
    late = run(dim, source(spark, (9, "n", None)), "2024-03-01", first_version_from="2024-03-01")
    assert versions(late)[-1] == (3, 9, "n", None, day, None, True)


def test_second_change_on_a_day_rewrites_in_place(spark):
    dim = scd2_initialize(source(spark, (1, "a", None)))
    dim = run(dim, source(spark, (1, "b", None)), "2024-03-01")
    dim = run(dim, source(spark, (1, "c", None)), "2024-03-01")
    got = versions(dim)
    assert [(v[2], v[4], v[5], v[6]) for v in got] == [
        ("a", date(1900, 1, 1), date(2024, 2, 29), False), ("c", date(2024, 3, 1), None, True)]
    dim = run(dim, source(spark, (1, "d", None)), "2024-03-05")
    assert [(v[0], v[2], v[5], v[6]) for v in versions(dim)][1:] == [
        (2, "c", date(2024, 3, 4), False), (3, "d", None, True)]


def test_repeating_a_run_changes_nothing(spark):
    dim = scd2_initialize(source(spark, (1, "a", None)))
    src = source(spark, (1, "b", None), (2, "n", None))
    once = run(dim, src, "2024-03-01")
    assert versions(run(once, src, "2024-03-02")) == versions(once)


def test_into_an_empty_dimension(spark):
    empty = scd2_initialize(source(spark))
    assert [v[:3] for v in versions(run(empty, source(spark, (3, "c", None), (1, "a", None)), "2024-03-01"))] == [
        (1, 1, "a"), (2, 3, "c")]
