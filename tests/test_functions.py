from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmart.functions import (
    PRICE_BANDS,
    REVENUE_BANDS,
    any_changed,
    band,
    change_window,
    date_key,
    duration_days,
    end_of_year,
    event_date,
    exact_avg,
    exact_sum,
    parse_date,
    parse_instant,
    row_json,
    scale_price,
    stage_rate,
    start_of_year,
    suffix_once,
    valid_at,
)


def one(spark, ddl, values, expr):
    df = spark.createDataFrame([(v if isinstance(v, tuple) else (v,)) for v in values], ddl)
    return [r[0] for r in df.select(expr).collect()]


def test_revenue_band_edges(spark):
    values = [Decimal(v) if v else None for v in ("-5", "999999.99", "1000000", "10000000", "10000000.01", None)]
    got = one(spark, "v DECIMAL(18,2)", values, band(F.col("v"), REVENUE_BANDS))
    assert got == ["Under 1M", "Under 1M", "1M-10M", "1M-10M", "Over 10M", "Unknown"]


def test_price_band_edges(spark):
    values = [Decimal(v) if v else None for v in ("99.99", "100", "1000", "1000.01", None)]
    got = one(spark, "v DECIMAL(18,2)", values, band(F.col("v"), PRICE_BANDS))
    assert got == ["Low", "Medium", "Medium", "High", "Unknown"]


def test_stage_rate_is_case_sensitive(spark):
    names = ["Won", "Lost", "Engaging", "Prospecting", "won", "other", None]
    assert one(spark, "v STRING", names, stage_rate(F.col("v"))) == [100.0, 0.0, 75.0, 25.0, 10.0, 10.0, 10.0]


def test_duration_and_event_date(spark):
    d = [(date(2024, 1, 1), date(2024, 1, 31)), (date(2024, 1, 31), date(2024, 1, 1)), (None, date(2024, 1, 1)),
         (date(2024, 1, 2), None), (None, None)]
    assert one(spark, "a DATE, b DATE", d, duration_days(F.col("a"), F.col("b"))) == [30, -30, None, None, None]
    assert one(spark, "a DATE, b DATE", d, event_date(F.col("b"), F.col("a"))) == [
        date(2024, 1, 31), date(2024, 1, 1), date(2024, 1, 1), date(2024, 1, 2), None]


def test_date_parts(spark):
    d = [date(2024, 2, 29)]
    assert one(spark, "d DATE", d, date_key(F.col("d"))) == [20240229]
    assert one(spark, "d DATE", d, start_of_year(F.col("d"))) == [date(2024, 1, 1)]
    assert one(spark, "d DATE", d, end_of_year(F.col("d"))) == [date(2024, 12, 31)]


def test_parse_date_never_fails(spark):
    texts = ["2024-02-29", "2024-02-30", "2024-01-05 10:00:00", "n/a", "", None]
    assert one(spark, "t STRING", texts, parse_date(F.col("t"))) == [
        date(2024, 2, 29), None, date(2024, 1, 5), None, None, None]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_parse_instant_ignores_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = ["2024-01-01T10:00:00", "2024-01-01T10:00:00Z", "2024-01-01T10:00:00+02:00",
                 "2024-01-01T10:00:00.250000-05:30", "2024-01-01", "bad", None]
        got = one(spark, "t STRING", texts, parse_instant(F.col("t")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    epoch = datetime(1970, 1, 1)
    assert got == [datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 8),
                   datetime(2024, 1, 1, 15, 30, 0, 250000), datetime(2024, 1, 1), epoch, epoch]


def test_suffix_and_price(spark):
    s = " (Updated Scenario 2)"
    assert one(spark, "n STRING", ["GTX", "GTX" + s, None], suffix_once(F.col("n"), s)) == ["GTX" + s, "GTX" + s, None]
    prices = [Decimal("55.00"), Decimal("0.05"), None]
    assert one(spark, "p DECIMAL(18,2)", prices, scale_price(F.col("p"), "1.1")) == [
        Decimal("60.50"), Decimal("0.06"), None]


def test_row_json_keeps_nulls_and_text(spark):
    df = spark.createDataFrame([(1, Decimal("2.50"), None)], "id INT, p DECIMAL(18,2), d DATE")
    assert df.select(row_json(["id", "p", "d"], ["p", "d"])).first()[0] == '{"id":1,"p":"2.50","d":null}'


def test_any_changed_treats_null_as_equal(spark):
    pairs = [("a", "a"), ("a", "b"), (None, None), (None, "a"), ("a", None)]
    got = one(spark, "x STRING, y STRING", pairs, any_changed([(F.col("x"), F.col("y"))]))
    assert got == [False, True, False, True, True]


def test_change_window_edges(spark):
    times = [datetime(2024, 1, d, h) for d, h in ((1, 0), (1, 1), (2, 0), (2, 1))]
    w = change_window(F.col("t"), "2024-01-01T00:00:00", "2024-01-02T00:00:00")
    assert one(spark, "t TIMESTAMP_NTZ", times, w) == [False, True, True, False]


def test_valid_at_bounds(spark):
    day = date(2024, 1, 31)
    spans = [(day, date(2024, 1, 1), day), (day, day, None), (day, date(2024, 2, 1), None)]
    cols = [F.col(c) for c in "dft"]
    assert one(spark, "d DATE, f DATE, t DATE", spans, valid_at(*cols)) == [True, True, False]
    assert one(spark, "d DATE, f DATE, t DATE", spans, valid_at(*cols, "half_open")) == [False, True, False]
    with pytest.raises(ValueError):
        valid_at(*cols, "open")


def test_exact_aggregates(spark):
    df = spark.createDataFrame([(Decimal("0.10"),), (Decimal("0.20"),), (None,)], "v DECIMAL(18,2)")
    got = df.agg(exact_sum(F.col("v")), exact_avg(F.col("v"))).first()
    assert got[0] == 0.3 and got[1] == 0.15
    none = df.filter("v IS NULL").agg(exact_sum(F.col("v")), exact_avg(F.col("v"))).first()
    assert tuple(none) == (None, None)
