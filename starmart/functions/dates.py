"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(d: Column) -> Column:
    """``yyyymmdd`` as INT, from integer arithmetic (no text formatting per row)."""
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def start_of_year(d: Column) -> Column:
    return F.make_date(F.year(d), F.lit(1), F.lit(1))


def end_of_year(d: Column) -> Column:
    return F.make_date(F.year(d), F.lit(12), F.lit(31))


def duration_days(start: Column, end: Column) -> Column:
    """Whole days from ``start`` to ``end``; NULL unless both are known; may be negative."""
    return F.datediff(end, start)


def event_date(closed: Column, engaged: Column) -> Column:
    return F.coalesce(closed, engaged)


def parse_date(text: Column) -> Column:
    """Date or ISO-like text to DATE; NULL, not an error, for anything unreadable."""
    return text.try_cast("date")


def parse_instant(text: Column, default: str = "1970-01-01T00:00:00") -> Column:
    """ISO text to a UTC TIMESTAMP_NTZ; missing or unreadable text gives ``default``.

    Text with an offset is an instant and is shifted to UTC; text without one is
    taken as UTC.
    """
    has_offset = text.rlike(r"\d{2}:\d{2}.*(Z|[+-]\d{2}:?\d{2})$")
    shifted = F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), text.try_cast("timestamp").cast("timestamp_ntz")
    )
    return F.coalesce(
        F.when(has_offset, shifted).otherwise(text.try_cast("timestamp_ntz")),
        F.lit(default).cast("timestamp_ntz"),
    )
